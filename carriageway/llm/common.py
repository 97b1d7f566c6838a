"""Column expressions and frames that several operators of this folder use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text of a row; a null counts as an empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words in order: the pieces between white space, without empty ones."""
    return F.array_remove(F.split(text, WHITE_SPACE), "")


def shingle_hashes(words: Column, size: int, step_hash=F.xxhash64) -> Column:
    """Hash of every run of ``size`` words, in order; none if there are fewer words.

    ``words`` must be a plain column: a lambda would evaluate anything else again for each word.
    """
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - F.lit(size - 1), F.lit(0)))
    return F.transform(starts, lambda x, i: step_hash(x, *[F.get(words, i + F.lit(k)) for k in range(1, size)]))


#: Rows of a narrow table up to which it is broadcast: at most some tens of MB.
BROADCAST_ROWS = 1_000_000


def side(written: DataFrame) -> DataFrame:
    """A written table of narrow rows as the small side of a join: broadcast if its counted rows allow, else joined by shuffle."""
    return F.broadcast(written) if written.count() <= BROADCAST_ROWS else written.hint("merge")
