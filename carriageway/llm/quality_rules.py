"""Quality rules whose thresholds follow the data of each language and source.

Every row is measured in place; nothing is exploded. Each measure goes into a
quantile sketch of logarithmic buckets (relative error ``ACCURACY``): a sketch
is a table of bucket counts, so sketches merge by adding counts, the partial
aggregation of a scan merges most of it before the shuffle, and the result
does not depend on the order of rows. Sketches exist per (language, source);
their sums per language and over everything are the parents of these groups.

A row fails where a measure lies beyond the fence of its group, quartile plus
or minus ``SPREAD`` times the distance of the quartiles. Quartiles are those of
the group, blended with its language's, and these with those of everything, by
the number of rows. No cutoff is fixed; the distance is at least ``NOISE``.

Defined results: a null text counts as empty; null language or source form a
group of their own; repeated rows are judged one by one and alike; an empty
table gives no rows; other columns are carried where asked for.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carriageway.llm.common import shingle_hashes, side, whole_text, words_of
from carriageway.operators.settle import settled

ACCURACY = 0.02
SPREAD = 4.0
#: The distance of the quartiles counts as at least this part of the quartile: a uniform group has some room too.
LEAST_SPREAD = 0.1
#: A parent weighs as much as this many rows of the group itself.
PARENT_ROWS = 20
WINDOW_WORDS = 5

#: Measure to the distance of the quartiles that counts at least: what a few symbols, lines or words in a text change.
NOISE = {"symbol_share": 0.002, "dup_line_share": 0.05, "repeat_share": 0.02, "upper_share": 0.01, "mean_word": 0.2}
#: Measures with a lower fence too.
LOWER = ("mean_word",)

_SYMBOLS = r"[#*$%&|<>]"
_WORD_INSIDE = r"[^\x20\x09-\x0D]"


def measured(docs: DataFrame, carry: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """One row per document: the carried columns, ``_group`` and the struct ``_m`` of measures.

    Counts: words, code points in words, symbols, repeated lines, words inside
    repeated five-word windows. A window counts as repeated if its 64-bit hash
    occurs twice in the text.
    """
    lang, source = (F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string") for c in ("lang", "source"))
    base = docs.select(
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
        F.struct(lang.alias("lang"), source.alias("source")).alias("_group"),
        whole_text(text).alias("_text"),
    )
    kept = [*[f"_c{i}" for i in range(len(carry))], "_group", "_text"]
    split = base.select(
        *kept, words_of(F.col("_text")).alias("_words"),
        F.filter(F.split(F.col("_text"), "\n"), lambda x: x.rlike(_WORD_INSIDE)).alias("_lines"),
    )
    hashed = split.select(
        *kept, F.size("_words").cast("long").alias("_n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("_word_chars"),
        F.size("_lines").cast("long").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("_n_dup_lines"),
        shingle_hashes(F.col("_words"), WINDOW_WORDS).alias("_h"),
    )
    # Only texts with a repeated window pay for sorting their windows.
    ordered = hashed.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("at")))),
    )).drop("_h")
    twice = F.filter("_sorted", lambda e, i: (
        e["h"].eqNullSafe(F.get(F.col("_sorted"), i + 1)["h"])
        | ((i > 0) & e["h"].eqNullSafe(F.get(F.col("_sorted"), F.greatest(i - 1, F.lit(0)))["h"]))
    ))
    spots = F.array_distinct(F.flatten(F.transform(twice, lambda e: F.sequence(e["at"], e["at"] + F.lit(WINDOW_WORDS - 1)))))
    return ordered.select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], "_group",
        F.struct(
            F.col("_n_words").alias("n_words"), F.col("_word_chars").alias("word_chars"),
            (F.size(F.split("_text", _SYMBOLS, -1)) - 1).cast("long").alias("n_symbols"),
            F.col("_n_dup_lines").alias("n_dup_lines"), F.col("_n_lines").alias("n_lines"),
            F.coalesce(F.when(F.col("_sorted").isNotNull(), F.size(spots)), F.lit(0)).cast("long").alias("n_repeat_words"),
            (F.size(F.split("_text", r"\p{Lu}", -1)) - 1).cast("long").alias("n_upper"),
        ).alias("_m"),
    )


def shares() -> dict[str, Column]:
    """The measures that thresholds apply to."""
    m = {c: F.col(f"_m.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_upper")}
    share = lambda a, b: m[a] / F.greatest(m[b], F.lit(1))
    return {
        "symbol_share": share("n_symbols", "word_chars"), "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"), "upper_share": share("n_upper", "word_chars"),
        "mean_word": share("word_chars", "n_words"),
    }


def sketches(rows: DataFrame) -> DataFrame:
    """Bucket counts (_group, measure, bucket, n) of rows with ``_group`` and ``_m``."""
    pairs = F.array(*[F.struct(F.lit(k).alias("measure"), v.alias("x")) for k, v in shares().items()])
    log_base = math.log((1 + ACCURACY) / (1 - ACCURACY))
    bucket = F.when(F.col("p.x") > 1e-6, F.ceil(F.log("p.x") / log_base)).otherwise(F.lit(-(10**6))).cast("int")
    return (rows.select("_group", F.explode(pairs).alias("p"))
            .groupBy("_group", F.col("p.measure").alias("measure"), bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")))


def merged(counts: DataFrame, group: Column) -> DataFrame:
    """Sketches of coarser groups: the sums of the finer ones."""
    return counts.groupBy(group.alias("_group"), "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(counts: DataFrame) -> DataFrame:
    """(_group, measure, rows, q1, q2, q3) of sketches; a window holds the buckets of one sketch, at most a few hundred."""
    by = Window.partitionBy("_group", "measure")
    up_to = F.sum("n").over(by.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumns({"up_to": up_to, "rows": F.sum("n").over(by)})
    gamma = (1 + ACCURACY) / (1 - ACCURACY)
    value = F.when(F.col("bucket") > -(10**6), 2 * F.pow(F.lit(gamma), F.col("bucket")) / (gamma + 1)).otherwise(0.0)
    at = lambda q: F.min(F.when(F.col("up_to") >= q * F.col("rows"), value))
    return ranked.groupBy("_group", "measure").agg(
        F.max("rows").alias("rows"), at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"))


def thresholds(rows: DataFrame) -> DataFrame:
    """One row per (language, source): struct ``_fence`` of upper and lower limits per measure."""
    fine = settled(sketches(rows), "quality-sketches")
    by_lang = F.struct(F.col("_group.lang").alias("lang"))
    own = quartiles(fine)
    lang = quartiles(merged(fine, by_lang)).select(
        F.col("_group").alias("_lang_b"), F.col("measure").alias("_measure_b"), F.struct("rows", "q1", "q3").alias("of_lang"))
    every = quartiles(merged(fine, F.lit(1))).select("measure", F.struct("rows", "q1", "q3").alias("of_all"))
    both = (own.withColumn("_lang", by_lang)
            .join(lang, F.col("_lang").eqNullSafe(F.col("_lang_b")) & (F.col("measure") == F.col("_measure_b")))
            .join(every, "measure"))
    share = lambda rows: F.col(rows) / (F.col(rows) + F.lit(PARENT_ROWS))
    mix = lambda q: (share("rows") * F.col(q) + (1 - share("rows")) * (
        share("of_lang.rows") * F.col(f"of_lang.{q}") + (1 - share("of_lang.rows")) * F.col(f"of_all.{q}")))
    noise = F.coalesce(*[F.when(F.col("measure") == k, F.lit(v)) for k, v in NOISE.items()])
    distance = lambda of: F.greatest(F.col("mix_q3") - F.col("mix_q1"), LEAST_SPREAD * F.col(of), noise)
    fenced = both.select("_group", "measure", mix("q1").alias("mix_q1"), mix("q3").alias("mix_q3")).withColumns({
        "upper": F.col("mix_q3") + SPREAD * distance("mix_q3"), "lower": F.col("mix_q1") - SPREAD * distance("mix_q1")})
    pick = lambda k, side: F.max(F.when(F.col("measure") == k, F.col(side))).alias(f"{k}_{side}")
    limits = [*[pick(k, "upper") for k in NOISE], *[pick(k, "lower") for k in LOWER]]
    return fenced.groupBy("_group").agg(F.struct(*limits).alias("_fence"))


def judged(docs: DataFrame, carry: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The carried columns with ``_m``, ``_fence``, ``_base_failed`` and ``_kept``.

    The measured rows are written once: the sketches read a few narrow columns
    of them, the filter the rest.
    """
    rows = settled(measured(docs, carry, text), "quality-rows")
    limits = settled(thresholds(rows).withColumnRenamed("_group", "_limits_of"), "quality-limits")
    both = rows.join(side(limits), F.col("_group").eqNullSafe(F.col("_limits_of")), "left").drop("_limits_of")
    bad = F.lit(False)
    for k, value in shares().items():
        bad = bad | (value > F.col(f"_fence.{k}_upper"))
        if k in LOWER:
            bad = bad | (value < F.col(f"_fence.{k}_lower"))
    base_failed = (F.col("_m.n_words") < 10) | (100 * F.col("_m.n_repeat_words") > 20 * F.col("_m.n_words"))
    return both.withColumn("_base_failed", base_failed).withColumn("_kept", ~F.col("_base_failed") & ~F.coalesce(bad, F.lit(False)))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    return judged(docs, docs.columns).where("_kept").select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """The query's columns: counts and verdict per document."""
    return judged(docs, ["doc_id"]).select(
        "doc_id", "_m.n_words", "_m.word_chars", "_m.n_symbols", "_m.n_dup_lines", "_m.n_repeat_words",
        F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"),
    )
