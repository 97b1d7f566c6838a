"""Rows that every corpus operator has to take: nulls, empty and very long texts, ties, repeats, clashing columns."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts(n: int = 60, seed: int = 1) -> list[str]:
    """Distinct plain texts of 30 to 120 words over a small invented vocabulary."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abdefgiklmnoprstuvé") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(30, 120))) + "." for _ in range(n)]


def rows() -> list[tuple]:
    plain = texts()
    out = [(i, t, ("en", "de", None)[i % 3], ("a", "b", None)[i % 3], len(t)) for i, t in enumerate(plain)]
    out += [(100 + i, plain[i % 4], "en", "a", None) for i in range(20)]  # exact copies
    out += [(200 + i, plain[5] + f" tail{i}", "en", "a", 1) for i in range(5)]  # near copies
    out += [(300, None, None, None, None), (301, "", "en", "", 0), (302, " \t\n\x0b\x0c\r ", "en", "a", 6), (303, "word", "en", "a", 4),
            (304, "two words \U0001f600", "xx", "a", 9), (305, " ".join(plain) * 3, "en", "hot", 1), (306, "0" * 5000, "en", "hot", 5000),
            (None, plain[7], "en", "a", 3), (None, None, None, None, None), (307, plain[8], "en", "a", 3), (307, plain[8], "en", "a", 3),
            (-5, plain[9], "en", "a", 3), (308, "nul\0byte " * 30, "en", "a", 3)]
    return out


def documents(spark, partitions: int = 5):
    return spark.createDataFrame(rows(), SCHEMA).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    """More columns, named like those that operators make."""
    names = ("row", "group", "shard", "slot", "fingerprint", "component_id", "key", "size", "score", "kept", "spans", "h", "value", "piece", "at", "start")
    return df.withColumns({c: F.lit("other").alias(c) for c in names})
