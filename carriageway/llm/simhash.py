"""SimHash near-duplicates over an inverted index of positional bytes.

A fingerprint has eight positional bytes. Two fingerprints within the maximum
distance d differ in at most d bytes, so they share at least 8 - d: the
guaranteed minimum. The index holds small sets of positional bytes, chosen so
that every set of the minimum size contains one; a posting list then joins
only fingerprints that already share these bytes. For each pair the join
tallies all shared positional bytes, keeps pairs that reach the minimum,
takes a pair only in the first of its posting lists, and verifies the bits.

Equal fingerprints are one entry of the index, so copies cost one row, however
many there are. Links become components by stars (``components``).

Defined results: a null or blank text has fingerprint zero and links like any
other; rows without id take part and never name a component unless no row of
it has an id; repeated rows share their fingerprint; an empty table gives no
rows; further columns are carried by ``one_of_each`` only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carriageway.llm.common import whole_text
from carriageway.llm.components import components
from carriageway.operators.settle import settled

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Positional bytes in one index key; more make shorter posting lists and more keys.
KEY_BYTES = 3


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: those set in over half of the shingles' hashes, repeats included."""
    words = (text or "").encode().lower().split()  # bytes: A-Z alone change, and the six ASCII white spaces split
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-shingle]]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprinted(docs: DataFrame, shingle: int = SHINGLE, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns and ``_fp``, the fingerprint as a signed long."""
    rows = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)], whole_text().alias("_text"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    kept = [f"_c{i}" for i in range(len(carry))]

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(x.as_py(), shingle) for x in batch.column("_text")], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(prints, pa.int64())], [*kept, "_fp"])

    out = rows.mapInArrow(batches_of, ", ".join([*[f"{c} {kinds[c]}" for c in kept], "_fp long"]))
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], "_fp")


def key_sets(distance: int, key_bytes: int = KEY_BYTES) -> list[tuple[int, ...]]:
    """Sets of byte positions such that any ``8 - distance`` positions contain one, chosen greedily."""
    least = 8 - distance
    if least < 1:
        raise ValueError("eight bytes guarantee a shared one up to distance 7 only")
    open_sets = set(combinations(range(8), least))
    choices, picked = list(combinations(range(8), min(key_bytes, least))), []
    while open_sets:
        best = max(choices, key=lambda c: sum(set(c) <= set(s) for s in open_sets))
        picked.append(best)
        open_sets = {s for s in open_sets if not set(best) <= set(s)}
    return picked


def byte_at(bits: Column, position: int) -> Column:
    return F.shiftrightunsigned(bits, 8 * position).bitwiseAND(F.lit(255))


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (u, v), u < v, of distinct fingerprints ``_fp`` within the distance."""
    sets = key_sets(distance)
    keys = []
    for k, positions in enumerate(sets):
        key = F.lit(k).cast("long")
        for p in positions:
            key = F.shiftleft(key, 8).bitwiseOR(byte_at(F.col("_fp"), p))
        keys.append(key)
    posted = prints.select("_fp", F.explode(F.array(*keys)).alias("key"))
    left, right = posted.toDF("u", "key_u"), posted.toDF("v", "key_v")
    apart = F.col("u").bitwiseXOR(F.col("v"))
    same = [byte_at(apart, p) == 0 for p in range(8)]
    tally = sum((s.cast("int") for s in same[1:]), same[0].cast("int"))
    # The first key of a pair is the first set all of whose bytes are shared.
    mask = sum((F.when(s, F.lit(1 << p)).otherwise(0) for p, s in enumerate(same[1:], 1)), F.when(same[0], F.lit(1)).otherwise(0))
    first_of = [next((k for k, c in enumerate(sets) if all(m >> p & 1 for p in c)), -1) for m in range(256)]
    first = F.element_at(F.array(*[F.lit(x) for x in first_of]), mask + 1)
    key_bits = 8 * len(sets[0])
    return left.join(right, (F.col("key_u") == F.col("key_v")) & (F.col("u") < F.col("v")) & (tally >= 8 - distance)
                     & (F.bit_count(apart) <= distance) & (first == F.shiftright(F.col("key_u"), key_bits))).select("u", "v")


def classes(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(_class_fp, _root, component_id) per distinct fingerprint of rows with ``doc_id`` and ``_fp``."""
    distinct = settled(rows.groupBy("_fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = settled(components(settled(links(distinct.select("_fp"), distance), "simhash-links")), "simhash-roots")
    named = distinct.join(roots, F.col("_fp") == F.col("node"), "left").select("_fp", "least", F.coalesce("root", "_fp").alias("_root"))
    # Only fingerprints with a link share a root; the others name themselves.
    shared = (distinct.join(roots, F.col("_fp") == F.col("node")).groupBy(F.col("root").alias("shared_root"))
              .agg(F.min("least").alias("component_least")))
    return named.join(shared, F.col("_root") == F.col("shared_root"), "left").select(
        F.col("_fp").alias("_class_fp"), "_root",
        F.when(F.col("shared_root").isNull(), F.col("least")).otherwise(F.col("component_least")).alias("component_id"))


def report(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) per document."""
    rows = settled(fingerprinted(docs, shingle), "simhash-rows")
    return rows.join(classes(rows, distance), F.col("_fp") == F.col("_class_fp")).select(
        "doc_id", F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The documents with the first row, by id, of each component only.

    The rows are written once with their fingerprint; what goes is a list of row numbers.
    """
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    rows = settled(fingerprinted(numbered, shingle, (*docs.columns, "_row")), "simhash-documents")
    narrow = rows.select("doc_id", "_row", "_fp")
    own = classes(narrow, distance)
    joined = narrow.join(own, F.col("_fp") == F.col("_class_fp"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("_row"))
    first = joined.groupBy(F.col("_root").alias("first_root")).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = (joined.join(first, F.col("_root") == F.col("first_root")).where(F.col("_row") != F.col("first._row"))
            .select(F.col("_row").alias("gone")))
    # What goes is a share of the rows, so it is never broadcast.
    return rows.join(settled(gone, "simhash-gone").hint("merge"), F.col("_row") == F.col("gone"), "left_anti").select(*docs.columns)
