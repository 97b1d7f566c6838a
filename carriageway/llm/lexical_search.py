"""Ranked lexical search over impact-sorted lists, read in order with score intervals (NRA).

The documents are cut into segments, and each segment has its own lists, so a
term that every document holds is no hot key. One pass over the texts writes, per
document, its length and the frequencies of the query terms; corpus counts are
aggregates of that table. In a segment, a term's list holds (impact, document)
by falling impact. An item's lists are read from the top, in blocks of doubling
depth: a document's lower bound is the sum of the impacts read, its upper bound
adds, for each list it has not been met in, the impact that the list has come
down to. Reading goes on until no document outside the best ones can reach them,
ties included, and the bounds of those that can have met. The tenth best
final score of a task's earlier segments is a floor for its later ones. What
leaves a task are its best documents per item, which merge by a limited window.

Queries are answered in blocks of items of about ``PAIRS`` (item, term) pairs;
a block's terms and weights are all that is sent to the tasks.

Defined results: every row of documents counts as a document of its own, and
every row of items as an item, repeated ids or not; null texts have no terms;
items without a term or a scoring document give no rows; documents without id
rank behind others of equal score; empty tables give no rows; further columns
are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carriageway.llm.common import whole_text
from carriageway.operators.settle import settled

BEST = 10
#: (item, term) pairs of a block of items.
PAIRS = 1 << 19
#: Documents of a segment, and the first depth to which lists are read.
SEGMENT = 1 << 13
DEPTH = 64
#: Score of a term: weight times SCALE * tf div (1000 * tf + 8 * m), with m between 10 and more for long documents.
SCALE = 1_000_000_000

TERMS = "doc_id long, n long, terms array<int>, tfs array<int>"
FOUND = "item long, doc_id long, score long, task long"

#: Bytes that part terms, as blanks; A-Z in lower case. Bytes over 0x7F belong to terms.
_FOLD = bytes((b | 0x20) if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a whole text, in order."""
    return (text or "").encode().translate(_FOLD).split()


def term_counts(text: str | None) -> Counter:
    return Counter(terms_of(text))


def impacts(weight, tf, m):
    """Integer score of a term in a document."""
    return weight * ((SCALE * tf) // (1000 * tf + 8 * m))


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, term): the distinct terms of each row of items."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(term_counts(t.as_py())) for t in batch.column("text")]
            at = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("item").take(pa.array(at)), batch.column("item_id").take(pa.array(at)), pa.array([t for f in found for t in f], pa.binary())],
                ["item", "item_id", "term"])

    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), whole_text().alias("text"))
    return rows.mapInArrow(split, "item long, item_id long, term binary")


def found_terms(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """Per document with a term: its terms with repeats (n), and number and frequency of those in ``numbers``."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            kept, n, sizes, terms, tfs = [], [], [0], [], []
            for k, text in enumerate(batch.column("text")):
                counts = term_counts(text.as_py())
                if not counts:
                    continue
                kept.append(k)
                n.append(counts.total())
                for term, tf in counts.items():
                    t = number(term)
                    if t is not None:
                        terms.append(t)
                        tfs.append(tf)
                sizes.append(len(terms))
            bounds = pa.array(sizes, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(kept, pa.int64())), pa.array(n, pa.int64()),
                 *[pa.ListArray.from_arrays(bounds, pa.array(x, pa.int32())) for x in (terms, tfs)]],
                ["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(count, TERMS)


class Segment:
    """Impact-sorted lists of the query terms of some documents."""

    def __init__(self, doc_ids: list[int | None], n: np.ndarray, terms: np.ndarray, tfs: np.ndarray, sizes: np.ndarray, weights: np.ndarray, corpus: tuple[int, int]):
        self.doc_ids, self.size = doc_ids, len(doc_ids)
        total, length = corpus
        m = 10 + (90 * n * total) // length
        doc = np.repeat(np.arange(self.size), sizes)
        impact = impacts(weights[terms], tfs.astype(np.int64), m[doc])
        used = impact > 0
        order = np.lexsort((-impact[used], terms[used]))
        self.doc, self.impact, terms = doc[used][order], impact[used][order], terms[used][order]
        self.start = np.searchsorted(terms, np.arange(len(weights) + 1))
        self.reads = 0  # list entries read so far

    def best(self, terms: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """(score, document) of the best ``k`` for these terms, and of more that tie with the last; only scores of at least ``floor``."""
        start, stop = self.start[terms], self.start[terms + 1]
        start, stop = start[start < stop], stop[start < stop]
        lower, read, depth = np.zeros(self.size, np.int64), start.copy(), DEPTH
        while True:
            upto = np.minimum(start + depth, stop)
            for t in range(len(start)):
                lower[self.doc[read[t]:upto[t]]] += self.impact[read[t]:upto[t]]
            self.reads += int((upto - read).sum())
            read = upto
            frontier = np.where(read < stop, self.impact[np.maximum(read - 1, start)], 0)
            upper = lower + frontier.sum()
            for t in np.flatnonzero(frontier):
                upper[self.doc[start[t]:read[t]]] -= frontier[t]
            least = max(floor, int(np.partition(lower, -k)[-k]) if self.size >= k else 0, 1)
            able = np.flatnonzero(upper >= least)
            if (lower[able] == upper[able]).all():  # all that can be among the best have their final score
                return [(int(lower[d]), int(d)) for d in able]
            depth *= 2


def by_rank(score: int, doc_id: int | None) -> tuple:
    return (-score, doc_id is None, doc_id or 0)


def search_segments(rows: DataFrame, items: dict[int, list[int]], weights: list[int], corpus: tuple[int, int], k: int) -> DataFrame:
    """The best documents of each task for each item; ``rows`` as ``found_terms`` gives them."""
    shared = rows.sparkSession.sparkContext.broadcast((items, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int | None]]] = defaultdict(list)
        task, of_items, weight = 0, {}, None
        for batch in batches:
            if weight is None and batch.num_rows:
                of_items, weight = {i: np.array(t) for i, t in shared.value[0].items()}, np.array(shared.value[1], np.int64)
                task = batch.column("task")[0].as_py()
            for at in range(0, batch.num_rows, SEGMENT):
                part = batch.slice(at, SEGMENT)
                terms, tfs = part.column("terms"), part.column("tfs")
                segment = Segment(part.column("doc_id").to_pylist(), part.column("n").to_numpy(), terms.flatten().to_numpy(), tfs.flatten().to_numpy(),
                                  terms.value_lengths().to_numpy(), weight, corpus)
                for item, numbers in of_items.items():
                    held = best[item]
                    floor = held[k - 1][0] if len(held) >= k else 0
                    held += [(s, segment.doc_ids[d]) for s, d in segment.best(numbers, k, floor)]
                    held.sort(key=lambda x: by_rank(*x))
                    del held[k:]
        out = [(item, doc_id, score, task) for item, held in best.items() for score, doc_id in held]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 4, ["item", "doc_id", "score", "task"])

    return rows.withColumn("task", F.spark_partition_id().cast("long")).mapInArrow(search, FOUND)


def ten_best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each item with their rank; the window's limit works in every task before its shuffle."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = Window.partitionBy("item", F.pmod("task", F.lit(64))).orderBy(*order)
    every = Window.partitionBy("item").orderBy(*order)
    return (found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
            .withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= k))


def search_block(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """Ranks for one block of items; ``pairs`` are its (item, item_id, term) rows, about ``PAIRS`` of them."""
    of_items: dict[int, list[int]] = defaultdict(list)
    numbers: dict[bytes, int] = {}
    for r in pairs.select("item", "term").toLocalIterator():
        of_items[r["item"]].append(numbers.setdefault(bytes(r["term"]), len(numbers)))
    rows = settled(found_terms(docs, numbers), "search-terms")
    total, length = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = [0] * len(numbers)
    for r in rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():  # a row per query term
        weights[r["t"]] = math.floor(1000 * math.log((2 * total + 2) / (2 * r["df"] + 1)))
    useful = {i: [t for t in terms if weights[t] > 0] for i, terms in of_items.items()}
    found = search_segments(rows, {i: t for i, t in useful.items() if t}, weights, (total, max(length, 1)), k)
    names = pairs.select("item", "item_id").distinct()
    return ten_best(found, k).join(names, "item").select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    pairs = settled(item_terms(items), "search-items")
    blocks = max(1, -(-pairs.count() // PAIRS))
    if blocks == 1:
        return search_block(docs, pairs, k)
    result = None
    for block in range(blocks):
        part = search_block(docs, pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block), k)
        result = part if result is None else result.unionByName(part)
    return result
