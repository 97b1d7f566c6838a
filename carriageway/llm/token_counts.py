"""Token counts of whole texts by a two-tier lookup of pre-token lengths, on the map side only.

A byte-level vocabulary cuts a text into pre-tokens first and encodes each by
itself, so a text's count is the sum of its pre-tokens' lengths. One pass over
all texts keeps a mergeable sketch of frequent pre-tokens (Misra-Gries counters,
``FREQUENT`` at most); sketches of tasks merge in a tree of a few rows each.
Their lengths, a table of bounded size, are broadcast. The second pass sums
lengths: a pre-token of the table costs one lookup, any other is encoded once by
the library and kept in the worker's cache, which starts anew when full. No
pre-token is shuffled; the sketch decides the speed, never a count.

Defined results: a null text is empty and has no tokens; a null ``doc_id``
stays null; repeated rows are counted one by one; an empty table gives no rows;
further columns are ignored. The strings of special tokens inside a text count
as one token each, as the library does by default. Long texts are cut where a
letter is followed by a blank and a letter, which is always between two
pre-tokens.
"""

from __future__ import annotations

import json
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carriageway.llm.common import whole_text

LIMIT = 1024
VOCABULARY = "byte_bpe_50k"
#: Entries of the broadcast table and counters of a sketch: below one MB.
FREQUENT = 1 << 15
#: Pre-tokens that a worker keeps beside the broadcast table.
CACHE = 1 << 19
#: Code points of the longest pre-token that is kept; longer ones are encoded each time.
LONGEST = 64
#: Code points that are cut into pre-tokens at a time.
PART = 1 << 17

COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
SKETCH = "part long, tokens array<string>, counts array<long>"

_CUT = regex.compile(r"[A-Za-z](?= [A-Za-z])")


class PreTokens:
    """Pre-tokens of a byte-level vocabulary file and their lengths in tokens."""

    def __init__(self, vocabulary: str = VOCABULARY):
        path = public_tokenizers.path(f"{vocabulary}.json")
        spec = json.loads(Path(path).read_text())
        pre = spec["pre_tokenizer"] or {}
        plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"])
        if pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space") or spec["normalizer"] or not plain:
            raise ValueError(f"{vocabulary} does not encode its pre-tokens one by one")
        self.tokenizer = Tokenizer.from_file(path)
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.known: set[str] = set()

    def length(self, piece: str) -> int:
        return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def is_odd(self, text: str) -> bool:
        """Whether a text holds code points without a character, of whose kind libraries may have other tables."""
        if text.isascii():
            return False
        new = set(text) - self.known
        odd = {c for c in new if unicodedata.category(c) == "Cn"}
        self.known |= new - odd
        return bool(odd)

    def between_special(self, text: str) -> list[str]:
        return self.special.split(text) if self.special and self.special.search(text) else [text]

    def lists(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text without special strings, in lists of bounded size."""
        at = 0
        while len(text) - at > PART:
            cut = _CUT.search(text, at + PART)
            if cut is None:
                break
            yield self.find(text[at:cut.end()])
            at = cut.end()
        yield self.find(text[at:])


class Lengths(dict):
    """Lengths by pre-token: the frequent ones, and those met in this worker, which are forgotten when there are ``CACHE`` of them."""

    def __init__(self, frequent: dict[str, int], source: PreTokens, cache: int = CACHE):
        super().__init__(frequent)
        self.frequent, self.source, self.most = frequent, source, len(frequent) + cache

    def __missing__(self, piece: str) -> int:
        n = self.source.length(piece)
        if len(piece) <= LONGEST:
            if len(self) >= self.most:
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if self.source.is_odd(text):
            return self.source.length(text)
        parts = self.source.between_special(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, pieces)) for part in parts for pieces in self.source.lists(part))


def pruned(counts: Counter, size: int) -> Counter:
    """The ``size`` greatest counters, less the next one: no count is too low by more than rows / size."""
    if len(counts) <= size:
        return counts
    first = counts.most_common(size + 1)
    least = first[-1][1]
    return Counter({k: n - least for k, n in first[:-1] if n > least})


def merged(rows: Iterable[tuple], size: int) -> Counter:
    """One sketch from several, each a pair of pre-tokens and counts."""
    total: Counter = Counter()
    for tokens, counts in rows:
        for token, n in zip(tokens, counts):
            total[token] += int(n)
        total = pruned(total, size)
    return total


def sketches(docs: DataFrame, size: int, vocabulary: str) -> DataFrame:
    """One sketch per task, over all its texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, part, counts = None, None, Counter()
        for batch in batches:
            source = source or PreTokens(vocabulary)
            for text in batch.column("text"):
                for part_text in source.between_special(text.as_py()):
                    for pieces in source.lists(part_text):
                        counts.update(pieces)
                        if len(counts) > 8 * size:
                            counts = pruned(counts, size)
            part = batch.column("part")[0] if part is None and batch.num_rows else part
        counts = pruned(Counter({k: n for k, n in counts.items() if len(k) <= LONGEST}), size)
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.as_py()], pa.int64()), pa.array([list(counts)], pa.list_(pa.string())), pa.array([list(counts.values())], pa.list_(pa.int64()))],
                ["part", "tokens", "counts"])

    rows = docs.select(whole_text().alias("text"), F.spark_partition_id().cast("long").alias("part"))
    return rows.mapInArrow(count, SKETCH)


def frequent_tokens(docs: DataFrame, size: int = FREQUENT, vocabulary: str = VOCABULARY, fan: int = 64) -> list[str]:
    """Frequent pre-tokens of all texts. Sketches merge by ``fan`` at a time, so no task holds more than that many."""

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = merged(zip(rows["tokens"], rows["counts"]), size)
        return pd.DataFrame({"part": [key[0]], "tokens": [list(total)], "counts": [list(total.values())]})

    level = sketches(docs, size, vocabulary)
    for _ in range(3):  # 64 ** 3 tasks leave one sketch
        level = level.withColumn("part", F.floor(F.col("part") / fan)).groupBy("part").applyInPandas(merge, SKETCH)
    return list(merged(((r["tokens"], r["counts"]) for r in level.toLocalIterator()), size))


def compact(tokens: list[str], source: PreTokens) -> tuple[bytes, bytes, bytes]:
    """The table as three flat arrays: bytes of all pre-tokens, where each ends, lengths."""
    lengths = [len(e.ids) for e in source.tokenizer.encode_batch_fast(tokens, add_special_tokens=False)] if tokens else []
    raw = [t.encode() for t in tokens]
    ends = np.cumsum([len(r) for r in raw], dtype=np.uint32) if raw else np.zeros(0, np.uint32)
    return b"".join(raw), ends.tobytes(), np.array(lengths, np.uint16).tobytes()


def opened(table: tuple[bytes, bytes, bytes]) -> dict[str, int]:
    raw, ends = table[0], np.frombuffer(table[1], np.uint32).tolist()
    lengths = np.frombuffer(table[2], np.uint16).tolist()
    return {raw[a:b].decode(): n for a, b, n in zip([0, *ends], ends, lengths)}


def counted(docs: DataFrame, limit: int = LIMIT, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per document."""
    table = docs.sparkSession.sparkContext.broadcast(compact(frequent_tokens(docs, vocabulary=vocabulary), PreTokens(vocabulary)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = None
        for batch in batches:
            lengths = lengths if lengths is not None else Lengths(opened(table.value), PreTokens(vocabulary))
            text = batch.column("text")
            n = np.fromiter((lengths.count(t.as_py()) for t in text), np.int64, len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.cast(pc.binary_length(text), pa.int64()), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(count, COUNTS)
