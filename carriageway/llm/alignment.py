"""Tokens of two vocabularies aligned by the bytes they cover, and corpus counts of aligned id pairs.

No token of either vocabulary covers a space in its middle, but for runs of spaces,
so a text is cut into chunks at spaces, and each side's tokens of a chunk are the
same in any text. A chunk that a worker has not met is encoded by both vocabularies.
Every token of such chunks is a row (chunk, first byte, place); ``pandas.merge_asof``
keyed by chunk finds for each token start the other side's token that covers it, in
both directions, and the union of the two gives all overlapping pairs. Bytes where
tokens of both sides end cut them into groups. A text has the counts, groups and
pairs of its chunks, one after another.

What leaves a batch is a row per document with its digests and its distinct id
pairs. Counts of pairs are sums with partial aggregation. Documents meet the
counts again in two tiers: the pairs of the highest counts, a table of at most
``HEAVY`` rows, are broadcast; the links of all other pairs, none of them
frequent, meet theirs by a shuffle. So no id pair is a hot key, however common.

Defined results: a null or empty text, and one whose bytes either vocabulary
does not give back, has no tokens: zeros and an empty digest. A null ``doc_id``
stays null; repeated rows are aligned, and counted in the corpus, one by one;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carriageway.llm.common import whole_text
from carriageway.llm.packing import Ids
from carriageway.llm.token_counts import PreTokens
from carriageway.operators.settle import settled

A_VOCABULARY = "byte_bpe_50k"
B_VOCABULARY = "piece_bpe_32k"
#: Most pairs that are broadcast with their counts.
HEAVY = 1 << 18
#: Code points of the texts that are aligned at a time.
STEP = 1 << 19
#: Chunks, and code points in them, that a worker keeps; all are forgotten when there are more.
CACHE = 1 << 19
CACHE_SIZE = 1 << 23
#: Bits of an id in a packed pair.
ID_BITS = 20

#: Begins at a space that follows a character which is no white space, unless the text ends with this space.
CHUNK = re.compile(r"(?s:.)[^ ]*(?:(?:(?<=\s) | \Z)[^ ]*)*")

DIGESTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
ALIGNED = f"{DIGESTS}, a array<int>, b array<int>, times array<int>"


def byte_of_sign() -> dict[str, int]:
    """Bytes by the sign that stands for them in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Vocabularies:
    """Ids of chunks in both vocabularies, and the bytes of every id."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.pre, self.fast = PreTokens(a), Ids(a).fast
        self.a = self.pre.tokenizer
        self.a.encode_special_tokens = True  # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{b}.model"))
        sign = byte_of_sign()
        spec = json.loads(Path(public_tokenizers.path(f"{a}.json")).read_text())
        entries = {i: s for s, i in spec["model"]["vocab"].items()}
        special = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.a_bytes = [special[i] if i in special else bytes(sign[c] for c in entries.get(i, "")) for i in range(self.a.get_vocab_size())]
        self.b_bytes = [self.piece_bytes(i) for i in range(self.b.get_piece_size())]
        # With an entry for every byte, and nothing that changes a text before, A gives every text back.
        self.a_is_whole = set(sign) <= spec["model"]["vocab"].keys()
        # A's pre-tokens hold a space at their start only, or are white space; B's pieces have to, as well.
        self.has_chunks = not any(b" " in p[1:] and p.strip(b" ") for p in self.b_bytes)
        self.a_size, self.b_size = np.array(list(map(len, self.a_bytes))), np.array(list(map(len, self.b_bytes)))
        # Ids as text with what follows them in a digest, by kind: A within and at the end of a group, then B.
        self.parts = [f"{i}{mark}" for mark, n in ((",", len(self.a_bytes)), ("|", len(self.a_bytes)), (",", len(self.b_bytes)), (";", len(self.b_bytes))) for i in range(n)]

    def piece_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def chunks(self, text: str) -> list[str]:
        """The chunks of a space and a text; none of an empty text."""
        if not text:
            return []
        return CHUNK.findall(" " + text) if self.has_chunks else [" " + text]

    def encoded(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids of both sides, and whether both give the chunk back; there are none where either does not."""
        # Texts with code points that have no character: the libraries may take them for other kinds.
        a = [self.a.encode(c, add_special_tokens=False).ids if self.pre.is_odd(c) else self.fast.encode_ordinary(c) for c in chunks]
        b = self.b.encode([c[1:] for c in chunks], num_threads=1)  # it adds the space
        a_of, b_of = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        whole = np.ones(len(chunks), bool)
        for k, chunk in enumerate(chunks):
            raw = chunk.encode()
            if b"".join(map(b_of, b[k])) != raw or not self.a_is_whole and b"".join(map(a_of, a[k])) != raw:
                a[k], b[k], whole[k] = [], [], False
        return a, b, whole


def side_frame(ids: list[list[int]], sizes: np.ndarray) -> tuple[pd.DataFrame, np.ndarray]:
    """Rows (at, chunk, place) of all tokens of one side, by first byte in all chunks, and the tokens' ids."""
    flat = np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))
    ends = np.cumsum(sizes[flat])
    return pd.DataFrame({"at": ends - sizes[flat], "chunk": np.repeat(np.arange(len(ids)), [len(i) for i in ids]), "place": np.arange(len(flat))}), flat


def covering(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """For each token of ``left`` the token of ``right`` that covers its first byte, and whether both start there."""
    found = pd.merge_asof(left, right.assign(first=right["at"]), on="at", by="chunk", suffixes=("", "_other"))
    return found.assign(both=found["first"] == found["at"])


def aligned_chunks(chunks: list[str], both: Vocabularies) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Per chunk its counts (tokens of A and B, groups, links) with whether it is whole, and its part of a digest text; the id pairs of all chunks' links, by chunk."""
    n = len(chunks)
    a_ids, b_ids, whole = both.encoded(chunks)
    left, a = side_frame(a_ids, both.a_size)
    right, b = side_frame(b_ids, both.b_size)
    of_a, of_b = covering(left, right), covering(right, left)
    # The union of both directions; a pair that starts together is in both.
    own = of_b[~of_b["both"]]
    place_a = np.concatenate([of_a["place"].to_numpy(), own["place_other"].to_numpy()])
    place_b = np.concatenate([of_a["place_other"].to_numpy(), own["place"].to_numpy()])
    a_chunk, b_chunk = left["chunk"].to_numpy(), right["chunk"].to_numpy()
    # A group ends where the next common start or the chunk's end is.
    a_first, b_first = of_a["both"].to_numpy(), of_b["both"].to_numpy()
    a_group, b_group = np.cumsum(a_first) - 1, np.cumsum(b_first) - 1
    a_last, b_last = np.append(a_first[1:], a_first[:1]), np.append(b_first[1:], b_first[:1])
    # Digest text: the groups one after another, A's ids before B's.
    a_kind = a + a_last * len(both.a_bytes)
    b_kind = b + (2 * len(both.a_bytes)) + b_last * len(both.b_bytes)
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + np.flatnonzero(b_first)[a_group]] = a_kind
    order[np.arange(len(b)) + np.append(np.flatnonzero(a_first)[1:], len(a))[b_group]] = b_kind
    n_a, n_b = np.bincount(a_chunk, minlength=n), np.bincount(b_chunk, minlength=n)
    words, stops = list(map(both.parts.__getitem__, order.tolist())), np.cumsum(n_a + n_b).tolist()
    texts = ["".join(words[start:stop]) for start, stop in zip([0, *stops], stops)]
    chunk = a_chunk[place_a]
    pairs = ((a[place_a] << ID_BITS) | b[place_b])[np.argsort(chunk, kind="stable")]
    return np.stack([n_a, n_b, np.bincount(a_chunk[a_last], minlength=n), np.bincount(chunk, minlength=n), whole], 1), texts, pairs


class Memory:
    """Chunks that a worker has met, with how they are aligned; a bounded number of them."""

    def __init__(self, a: str, b: str):
        self.both = Vocabularies(a, b)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.size, self.counts, self.texts, self.pairs = 0, np.zeros((0, 5), np.int64), [], np.zeros(0, np.int64)

    def numbers(self, chunks: list[str]) -> np.ndarray:
        """The place of each chunk in ``counts`` and ``texts``. New ones are aligned; these are valid until the next call."""
        if len(self.number) > CACHE or self.size > CACHE_SIZE:
            self.forget()
        new = list(set(chunks).difference(self.number))
        if new:
            counts, texts, pairs = aligned_chunks(new, self.both)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.size += sum(map(len, new))
            self.counts, self.pairs = np.concatenate([self.counts, counts]), np.concatenate([self.pairs, pairs])
            self.texts += texts
        return np.fromiter(map(self.number.__getitem__, chunks), np.int64, len(chunks))


@cache
def memory(a: str, b: str) -> Memory:
    """One memory per worker, kept for its later tasks."""
    return Memory(a, b)


def aligned_batch(ids: pa.Array, texts: list[str], known: Memory) -> pa.RecordBatch:
    """The row of each text of a batch."""
    n = len(texts)
    chunks = list(map(known.both.chunks, texts))
    number = known.numbers(list(chain.from_iterable(chunks)))
    doc = np.repeat(np.arange(n), list(map(len, chunks)))
    # A text with a chunk that either side does not give back has no tokens.
    whole = np.bincount(doc[known.counts[number, 4] == 0], minlength=n) == 0
    number, doc = number[whole[doc]], doc[whole[doc]]
    n_a, n_b, n_groups, n_links = (np.bincount(doc, known.counts[number, k], minlength=n).astype(np.int64) for k in range(4))
    held, stops = list(map(known.texts.__getitem__, number.tolist())), np.cumsum(np.bincount(doc, minlength=n)).tolist()
    shas = [hashlib.sha256("".join(held[start:stop])[:-1].encode()).hexdigest() if stop > start else "" for start, stop in zip([0, *stops], stops)]
    # The links of every chunk where it occurs.
    links = known.counts[number, 3]
    before = np.cumsum(known.counts[:, 3]) - known.counts[:, 3]
    at = np.repeat(before[number] - (np.cumsum(links) - links), links) + np.arange(links.sum())
    packed = (np.repeat(doc, links) << (2 * ID_BITS)) | known.pairs[at]
    distinct, times = np.unique(packed, return_counts=True)
    bounds = pa.array(np.searchsorted(distinct >> (2 * ID_BITS), np.arange(n + 1)).astype(np.int32))
    mask = (1 << ID_BITS) - 1
    lists = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in ((distinct >> ID_BITS) & mask, distinct & mask, times)]
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(n_links), pa.array(shas, pa.string()), *lists],
        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "times"])


def aligned(docs: DataFrame, a: str = A_VOCABULARY, b: str = B_VOCABULARY) -> DataFrame:
    """Per document: counts, the digest of its groups, and its distinct id pairs with their links."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            start, held, size = 0, [], 0
            for k, text in enumerate(texts):
                held.append(text.as_py())
                size += len(held[-1])
                if size >= STEP or k + 1 == len(texts):
                    yield aligned_batch(ids.slice(start, len(held)), held, memory(a, b))
                    start, held, size = k + 1, [], 0

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(align, ALIGNED)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a, b, n, best): links of each id pair in the corpus, and whether no other A id has more with this B id."""
    counts = settled(rows.select(F.inline(F.arrays_zip("a", "b", "times"))).groupBy("a", "b").agg(F.sum("times").alias("n")), "alignment-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))  # a row per id of a vocabulary
    return counts.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def heavy_from(counts: DataFrame, most: int) -> int:
    """The least power of two such that at most ``most`` pairs have that count or more."""
    sizes = {r["k"]: r["rows"] for r in counts.groupBy(F.length(F.bin("n")).alias("k")).agg(F.count(F.lit(1)).alias("rows")).collect()}  # 64 rows at most
    cut, total = 64, 0
    while cut > 0 and total + sizes.get(cut, 0) <= most:
        total += sizes.get(cut, 0)
        cut -= 1
    return 1 << cut


def report(docs: DataFrame, a: str = A_VOCABULARY, b: str = B_VOCABULARY, heavy: int = HEAVY) -> DataFrame:
    """The digests of each document, with how its links rank in the corpus."""
    rows = settled(aligned(docs, a, b).withColumn("row", F.monotonically_increasing_id()), "alignment-rows")
    counts = settled(pair_counts(rows), "alignment-pairs")
    cut = heavy_from(counts, heavy)
    top, rest = counts.where(F.col("n") >= cut), counts.where(F.col("n") < cut)
    links = rows.select("row", F.inline(F.arrays_zip("a", "b", "times")))
    score = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    near = links.join(F.broadcast(top), ["a", "b"]).groupBy("row").agg(*score)
    far = links.join(F.broadcast(top.select("a", "b")), ["a", "b"], "left_anti").join(rest, ["a", "b"]).groupBy("row").agg(*score)
    sums = near.unionByName(far).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    return rows.select(*names, "row").join(sums, "row", "left").select(
        *names[:5], F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
