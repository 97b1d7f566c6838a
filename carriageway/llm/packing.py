"""Documents packed into sequences of a fixed number of tokens.

Every text is tokenized once; from there on only (piece, length) rows move.
Pieces that fill a sequence are done. The others are dealt into groups of about
``GROUP_ITEMS`` pieces, and each group is packed by best-fit decreasing. Two
families of dual-feasible functions bound the bins a group needs from below: a
group that reaches its bound is certified. The loose bins of groups with a gap,
and the loosest bin of certified groups, go into a pool that is dealt anew, so
that groups exchange documents, and packed again, as long as that saves
sequences.

A group is the most that one task holds, whatever the input; the driver sees
counts only.

Defined results: a null text is empty and makes one piece with the end id
alone; repeated rows and rows without id are packed one by one; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carriageway.llm.common import whole_text
from carriageway.operators.settle import settled

SEQUENCE = 1024
END_ID = 2
GROUP_ITEMS = 8192
VOCABULARY = "byte_bpe_50k"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, row long, sequence_id long, offset long, again boolean, gap int"


class Ids:
    """Token ids of texts: a vocabulary file's ids, from the faster of two libraries that agree on them.

    A text that contains the string of a special token goes to ``tokenizers``,
    which gives such strings their own id.
    """

    def __init__(self, vocabulary: str):
        path = public_tokenizers.path(f"{vocabulary}.json")
        self.exact = Tokenizer.from_file(path)
        self.special = [t["content"] for t in json.loads(Path(path).read_text())["added_tokens"]]
        lines = Path(public_tokenizers.path(f"{vocabulary}.tiktoken")).read_bytes().split(b"\n")
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line)}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> Sequence[int]:
        if any(s in text for s in self.special):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: one if they fit, else full ones behind a shorter first."""
    if n <= size:
        return [(0, n)]
    first = n % size
    return ([(0, first)] if first else []) + [(s, size) for s in range(first, n, size)]


def pieces(docs: DataFrame, size: int = SEQUENCE, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece of a document's ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = None
        for batch in batches:
            ids_of = ids_of or Ids(vocabulary)
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.asarray([*ids_of(text.as_py()), END_ID], dtype="<u4")
                for k, (start, length) in enumerate(cuts(len(ids), size)):
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[start:start + length].tobytes())))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(cut, PIECES)


def fewest_bins(lengths: np.ndarray, size: int) -> int:
    """Lower bound for the bins of pieces of these lengths, by dual-feasible functions.

    First family, a threshold t up to half a bin: lengths over size - t count
    as a whole bin, those below t as nothing. Second, a number k: a length
    counts floor((k + 1) x / size) / k bins, or x / size where that is exact.
    """
    count = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    x = np.arange(size + 1)
    items, mass = np.cumsum(count), np.cumsum(count * x)
    t = np.arange(0, size // 2 + 1)
    below = np.where(t > 0, mass[np.maximum(t - 1, 0)], 0)
    first = size * (items[-1] - items[size - t]) + mass[size - t] - below
    best = int(-(-first.max() // size))
    for k in range(1, 33):
        whole, rest = np.divmod((k + 1) * x, size)
        twice = np.where(rest == 0, x * k, whole * size)  # in units of 1 / (k * size) bins
        best = max(best, int(-(-int((count * twice).sum()) // (k * size))))
    return best


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each piece, by best-fit decreasing."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(size + 1)]  # by room left
    rooms, made = 0, 0  # a bit for each room that some bin has
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            b, room, made = made, size, made + 1
        bins[i], offsets[i] = b, size - room
        left = room - length
        if left:
            open_bins[left].append(b)
            rooms |= 1 << left
    return bins, offsets


def pack_groups(rows: DataFrame, size: int, turn: int, n: int) -> DataFrame:
    """Rows dealt into groups and packed; ``again``: the row's bin is one to exchange; ``gap``: bins over the bound."""
    groups = -(-n // GROUP_ITEMS)

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("row", kind="stable")
        lengths = part["length"].to_numpy(np.int64)
        bins, offsets = best_fit(lengths, size)
        filled = np.bincount(bins, weights=lengths).astype(np.int64)
        gap = len(filled) - fewest_bins(lengths, size)
        loose = filled < size
        if gap == 0:
            loose &= filled == filled.min()
        out = part.assign(sequence_id=(turn << 44) + (int(key[0]) << 14) + bins, offset=offsets, again=loose[bins], gap=gap)
        return out[[x.split()[0] for x in PACKED.split(", ")]]

    dealt = rows.withColumn("group", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(pack, PACKED)


def packed(docs: DataFrame, size: int = SEQUENCE, vocabulary: str = VOCABULARY) -> DataFrame:
    """Every piece with its sequence and the place in it."""
    every = settled(pieces(docs, size, vocabulary).withColumn("row", F.monotonically_increasing_id()), "packing-pieces")
    out = [x.split()[0] for x in PIECES.split(", ")] + ["sequence_id", "offset"]
    whole = every.where(F.col("length") == size).withColumns({"sequence_id": -1 - F.col("row"), "offset": F.lit(0).cast("long")})
    done, pool = [whole.select(*out)], every.where(F.col("length") < size)
    n, before, turn = pool.count(), None, 0
    while n:  # every further turn saves a bin, or is the last
        turn += 1
        now = settled(pack_groups(pool, size, turn, n), "packing-round")
        counts = now.agg(F.count_if("again").alias("rows"), F.countDistinct("sequence_id").alias("bins"),
                         F.countDistinct(F.when(F.col("again"), F.col("sequence_id"))).alias("loose")).collect()[0]
        if before is not None and counts["bins"] >= before["loose"]:
            break  # the exchange saved nothing: the bins stay as they were
        if before is not None:
            done[-1] = done[-1].where(~F.col("again"))
        done.append(now)
        pool, n, before = now.where("again").select(*[x.split()[0] for x in PIECES.split(", ")], "row"), counts["rows"], counts
        if n <= 1 or counts["loose"] <= 1:
            break
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part.select(*out))
    return result
