"""Byte passages that also start earlier, by a run-length index over routed segments.

A window is a string of ``LENGTH`` bytes. Its anchor is the byte 24-gram of
least hash in it, so equal windows have equal anchors at equal places, and all
windows of a text fall into segments: runs of windows with one anchor.

1. Each text emits one narrow row per segment: anchor, hash of the segment's
   bytes, document, place. Inside one batch equal segments but the first are
   marked at once, so copies of one text hardly leave their task.
2. Sorted by (anchor, segment), a row equal to the one before it is a repeat
   as a whole. Segments that share an anchor but not all bytes are looked at
   closer; only their bytes are fetched.
3. Segments of whole anchors, a bounded number of bytes at a time, get a
   suffix array and its run-length Burrows-Wheeler transform. Matches with the
   lexicographic neighbour are compared at run heads only; all other match
   lengths follow by streaming through the text, one byte less per step. A
   window is a repeat if it matches ``LENGTH`` bytes within a group of
   neighbours that holds an earlier start.
   An anchor with more than ``GROUP_SEGMENTS`` different segments is split by
   the hash of its windows instead, with partial aggregation.
4. The marks of a document become maximal runs of removed bytes.

Defined results: a null text is empty; rows without id come after all others;
rows that share an id are told apart by a hash of their text, and of rows equal
in id and text all but one lose every byte a window covers; texts shorter than
a window lose nothing; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carriageway.llm.common import whole_text
from carriageway.operators.settle import settled

LENGTH = 100
GRAM = 24
CHUNK_BYTES = 4 << 20
INDEX_BYTES = 1 << 19
GROUP_SEGMENTS = 2048
NO_ID = (1 << 63) - 1

_SEGMENT = "anchor long, seg long, doc long, at long, shape int"
_MARK = "doc long, at long, n int"


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position that has as many."""
    x = data.astype(np.uint64)
    x = x[:-1] | (x[1:] << np.uint64(8))
    x = x[:-2] | (x[2:] << np.uint64(16))
    x = x[:-4] | (x[4:] << np.uint64(32))
    n = len(data) - GRAM + 1
    h = x[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= mixed(x[8:8 + n] + np.uint64(0x632BE59BD9B4E019))
    h = mixed(h) + x[16:16 + n] * np.uint64(0xD6E8FEB86659FD93)
    return mixed(h)


def least_places(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the first least value among ``width`` from each position that has as many."""
    value, place, span = h, np.arange(len(h), dtype=np.int64), 1
    while span * 2 <= width:
        left, right = value[:-span], value[span:]
        later = right < left
        value = np.where(later, right, left)
        place = np.where(later, place[span:], place[:-span])
        span *= 2
    if rest := width - span:
        left, right = value[:-rest], value[rest:]
        place = np.where(right < left, place[rest:], place[:-rest])
    return place


def tiled(h: np.ndarray, first: np.ndarray, length: np.ndarray, most: int) -> np.ndarray:
    """Hash of the bytes [first, first + length), from the gram hashes that cover them."""
    out = mixed(length.astype(np.uint64))
    for k in range(-(-most // GRAM)):
        at = np.minimum(first + GRAM * k, first + length - GRAM)
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[at])
    return out


def segments_of(data: np.ndarray, owner_start: np.ndarray, owner_length: np.ndarray) -> tuple[np.ndarray, ...]:
    """(owner, first window, windows, anchor place, anchor hash, segment hash) of texts laid one after another."""
    if len(data) < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),) * 2
    h = gram_hashes(data)
    place = least_places(h, LENGTH - GRAM + 1)
    counts = np.maximum(owner_length - LENGTH + 1, 0)
    owner = np.repeat(np.arange(len(owner_start)), counts)
    starts = np.repeat(owner_start - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(len(owner))
    anchors = place[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    n = np.diff(np.concatenate([head, [len(starts)]]))
    first, anchor = starts[head], anchors[head]
    seg = tiled(h, first, n + LENGTH - 1, 2 * LENGTH - GRAM) ^ mixed((anchor - first).astype(np.uint64) + np.uint64(7))
    return owner[head], first, n, anchor, h[anchor], seg


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows without the text, bytes, starts, lengths) of batches with ``text``, a few MB at a time."""
    for batch in batches:
        names = [c for c in batch.schema.names if c != "text"]
        rows, texts, held = [], [], 0
        for row in zip(*(batch.column(c).to_pylist() for c in names), batch.column("text")):
            rows.append(row[:-1])
            texts.append(row[-1].as_py())
            held += len(texts[-1])
            if held >= CHUNK_BYTES:
                yield rows, *laid(texts)
                rows, texts, held = [], [], 0
        if rows:
            yield rows, *laid(texts)


def laid(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum(length)[:-1]]), length


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, mark, text): id with nulls last, upper half of places that tells rows of one id apart, UTF-8 bytes."""
    text = F.encode(whole_text(), "UTF-8")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.shiftleft(F.xxhash64(text).bitwiseAND(F.lit((1 << 31) - 1)), 32).alias("mark"), text.alias("text"))


def segments(docs: DataFrame) -> DataFrame:
    """One row per segment; ``shape`` is windows * 256 + anchor offset, with a minus sign if the whole segment is a repeat."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, start, length in chunks(batches):
            owner, first, n, anchor, hashed, seg = segments_of(data, start, length)
            doc, mark = (np.array([r[k] for r in rows], np.int64)[owner] for k in (0, 1))
            at = mark + (first - start[owner])
            shape = n * 256 + (anchor - first)
            order = np.lexsort((at, doc, seg, hashed))
            again = np.zeros(len(order), bool)
            again[1:] = (hashed[order][1:] == hashed[order][:-1]) & (seg[order][1:] == seg[order][:-1])
            # A row equal in id and text has the same places: it marks nothing of its twin.
            lead = np.maximum.accumulate(np.where(again, 0, np.arange(len(order))))
            twin = again & (doc[order] == doc[order][lead]) & (at[order] == at[order][lead])
            order, again = order[~twin], again[~twin]
            shape = np.where(again, -shape[order], shape[order])
            # What is known to be a repeat is spread by its place: a hot anchor keeps one row per batch and segment.
            spread = np.where(again, mixed((at[order] ^ mixed(doc[order].astype(np.uint64)).view(np.int64)).view(np.uint64)), hashed[order])
            yield pa.RecordBatch.from_arrays(
                [pa.array(spread.view(np.int64)), pa.array(seg[order].view(np.int64)), pa.array(doc[order]), pa.array(at[order]),
                 pa.array(shape.astype(np.int32))], [x.split()[0] for x in _SEGMENT.split(", ")])

    return keyed(docs).mapInArrow(cut, _SEGMENT)


def sorted_out(rows: DataFrame) -> DataFrame:
    """Segments whose anchor occurs with other bytes too, as they are, and whole repeats, with a minus sign.

    Input sorted by (anchor, seg, doc, at); a row only waits for its neighbours.
    Rows that come with a minus sign are told already and pass through.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _SEGMENT.split(", ")]
        last = wait = None  # the row before; the first row of its segment, not yet known to have a different neighbour
        leader = (0, 0)  # document and place of that first row
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy() for c in names]
            told = cols[4] < 0
            if told.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[told]) for c in cols], names)
                cols = [c[~told] for c in cols]
                if not len(cols[0]):
                    continue
            anchor, seg = cols[0], cols[1]
            head = last is not None and last[0] == anchor[0]
            same_anchor = np.concatenate([[head], anchor[1:] == anchor[:-1]])
            same = np.concatenate([[head and last[1] == seg[0]], seg[1:] == seg[:-1]]) & same_anchor
            lead = np.flatnonzero(~same)  # first rows of segments
            keep = np.zeros(len(lead), bool)
            after = anchor[lead]
            keep[1:] = after[1:] == after[:-1]
            if len(lead) and last is not None and last[0] == after[0]:
                keep[0] = True
                if wait is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(wait, types())], names)
                    wait = None
            keep[:-1] |= after[:-1] == after[1:]
            if len(lead):
                # The last one is told by the next batch; a kept one need not wait.
                wait = None if keep[-1] else tuple(int(c[lead[-1]]) for c in cols)
            spot = np.maximum.accumulate(np.where(same, -1, np.arange(len(same))))
            lead_doc, lead_at = (np.where(spot >= 0, c[spot], first) for c, first in zip((cols[2], cols[3]), leader))
            leader = int(lead_doc[-1]), int(lead_at[-1])
            same &= (cols[2] != lead_doc) | (cols[3] != lead_at)
            take = np.concatenate([np.flatnonzero(same), lead[keep]])
            out = [c[take] for c in cols]
            out[4] = np.concatenate([-np.abs(cols[4][same]), cols[4][lead[keep]]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names)
            last = (anchor[-1], seg[-1])

    return rows.mapInArrow(compare, _SEGMENT)


def types() -> list[pa.DataType]:
    return [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order.

    The first eight bytes sort all suffixes; prefix doubling then goes over
    those alone that are not yet told apart.
    """
    n = len(text)
    x = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | x[k:k + n]
    order = np.argsort(word, kind="stable")
    new = np.ones(n, bool)
    new[1:] = word[order][1:] != word[order][:-1]
    slots, rank, depth = np.arange(n), np.empty(n + 1, np.int64), 8
    rank[n] = -1
    while True:
        # A group's rank is its first slot; a group of one is settled.
        rank[order[slots]] = np.maximum.accumulate(np.where(new, slots, 0))
        slots = slots[~(new & np.append(new[1:], True))]
        if not len(slots):
            return order
        place = order[slots]
        group, ahead = rank[place], place + depth
        # Beyond the end the shorter suffix comes first.
        beyond = np.where(ahead < n, rank[np.minimum(ahead, n)], n - 1 - ahead)
        key = group * (2 * n + depth + 2) + (beyond + n + depth + 1)
        by = np.argsort(key, kind="stable")
        order[slots], key = place[by], key[by]
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        depth *= 2


def neighbour_matches(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the match of each suffix, in text order, with its neighbour before it in the suffix array.

    Within a run of the transform the match is one byte shorter than that of
    the suffix one position earlier, so only run heads are compared.
    """
    n = len(text)
    bwt = text[order - 1]
    head = np.ones(n, bool)
    head[1:] = bwt[1:] != bwt[:-1]
    head |= order == 0
    head[1:] |= order[:-1] == 0
    a, b = order[np.flatnonzero(head)], order[np.maximum(np.flatnonzero(head) - 1, 0)]
    length = np.zeros(len(a), np.int64)
    live = np.flatnonzero(a != b)
    while len(live):
        p, q = a[live] + length[live], b[live] + length[live]
        inside = (p < n) & (q < n)
        live, p, q = live[inside], p[inside], q[inside]
        go = text[p] == text[q]
        live = live[go]
        length[live] += 1
    # Streaming: from each head on, one byte less per position.
    at = np.full(n, -1, np.int64)
    at[a] = length + a
    return np.maximum(np.maximum.accumulate(at) - np.arange(n), 0)


def earlier_windows(contents: list[bytes], rank: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, offset) of windows that also start in a segment of lower rank, or earlier in their own."""
    text = np.frombuffer(b"\0".join(contents) + b"\0", np.uint8)
    length = np.fromiter(map(len, contents), np.int64, len(contents))
    start = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
    order = suffix_array(text)
    matches = neighbour_matches(text, order)
    group = np.cumsum(matches[order] < LENGTH)
    owner = np.repeat(np.arange(len(contents)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(windows)[:-1]]), windows)
    group_at = np.empty(len(text), np.int64)
    group_at[order] = group
    mine = group_at[start[owner] + offset]
    key = rank[owner] * 1024 + offset
    least = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, mine, key)
    late = key > least[mine]
    return owner[late], offset[late]


def runs_of(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, first place, count) of runs of consecutive places, from rows sorted by both."""
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    return doc[head], at[head], np.diff(np.concatenate([head, [len(at)]]))


def mark_batch(doc: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((at, doc))
    d, a, n = runs_of(doc[order], at[order])
    return pa.RecordBatch.from_arrays([pa.array(d), pa.array(a), pa.array(n.astype(np.int32))], ["doc", "at", "n"])


def indexed(contents: DataFrame) -> DataFrame:
    """Marks of windows that start earlier; input sorted by anchor, of segments with their bytes."""

    def flush(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if len(rows) < 2:
            return
        doc, at = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
        rank = np.empty(len(rows), np.int64)
        rank[np.lexsort((at, doc))] = np.arange(len(rows))
        windows = np.array([r[3] // 256 for r in rows], np.int64)
        owner, offset = earlier_windows([r[4] for r in rows], rank, windows)
        if len(owner):
            yield mark_batch(doc[owner], at[owner] + offset)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, group = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "doc", "at", "shape", "bytes"))):
                if row[0] != group and held >= INDEX_BYTES:
                    yield from flush(rows)
                    rows, held = [], 0
                group = row[0]
                rows.append(row)
                held += len(row[4])
        yield from flush(rows)

    return contents.mapInArrow(index, _MARK)


def fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Segments of ``wanted`` (anchor, doc, at, shape, many) with their bytes; those of heavy anchors as one row per window hash."""
    by_doc = wanted.groupBy(F.col("doc").alias("doc_of"), F.expr("at & -4294967296").alias("mark_of")).agg(
        F.collect_list(F.struct("anchor", "at", "shape", "many")).alias("parts"))
    rows = keyed(docs).join(by_doc, (F.col("doc") == F.col("doc_of")) & (F.col("mark") == F.col("mark_of"))).select("doc", "parts", "text")
    # Equal rows give equal parts; the sort keeps one of each, further down.
    schema = "anchor long, doc long, at long, shape int, bytes binary"

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for doc, parts, text in zip(batch.column("doc").to_pylist(), batch.column("parts").to_pylist(), batch.column("text")):
                text = text.as_py()
                for p in parts:
                    first, n = p["at"] & 0xFFFFFFFF, p["shape"] // 256
                    if p["many"]:
                        for k in range(n):
                            window = text[first + k:first + k + LENGTH]
                            out.append((p["anchor"], doc, p["at"] + k, -1, hashlib.blake2b(window, digest_size=16).digest()))
                    else:
                        out.append((p["anchor"], doc, p["at"], p["shape"], text[first:first + n + LENGTH - 1]))
                    held += 200
                if held > 4 << 20:
                    yield batch_of(out)
                    out, held = [], 0
            if out:
                yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], [x.split()[0] for x in schema.split(", ")])

    return rows.mapInArrow(fetch, schema)


def marks(docs: DataFrame) -> DataFrame:
    """(doc, at, n): from place ``at``, ``n`` windows in a row start earlier elsewhere."""
    compared = sorted_out(segments(docs).repartition("anchor").sortWithinPartitions("anchor", "seg", "doc", "at"))
    known = settled(compared, "repeats-segments")
    whole = known.where("shape < 0").select("doc", "at", F.expr("(-shape) div 256").cast("int").alias("n"))
    parts = known.where("shape > 0")
    sizes = parts.groupBy(F.col("anchor").alias("anchor_of")).agg(F.count(F.lit(1)).alias("segs"))
    wanted = parts.join(sizes, F.col("anchor") == F.col("anchor_of")).select("anchor", "doc", "at", "shape", (F.col("segs") > GROUP_SEGMENTS).alias("many"))
    contents = settled(fetched(docs, wanted), "repeats-contents")
    light = contents.where("shape > 0").dropDuplicates(["anchor", "doc", "at"])
    near = indexed(light.repartition("anchor").sortWithinPartitions("anchor", "doc", "at"))
    heavy = contents.where("shape < 0").select("anchor", "bytes", "doc", "at")
    first = heavy.groupBy(F.col("bytes").alias("window")).agg(F.min(F.struct("doc", "at")).alias("first"))
    late = heavy.join(first, F.col("bytes") == F.col("window")).where(F.struct("doc", "at") != F.col("first")).select("doc", "at", F.lit(1).alias("n"))
    return whole.unionByName(near).unionByName(late)


def repeats(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) per row."""
    by_doc = marked.groupBy(F.col("doc").alias("doc_of"), F.expr("at & -4294967296").alias("mark_of")).agg(
        F.collect_list(F.struct("at", "n")).alias("runs"))
    joined = keyed(docs).join(by_doc, (F.col("doc") == F.col("doc_of")) & (F.col("mark") == F.col("mark_of")), "left")
    copy = F.row_number().over(Window.partitionBy("doc", "mark").orderBy("doc"))
    rows = joined.select("doc", "text", "runs", copy.alias("copy"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, runs, copy in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "runs", "copy"))):
                spans: list[list[int]] = []
                if copy > 1 and len(text) >= LENGTH:
                    spans = [[0, len(text)]]
                else:
                    for a, n in sorted((r["at"] & 0xFFFFFFFF, r["n"]) for r in runs or ()):
                        if spans and a <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], a + n - 1 + LENGTH)
                        else:
                            spans.append([a, a + n - 1 + LENGTH])
                edges = [0, *[x for s in spans for x in s], len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((None if doc == NO_ID else doc, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds],
                                             [x.split()[0] for x in schema.split(", ")])

    return rows.mapInArrow(cut, schema)


def report(docs: DataFrame) -> DataFrame:
    """The query's columns: sizes, removed bytes and spans, digest of what stays."""
    return repeats(docs, marks(docs)).drop("kept")
