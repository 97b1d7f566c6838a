"""Packing, archives and shards: round trips and laws."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from awkward import clashing, documents, empty, rows
from tokenizers import Tokenizer

from carriageway.llm import packing, sharding, warc


def plain_pieces(data, size=1024):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = Counter()
    for doc_id, text, *_ in data:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        first = len(ids) % size
        bounds = [0, len(ids)] if len(ids) <= size else sorted({0, *range(first, len(ids) + 1, size)})
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            out[doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    return out


def test_pieces_fill_sequences(spark):
    data = rows() + [(900, "a <|endoftext|> b", "en", "a", 1), (901, "don't ÄÖ  \n\n 12345   　中文 " + "x" * 3000, "en", "a", 1)]
    df = clashing(spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")).repartition(4)
    got = packing.packed(df).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == plain_pieces(data)
    held = defaultdict(list)
    for r in got:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(held) <= math.ceil(sum(r["length"] for r in got) / 1024) + 1
    assert packing.packed(empty(spark)).count() == 0


def test_exchange_saves_sequences(spark, monkeypatch):
    """Groups too small to pack well alone save sequences by exchanging documents."""
    rng = random.Random(5)
    lengths = [rng.randint(1, 1023) for _ in range(3000)]
    monkeypatch.setattr(packing, "GROUP_ITEMS", 64)
    monkeypatch.setattr(packing, "pieces", lambda docs, size, vocabulary: spark.createDataFrame(
        [(i, 0, 0, n, 0) for i, n in enumerate(lengths)], packing.PIECES))
    n = packing.packed(empty(spark)).select("sequence_id").distinct().count()
    alone = sum(len(set(packing.best_fit(np.array(lengths[a:a + 64]), 1024)[0])) for a in range(0, 3000, 64))
    assert n < alone and n <= 1.06 * packing.fewest_bins(np.array(lengths), 1024)


def test_bounds_never_exceed_a_packing():
    rng = np.random.default_rng(6)
    for _ in range(200):
        lengths = rng.integers(1, 101, rng.integers(1, 40))
        bins, offsets = packing.best_fit(lengths, 100)
        assert np.bincount(bins, weights=lengths).max() <= 100
        assert packing.fewest_bins(lengths, 100) <= len(set(bins.tolist()))
    assert packing.fewest_bins(np.array([51] * 7), 100) == 7  # the plain sum would give 4
    assert packing.fewest_bins(np.array([34] * 9), 100) == 5  # two fit into each


PAGES = [(1, "http://a/x y?é", "<p>same</p>"), (2, "http://b", "<p>same</p>"), (9, None, "<p>same</p>"), (3, "u\r\nX: y", "é" * 5000), (4, "", None), (5, "u", ""),
         (6, "u", "<p>own</p>"), (6, "u", "<p>own</p>"), (None, "u", "<p>none</p>"), (None, "u", "<p>same</p>"), (7, "u", "nul\0\x28\xb5\x2f\xfd byte")]


def pages(spark, data=PAGES):
    return spark.createDataFrame(data, "page_id long, url string, html string").repartition(3)


def test_archive_round_trip(spark, tmp_path):
    got = clashing(pages(spark))
    want = Counter()
    last = {}
    for i, _, html in PAGES:
        if i is not None:
            last[html or ""] = max(last.get(html or "", i), i)
    for i, _, html in PAGES:
        body = (html or "").encode()
        first = last.get(html or "")
        refers = first if first is not None and i != first else None
        want[i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if refers is None else "revisit", refers] += 1
    assert Counter(map(tuple, warc.round_trip(got).collect())) == want
    assert warc.round_trip(pages(spark).limit(0)).count() == 0

    path = str(tmp_path / "archive")
    warc.write(pages(spark), path, least_bytes=100)
    full = warc.read(spark, path).collect()
    assert Counter((r["page_id"], r["url"], bytes(r["payload"]).decode()) for r in full) == Counter((i, u, h or "") for i, u, h in PAGES)
    assert {r["record_type"] for r in full} == {"response"}


def test_files_start_with_the_dictionary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 10)
    data = [(i, "u", f"<p>page {i} of a few</p>" * 20) for i in range(95)]
    warc.write(pages(spark, data).coalesce(1), str(tmp_path / "a"))
    files = [p.read_bytes() for p in (tmp_path / "a").glob("part-*")]
    assert len(files) >= 10
    assert all(int.from_bytes(f[:4], "little") == warc.DICTIONARY_MAGIC for f in files)
    assert warc.read(spark, str(tmp_path / "a")).count() == 95


@pytest.mark.parametrize("damage", ["cut", "magic", "digest"])
def test_damaged_archives_are_refused(spark, tmp_path, damage):
    warc.write(pages(spark).coalesce(1), str(tmp_path / "a"))
    data = b"".join(p.read_bytes() for p in (tmp_path / "a").glob("part-*") if p.stat().st_size)
    if damage == "cut":
        data = data[:-12]
    elif damage == "magic":
        data = b"\0" + data[1:]
    with pytest.raises(warc.BadArchive):
        for _, content in warc.frames_of(data):
            warc.parsed(content.replace(b"<p>own</p>", b"<p>OWN</p>") if damage == "digest" else content)


def test_shards_hold_equal_counts(spark):
    data = rows() + [(2000 + i, "one text that fills more than a shard", "en", "a", 1) for i in range(150)] + [(4000 + i, f"alone {i}", "en", "a", 1) for i in range(300)]
    df = clashing(spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")).repartition(4)
    got = sharding.sharded(df).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()), "rows", None) for r in data)
    shards = defaultdict(list)
    for r in got:
        shards[r["shard"]].append(r["slot"])
    sizes = [len(shards[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in shards.values())
    small = defaultdict(set)
    for r in got:
        if r["size"] != 38:
            small[r["text_crc32"]].add(r["shard"])
    copies = {c for c, n in Counter(r["text_crc32"] for r in got if r["size"] != 38).items() if n > 1}
    assert sum(len(small[c]) > 1 for c in copies) <= len(copies) // 3  # hash placement would cut nearly all


def test_fewer_rows_than_shards(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (None, None)], "doc_id long, text string")
    got = sharding.sharded(df).collect()
    assert sorted(r["slot"] for r in got) == [0, 0, 0] and len({r["shard"] for r in got}) == 3
    assert sharding.sharded(empty(spark)).count() == 0
