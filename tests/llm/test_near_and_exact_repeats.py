"""SimHash near-dedup, benchmark decontamination and byte repeats against brute force."""

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from awkward import clashing, documents, empty, rows, texts

from carriageway.llm import decontamination, repeats, simhash
from carriageway.llm.components import components


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def plain_classes(data, distance=4):
    prints = [plain_fingerprint(r[1]) for r in data]
    distinct = sorted(set(prints))
    root = roots_of(distinct, [(a, b) for a, b in combinations(distinct, 2) if (a ^ b).bit_count() <= distance])
    least = {}
    for r, f in zip(data, prints):
        if r[0] is not None:
            least[root[f]] = min(least.get(root[f], r[0]), r[0])
    return [(r[0], f"{f:016x}", least.get(root[f])) for r, f in zip(data, prints)], [root[f] for f in prints]


def test_near_dedup_matches_brute_force(spark):
    want, _ = plain_classes(rows())
    got = simhash.report(clashing(documents(spark)).drop("fingerprint", "component_id"))
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert simhash.report(empty(spark)).count() == 0


def test_one_of_each_component_stays(spark):
    df = documents(spark)
    got = simhash.one_of_each(df)
    assert got.schema == df.schema
    want, root = plain_classes(rows())
    least = {}
    for (i, *_), r in zip(want, root):
        least.setdefault(r, []).append(i)
    first = Counter(min(ids, key=lambda i: (i is None, i or 0)) for ids in least.values())
    assert Counter(r["doc_id"] for r in got.collect()) == first


@pytest.mark.parametrize("distance", range(8))
def test_key_sets_leave_no_pair_out(distance):
    sets = simhash.key_sets(distance)
    assert all(any(set(k) <= set(shared) for k in sets) for shared in combinations(range(8), 8 - distance))


def test_links_within_distance(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = {b ^ sum(1 << k for k in rng.sample(range(64), d)) for b in base for d in range(7)}
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    got = {tuple(r) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "_fp long")).collect()}
    want = {(min(a, b), max(a, b)) for a, b in combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    assert got == want


def test_components_of_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


def word_list(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def plain_leaks(docs, items):
    grams = lambda w: [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    out = {}
    for d, text in docs:
        s = grams(word_list(text))
        for i, item in items:
            g = Counter(grams(word_list(item)))
            m = sum(g.values())
            for a in range(max(1, len(s) - m + 1) if m and s else 0):
                w = Counter(s[a:a + m])
                c = sum((w & g).values())
                if c and c / (sum(w.values()) + m - c) >= 0.8:
                    out[d, i] = max(out.get((d, i), 0), c / (sum(w.values()) + m - c))
    return out


def test_leaks_match_brute_force(spark):
    plain = texts(40, seed=9)
    items = [(i, " ".join(t.split()[:25 + i])) for i, t in enumerate(texts(12, seed=10))] + [(50, "only four words here"), (51, None), (52, "")]
    edits = []
    for k in range(36):
        w = items[k % 12][1].split()
        if k % 6 == 1:
            w = w[:9] + ["inserted"] + w[9:]
        elif k % 6 == 2:
            del w[12]
        elif k % 6 == 3:
            w = [x.upper() + "," for x in w]
        elif k % 6 == 4:
            w = w[:len(w) // 2]
        elif k % 6 == 5:
            w = w[1:]
        edits.append((1000 + k, (plain[k] if k % 2 else "") + " " + " ".join(w) + " " + (plain[-k] if k % 3 else "")))
    docs = list(enumerate(plain)) + edits + [(3000, None), (3001, ""), (3002, items[3][1]), (3003, items[3][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.report(clashing(df), clashing(bench).drop("key")).collect()
    want = plain_leaks(docs, items)
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert 18 < len(want) and len(got) == len(want)
    kept = decontamination.clean(df, bench)
    assert kept.schema == df.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({d for d, _ in docs} - {d for d, _ in want})
    assert decontamination.report(df.limit(0), bench).count() == 0 and decontamination.clean(df, bench.limit(0)).count() == len(docs)


def test_leaks_of_reordered_passages(spark):
    """Halves or sentences of an item in another order, where no shingle's place leads to the best window."""
    rng = random.Random(4)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    items = [(i, fresh(50 + 5 * i)) for i in range(8)]
    docs = []
    for i, w in items:
        h, third = len(w) // 2, len(w) // 3
        moved = (w[h:] + w[:h], w[2 * third:] + w[:2 * third], w[third:] + w[:third], w[h:] + w[:h])[i % 4]
        docs.append((100 + i, " ".join(fresh(300) + moved + fresh(300))))
        docs.append((200 + i, " ".join(moved)))
    docs.append((300, " ".join(items[0][1] * 3)))
    docs.append((301, " ".join(items[7][1][:80])))
    items = [(i, " ".join(w)) for i, w in items]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = plain_leaks(docs, items)
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in decontamination.report(df, bench).collect()}
    assert {(100 + i, i) for i in range(8)} < set(want) and got == {k: round(v, 9) for k, v in want.items()}
    assert {r["doc_id"] for r in decontamination.clean(df, bench).collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_window_starts_leave_none_out(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(1, 20), n, sorted(rng.sample(range(n), rng.randrange(max(1, n * 3 // 4), n + 1)))) for n in [rng.randrange(1, 40) for _ in range(300)]]
    frame = spark.createDataFrame(rows, "size int, held int, at array<int>")
    for size, held, at, starts in frame.select("size", "held", "at", decontamination.window_starts(0.8).alias("s")).collect():
        inside = lambda a: sum(a <= p < a + size for p in at)  # noqa: E731,B023
        whole = min(held, size) + size
        assert sorted(starts) == [a for a in range(max(1, held - size + 1)) if 9 * inside(a) >= 4 * whole]


def test_blocks_guarantee_the_radius():
    cut = decontamination.blocks(decontamination.RADIUS)
    assert len(cut) == decontamination.RADIUS + 1 and sum(w for _, w in cut) == 64 and all(w > 0 for _, w in cut)


def plain_repeats(data):
    seen, out = set(), []
    for doc_id, text in sorted(data, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if b[s:s + 100] in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(b[s:s + 100])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passages(n=500, seed=3):
    rng = random.Random(seed)
    make = lambda k, letters="abc": "".join(rng.choice(letters) for _ in range(k))
    shared = [make(k, "abcdé \n\0") for k in (99, 100, 101, 120, 150, 400)]
    data = [(i, make(rng.randint(0, 200)) + rng.choice(shared) + make(rng.randint(0, 300)) + (rng.choice(shared) if i % 3 else "")) for i in range(n)]
    data += [(5000, "ab" * 300), (5001, "ab" * 280 + "c"), (5002, None), (5003, ""), (5004, "x" * 99), (5005, "x" * 100), (5006, "0" * 3000),
             (5007, "0" * 3000), (None, "x" * 500), (5008, " ".join(make(7) for _ in range(4000)))]
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("group_segments", [2048, 5])
def test_repeats_match_brute_force(spark, monkeypatch, group_segments):
    """With few segments a group allowed, windows are compared by hash; small chunks spread copies over batches."""
    monkeypatch.setattr(repeats, "GROUP_SEGMENTS", group_segments)
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(repeats, "INDEX_BYTES", 30_000)
    data = passages()
    df = clashing(spark.createDataFrame(data, "doc_id long, text string").repartition(6))
    assert sorted(map(tuple, repeats.report(df).collect()), key=str) == sorted(plain_repeats(data), key=str)


def test_repeats_of_equal_rows_and_empty_table(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdef") for _ in range(300))
    df = spark.createDataFrame([(1, text), (1, text), (1, "short"), (None, text), (None, text)], "doc_id long, text string")
    got = Counter((r["doc_id"], r["n_removed"], r["n_spans"]) for r in repeats.report(df).collect())
    assert got == Counter([(1, 0, 0), (1, 300, 1), (1, 0, 0), (None, 300, 1), (None, 300, 1)])
    assert repeats.report(empty(spark)).count() == 0


def test_suffix_array_and_run_length_matches():
    rng = random.Random(2)
    for _ in range(60):
        raw = bytes(rng.choice(b"ab\0") for _ in range(rng.randint(1, 400)))
        text = np.frombuffer(raw, np.uint8)
        order = repeats.suffix_array(text)
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        matches = repeats.neighbour_matches(text, order)
        for before, here in zip(order.tolist(), order[1:].tolist()):
            n = 0
            while max(before, here) + n < len(raw) and raw[before + n] == raw[here + n]:
                n += 1
            assert matches[here] == n
