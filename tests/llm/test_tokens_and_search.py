"""Token counts, alignment of two vocabularies and ranked search against brute force."""

import hashlib
import math
import random
import re
import sys
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from awkward import SCHEMA, clashing, documents, empty, rows
from tokenizers import Tokenizer, pre_tokenizers

from carriageway.llm import alignment, lexical_search, token_counts

HARD = ["a <|endoftext|> b<|endoftext|><|endoftext|>", "don't they'll I'VE ÄÖ's  \n\n 12345   　中文͸ \U00010941x", "x" * 3000 + " " + "é" * 2000, "   ",
        "▁ sign of the other side", "tab\tand nul\0 \x1c\x85 end", "\U0001f600\U0001f468‍\U0001f469‍\U0001f467 é"]


def with_hard(spark):
    data = rows() + [(900 + i, t, "en", "a", 1) for i, t in enumerate(HARD)]
    return data, clashing(spark.createDataFrame(data, SCHEMA)).repartition(4)


def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


# ---- token counts ----------------------------------------------------------
def test_counts_match_the_library(spark, monkeypatch):
    data, df = with_hard(spark)
    t = tokenizer()
    want = Counter()
    for i, text, *_ in data:
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        want[i, len((text or "").encode()), n, n > 1024] += 1
    assert Counter(map(tuple, token_counts.counted(df).collect())) == want
    monkeypatch.setattr(token_counts, "FREQUENT", 16)  # a table of a few entries gives the same counts
    assert Counter(map(tuple, token_counts.counted(df).collect())) == want
    assert token_counts.counted(empty(spark)).count() == 0


def test_counts_over_a_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.counted(df).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in df.select("doc_id", "text").collect()}
    encoded = tokenizer().encode_batch_fast(list(texts.values()), add_special_tokens=False)
    assert got == {i: len(e.ids) for i, e in zip(texts, encoded)}


def test_cache_and_cuts_change_nothing(monkeypatch):
    source = token_counts.PreTokens()
    texts = [r[1] or "" for r in rows()] + HARD
    want = [source.length(t) for t in texts]
    monkeypatch.setattr(token_counts, "PART", 40)
    lengths = token_counts.Lengths({" the": 1}, source, cache=10)
    assert [lengths.count(t) for t in texts] == want and len(lengths) <= 11
    assert max(len(p) for t in texts if " " in t for p in source.lists(t)) < 80


def test_pre_tokens_of_every_character():
    """The pattern cuts like the library at every code point that has a character."""
    source, pre = token_counts.PreTokens(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    chars = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    for at in range(0, len(chars), 2000):
        text = " ".join(f"a{c}a 1{c}1 .{c}. {c}" for c in chars[at:at + 2000])
        assert [len(p) for p in source.find(text)] == [b - a for _, (a, b) in pre.pre_tokenize_str(text)]


def test_sketches_keep_frequent_tokens(spark):
    df = spark.createDataFrame([(i, " of" * 50 + f" rare{i} word{i}x") for i in range(400)], "doc_id long, text string").repartition(6)
    got = token_counts.frequent_tokens(df, size=8, fan=2)
    assert " of" in got and len(got) <= 8
    exact = Counter(random.Random(1).choices([f"t{i}" for i in range(100)], [1 / (i + 1) for i in range(100)], k=20_000))
    part = token_counts.pruned(exact, 20)
    assert all(0 <= exact[k] - part[k] <= 20_000 / 20 for k in exact)
    assert token_counts.opened(token_counts.compact([" of", "é", "zzzzqq"], token_counts.PreTokens()))[" of"] == 1


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError):
        token_counts.PreTokens("word_bpe_49k")


# ---- alignment -------------------------------------------------------------
def plain_alignment(data):
    a, b = tokenizer(), sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    a.encode_special_tokens = True
    sign = {s: bytes([v]) for s, v in alignment.byte_of_sign().items()}
    docs, total = [], Counter()
    for i, text, *_ in data:
        full = " " + (text or "")
        ta = [(t, b"".join(sign[c] for c in a.id_to_token(t))) for t in a.encode(full, add_special_tokens=False).ids]
        tb = []
        for t in b.encode(text or ""):
            piece = b.id_to_piece(t)
            tb.append((t, bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x..>", piece) else piece.replace("▁", " ").encode()))
        if not text or b"".join(x for _, x in ta) != full.encode() or b"".join(x for _, x in tb) != full.encode():
            ta = tb = []
        over = [[k for k, (_, x) in enumerate(side) for _ in x] for side in (ta, tb)]  # token of every byte
        links = [(ta[x][0], tb[y][0]) for x, y in sorted(set(zip(*over)))]
        ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (ta, tb)]
        groups, cut = [], sorted(ends[0] & ends[1])
        for start, stop in zip([0, *cut], cut):
            groups.append("|".join(",".join(str(side[k][0]) for k in sorted(set(o[start:stop]))) for side, o in ((ta, over[0]), (tb, over[1]))))
        docs.append((i, len(ta), len(tb), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if ta else ""))
        total.update(links)
    most = defaultdict(int)
    for (_, y), n in total.items():
        most[y] = max(most[y], n)
    return Counter((i, na, nb, ng, len(k), sum(total[p] == most[p[1]] for p in k), sum(total[p] for p in k), sha) for i, na, nb, ng, k, sha in docs)


@pytest.mark.parametrize("heavy", [1 << 18, 40, 0])
def test_alignment_matches_brute_force(spark, heavy, monkeypatch):
    monkeypatch.setattr(alignment, "STEP", 5000)
    data, df = with_hard(spark)
    got = Counter(map(tuple, alignment.report(df, heavy=heavy).collect()))
    assert got == plain_alignment(data)
    assert sum(n for r, n in got.items() if r[1] == 0) >= 4  # null, empty, and what one side does not give back


def test_alignment_of_an_empty_table(spark):
    assert alignment.report(empty(spark)).count() == 0
    assert alignment.report(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")).select("n_links", "count_sum").distinct().collect() == [(0, 0)]


def test_alignment_takes_a_word_once(monkeypatch):
    """Words met in earlier texts are not encoded again by either side, and chunks are those of the texts."""
    import pyarrow as pa

    known = alignment.Memory(alignment.A_VOCABULARY, alignment.B_VOCABULARY)
    seen, encoded = [], known.both.encoded
    monkeypatch.setattr(known.both, "encoded", lambda chunks: seen.extend(chunks) or encoded(chunks))
    texts = ["one word after another, one word ", "another word after one"] * 50
    first = alignment.aligned_batch(pa.array(range(100)), texts, known)
    assert sorted(seen) == [" after", " another", " another,", " one", " word", " word "]
    assert alignment.aligned_batch(pa.array(range(100)), texts, known).equals(first) and len(seen) == 6
    monkeypatch.setattr(alignment, "CACHE", 5)  # all are forgotten, and met again
    assert alignment.aligned_batch(pa.array(range(100)), texts, known).equals(first) and len(seen) == 12


def test_alignment_by_chunks_matches_whole_texts(spark):
    """White space of all kinds where texts are cut."""
    rng = random.Random(3)
    signs = [" ", "  ", "   ", "\n", " \n", "\n ", "\t", "\xa0", "\u3000", "\x1c", "▁", "'s", "the", "word", ".", "12", "é", "中", "\u0378", "<s>"]
    data = [(i, "".join(rng.choice(signs) for _ in range(rng.randint(0, 9)))) for i in range(3000)]
    got = Counter(map(tuple, alignment.report(spark.createDataFrame(data, "doc_id long, text string").repartition(3)).collect()))
    assert got == plain_alignment(data)


# ---- ranked search ---------------------------------------------------------
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_ranks(docs, items, k=10):
    counts = [(i, Counter(plain_terms(t))) for i, t, *_ in docs]
    counts = [(i, c) for i, c in counts if c]
    total, length = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = Counter()
    for item_id, text in items:
        scores = []
        for i, c in counts:
            m = 100 - 90 + (90 * c.total() * total) // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(plain_terms(text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1):
            out[item_id, rank, i, -s] += 1
    return out


def some_items():
    words = [t for _, text, *_ in rows()[:60] for t in (text or "").split()]
    rng = random.Random(3)
    return [(i, " ".join(rng.choices(words, k=rng.randint(1, 40))).title()) for i in range(40)] + [
        (50, None), (51, ""), (52, "no-such-term-here-at-all"), (53, "word two WORDS"), (53, rows()[5][1]), (None, rows()[7][1]), (54, "0" * 5000), (55, "é É")]


@pytest.mark.parametrize("setting", [{}, {"PAIRS": 100}, {"SEGMENT": 7, "DEPTH": 1}])
def test_ranks_match_brute_force(spark, monkeypatch, setting):
    for name, value in setting.items():
        monkeypatch.setattr(lexical_search, name, value)
    items = clashing(spark.createDataFrame(some_items(), "item_id long, text string")).repartition(3)
    got = lexical_search.ranked(clashing(documents(spark)), items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == plain_ranks(rows(), some_items())


def test_search_over_empty_tables(spark):
    items = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert lexical_search.ranked(empty(spark), items).count() == 0
    assert lexical_search.ranked(documents(spark), items.limit(0)).count() == 0


def test_reading_stops_before_the_lists_end():
    """Intervals settle the best documents from the tops of long lists; a floor stops reading earlier still."""
    rng = np.random.default_rng(5)
    size, n_terms = 4000, 6
    tfs = np.where(rng.random((size, n_terms)) < 0.01, 40, rng.integers(1, 3, (size, n_terms)))
    weights = np.array([900, 800, 700, 600, 500, 400])
    args = [list(range(size)), np.full(size, 300), np.tile(np.arange(n_terms), size), tfs.ravel(), np.full(size, n_terms), weights, (size, 300 * size)]
    score = (weights * ((10 ** 9 * tfs) // (1000 * tfs + 8 * 100))).sum(axis=1)
    want = sorted(zip((-score).tolist(), range(size)))[:10]
    segment = lexical_search.Segment(*args)
    found = segment.best(np.arange(n_terms), 10, 0)
    assert sorted((-s, d) for s, d in found)[:10] == want
    again = lexical_search.Segment(*args)
    assert again.best(np.arange(n_terms), 10, 10 * int(score.max())) == [] and again.reads < segment.reads <= size * n_terms
