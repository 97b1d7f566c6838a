"""Toxicity: held-out accuracy, and that labels of held-out rows change nothing."""

import random
import zlib

import numpy as np
from awkward import clashing, empty, texts

from carriageway.llm import toxicity


def corpus(n=900, seed=2):
    """A tenth is toxic: list words, or words of an invented family with one beginning."""
    rng = random.Random(seed)
    data, labels = [], []
    for i, t in enumerate(texts(n, seed=seed)):
        toxic = i % 10 == 0
        words = t.split()
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(("idiot", "scum", "loser")) if i % 20 else "zorb" + rng.choice(("ul", "ak", "ine", "ott")))
        data.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    return data, labels


def test_held_out_accuracy(spark):
    data, labels = corpus()
    docs = clashing(spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")).drop("score").repartition(4)
    got = toxicity.scored(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    truth = {i: t for i, _, t in labels}
    assert len(got) == len(data) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = [r for r in got if r["held_out"]]
    pos = np.array([r["score"] for r in held if truth[r["doc_id"]]])
    neg = np.array([r["score"] for r in held if not truth[r["doc_id"]]])
    assert (pos[:, None] > neg).mean() > 0.98
    assert (pos >= 0.5).mean() > 0.8 and (neg >= 0.5).mean() < 0.02


def test_held_out_labels_are_not_read(spark):
    data, labels = corpus(200)
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    swapped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = (toxicity.scored(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).select("doc_id", "score").collect() for x in (labels, swapped))
    assert {r["doc_id"]: round(r["score"], 9) for r in a} == {r["doc_id"]: round(r["score"], 9) for r in b}


def test_awkward_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "you idiot"), (3, "nice words"), (3, "nice words")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.scored(docs, none).collect()
    assert len(got) == 5
    by_text = {r["doc_id"]: r["score"] for r in got}
    assert by_text[None] > 0.5 > by_text[3] and by_text[1] == by_text[2]
    odd = spark.createDataFrame([(1, 1, None), (None, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.scored(docs, odd).count() == 5
    assert toxicity.scored(empty(spark), odd).count() == 0


def test_label_model_ranks_voters():
    """Accuracies from agreements alone: good voters add more evidence than a voter at random."""
    rng = np.random.default_rng(1)
    n, prior = 20000, 0.1
    y = rng.random(n) < prior
    rates = [(0.7, 0.01), (0.6, 0.02), (0.5, 0.01), (0.1, 0.1)]
    votes = np.stack([rng.random(n) < np.where(y, a, b) for a, b in rates], axis=1).astype(int)
    adds = toxicity.evidence(votes.T @ votes, n, prior)
    assert min(adds[:3]) > 1.5 > adds[3]


def simulated(n, prior, label_accuracy, seed=1):
    rng = np.random.default_rng(seed)
    y = rng.random(n) < prior
    votes = np.stack([rng.random(n) < np.where(y, a, b) for a, b in ((0.7, 0.01), (0.6, 0.02), (0.5, 0.01), (0.4, 0.02))], axis=1).astype(int)
    return y, votes, np.where(rng.random(n) < label_accuracy, y, ~y).astype(int)


def test_label_is_a_voter_of_estimated_accuracy():
    prior = 0.3
    odds = []
    for accuracy in (0.95, 0.8, 0.65):
        y, votes, labels = simulated(20000, prior, accuracy)
        strength = toxicity.label_model(votes.T @ votes, len(y), prior)[2]
        odds.append(toxicity.label_evidence(votes, labels, strength, prior))
    assert odds[0][0] > odds[1][0] > odds[2][0] > 0 > odds[2][1] > odds[1][1] > odds[0][1]
    most = toxicity.label_evidence(votes[:0], labels[:0], strength, prior)
    assert most[0] >= odds[0][0] and most[1] <= odds[0][1]


def test_posteriors_weigh_votes_against_labels():
    prior = 0.3
    y, votes, labels = simulated(20000, prior, 0.8)
    rows, model = [np.flatnonzero(v).tolist() for v in votes], toxicity.label_model(votes.T @ votes, len(y), prior)
    post = toxicity.posteriors(rows, [None if i % 2 else t for i, t in enumerate(labels.tolist())], [0, 1, 2, 3], model, prior)
    assert ((post >= 0.5) == y).mean() > 0.93 > (labels == y).mean()
    many, none, unlabelled = votes.sum(axis=1) >= 3, votes.sum(axis=1) == 0, np.arange(len(y)) % 2 == 1
    assert post[many & ~unlabelled & (labels == 0)].min() > 0.5 > post[none & ~unlabelled & (labels == 1)].max()
    assert post[none & unlabelled].max() < prior < post[many & unlabelled].min()


def test_documents_without_label_train(spark, monkeypatch):
    data, labels = corpus(600)
    seen, fit = [], toxicity.fitted
    monkeypatch.setattr(toxicity, "fitted", lambda rows, target, *a: seen.append((len(rows), target)) or fit(rows, target, *a))
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    toxicity.trained(docs, spark.createDataFrame(labels[:300], "doc_id long, quality int, toxic int"))
    (n, target), = seen
    assert n == len(target) == sum(zlib.crc32(str(r[0]).encode()) % 5 != 0 for r in data)


def in_two_languages(n=40000, prior=0.1, label_accuracy=0.95, seed=3):
    """Truth, votes and labels; voters 0 to 3 know one language, 4 to 7 the other, so the two sets never vote together."""
    rng = np.random.default_rng(seed)
    y, second = rng.random(n) < prior, rng.random(n) < 0.5
    votes = [(rng.random(n) < np.where(y, 0.6, 0.01)) & (second == (k >= 4)) for k in range(8)]
    # As in the operator, a label says toxic about as often as the prior has it.
    flip = rng.random(n) > label_accuracy
    return y, np.stack(votes, axis=1).astype(int), np.where(flip, rng.random(n) < prior, y).astype(int)


def counted(votes, labels):
    """The matrices of ``agreements``, by brute force."""
    both = np.column_stack([votes, np.ones(len(votes), int), labels])
    parts = []
    for cut in toxicity.halves(votes.shape[1]):
        sides = np.column_stack([votes[:, cut == 0].any(axis=1), votes[:, cut == 1].any(axis=1), np.ones(len(votes), int), labels]).astype(int)
        parts.append(sides.T @ sides)
    return both.T @ both, np.array(parts)


def test_label_joins_voters_that_never_meet():
    prior = 0.1
    found = []
    for accuracy in (0.98, 0.8, 0.6):
        y, votes, labels = in_two_languages(label_accuracy=accuracy)
        both, parts = counted(votes, labels)
        found.append(toxicity.label_strength(parts[:2], len(y), prior))
        # Halves that mix the languages agree by what they know, so the label's strength is that of its making.
        assert abs(found[-1] - min(accuracy, 2 * toxicity.LABEL_ACCURACY - 1)) < 0.08
        model = toxicity.label_model(both[:-2, :-2], len(y), prior, toxicity.with_label(both), found[-1])
        rows = [np.flatnonzero(v).tolist() for v in votes]
        post = toxicity.posteriors(rows, [None] * len(rows), list(range(8)), model, prior, found[-1])
        said = votes.sum(axis=1) >= 2
        assert y[said].mean() > 0.95 and post[said].min() > 0.5 > post[votes.sum(axis=1) == 0].max()
    assert found[0] > found[1] > found[2]


def test_agreements_count_all_documents(spark):
    rng = np.random.default_rng(5)
    votes, labels = (rng.random((500, 5)) < 0.3).astype(int), rng.integers(0, 2, 500)
    known = rng.random(500) < 0.6
    rows = [([10 * int(k) for k in np.flatnonzero(v)] + [7], int(t) if k else None) for v, t, k in zip(votes, labels, known)]
    notes = spark.createDataFrame(rows, "hits array<int>, toxic int").repartition(3)
    both, parts, n = toxicity.agreements(notes, [0, 10, 20, 30, 40])
    wide = np.column_stack([votes, known, known & (labels == 1)]).astype(int)
    assert n == 500 and (both == wide.T @ wide).all()
    for cut, part in zip(toxicity.halves(5), parts):
        sides = np.column_stack([votes[:, cut == 0].any(axis=1), votes[:, cut == 1].any(axis=1), wide[:, 5], wide[:, 6]]).astype(int)
        assert (part == sides.T @ sides).all()
    assert toxicity.label_strength(np.zeros((toxicity.CUTS, 4, 4)), 0, 0.1) == 2 * toxicity.LABEL_ACCURACY - 1


def test_patterns_are_counted_over_all_labelled_rows(spark, monkeypatch):
    """Neither the bound of the fit nor the flushes of a task's counts change what is counted."""
    data, labels = corpus(400)
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    usable = toxicity.usable_labels(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    whole = toxicity.mined(docs, usable)
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 50)
    monkeypatch.setattr(toxicity, "HELD_COUNTS", 20)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        assert toxicity.mined(docs, usable) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    texts = {d: t for d, t, *_ in data}
    kept = {d: y for d, _, y in labels if zlib.crc32(str(d).encode()) % 5}
    for pattern, toxic, other in whole[0][:20]:
        has = [y for d, y in kept.items() if pattern in {p for w in toxicity.words_of_text(texts[d] or "") for p in toxicity.patterns_of(w)}]
        assert (sum(has), len(has) - sum(has)) == (toxic, other)
    assert (whole[1], whole[2]) == (sum(kept.values()), len(kept) - sum(kept.values()))
