"""Toxicity scores from weak supervision.

1. Patterns (words and beginnings of words) are counted over all labelled rows
   that are not held out; the ``FEATURES`` most telling ones are the
   classifier's features.
2. One pass over all whole texts notes which features and which voters each
   document has. Voters are word lists, form patterns and the mined patterns
   that speak for toxicity; a voter votes toxic or abstains.
3. A generative label model reads the voters' rates and pairwise agreements
   over all documents. Agreements are fitted by a product of two voters'
   strengths, which gives each voter's accuracy; what the product leaves over
   is their correlation, and correlated voters share their weight. The
   posterior of a row adds up the evidence of votes and of abstentions. A label
   is one more voter, which says toxic or clean where there is one. Its
   accuracy comes from its agreement with two halves of the other voters, which
   between them speak all languages, and it is the one voter that the voters of
   different languages share, so its agreements count as much as all others in
   the fit of their accuracies.
4. A linear classifier is trained on the posteriors of a bounded sample of all
   documents that are not held out, and scores every document. A document
   without label counts as ``UNLABELLED_WEIGHT`` of one with a label: its
   posterior follows from votes alone, and toxic documents that no voter knows
   look clean there.

Only rows of the classifier's sample, at most about ``TRAIN_ROWS``, and tables
of the size of the feature list reach the driver. Labels, language, source and id are never
features.

Defined results: null and empty texts score by the bias alone; without
labelled rows of both classes the word lists decide; several labels of one
document count as toxic if any is; repeated rows score alike; rows without id
are not held out and never train; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carriageway.llm.common import side, whole_text
from carriageway.operators.settle import settled

#: Bound of the documents that the classifier is fitted on.
TRAIN_ROWS = 20_000
#: Weight of a document without label in that fit.
UNLABELLED_WEIGHT = 0.1
#: Ways of cutting the voters into halves; the label's accuracy is the median over them.
CUTS = 4
#: Counts that a task holds before it hands them on.
HELD_COUNTS = 1_000_000
FEATURES = 2048
MINED_VOTERS = 48
LEAST_DOCS = 3
LEAST_DEVIATIONS = 4.0
PREFIXES = range(3, 8)
#: Accuracy of a label where no voter agrees with labels, so that none can be estimated; and the most that an estimate may be.
LABEL_ACCURACY = 0.98
FOLDS = 5

#: Word lists of general insults; each list is a voter.
LISTS = {
    "person": "idiot moron loser clown scum jerk fool trash garbage bastard creep freak dumbass coward pig rat vermin parasite".split(),
    "judgement": "stupid pathetic disgusting worthless dumb ugly vile filthy despicable useless brainless hateful repulsive".split(),
    "french": "connard connasse imbécile crétin débile abruti salaud ordure".split(),
    "german": "arschloch dummkopf idiotin trottel depp abschaum widerlich dreckig".split(),
    "spanish": "idiota imbécil estúpido estúpida pendejo cabrón basura asqueroso inútil".split(),
}
FORMS = {
    "address": re.compile(r"\b(?:you|your|u)\b(?:\W+\w+){0,3}?\W+(?:idiot|moron|loser|clown|fool|scum|trash|stupid|pathetic|disgusting|worthless|dumb)"),
    "threat": re.compile(r"\b(?:i|we)(?:'ll| will| am going to| are going to) (?:kill|hurt|find|beat|destroy) (?:you|u|them)\b"),
    "wish": re.compile(r"\b(?:go|just) (?:die|to hell)\b|\bshut up\b|\bhate you\b"),
}

_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    """Pattern to feature number, voters (feature or extra numbers), and after fitting the classifier."""

    features: dict[str, int]
    voters: list[int]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0


def patterns_of(word: str) -> list[str]:
    return ["=" + word, *["^" + word[:n] for n in PREFIXES if n <= len(word)]]


def words_of_text(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def extras_of(text: str, words: set[str]) -> list[int]:
    """Numbers, from 0, of the lists and forms that a text has."""
    low = text.lower()
    hits = [k for k, names in enumerate(LISTS.values()) if not words.isdisjoint(names)]
    return hits + [len(LISTS) + k for k, form in enumerate(FORMS.values()) if form.search(low)]


def usable_labels(labels: DataFrame) -> DataFrame:
    """(label_id, toxic) of the labelled documents that are not held out."""
    return (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out())
              .groupBy(F.col("doc_id").alias("label_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))


def bounded(rows: DataFrame, key: str) -> DataFrame:
    """At most about ``TRAIN_ROWS`` of the rows, chosen by a hash of the key."""
    share = min(1.0, TRAIN_ROWS / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) <= F.lit(int(share * (1 << 30))))


def held_out():
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(remainder == 0, F.lit(False))


def mined(docs: DataFrame, usable: DataFrame) -> tuple[list[tuple[str, int, int]], int, int]:
    """The most telling (pattern, toxic documents, other documents) of the labelled rows, and their two class sizes.

    ``usable`` is a written table of (label_id, toxic).
    """
    rows = docs.select(F.col("doc_id"), whole_text().alias("text")).join(side(usable), F.col("doc_id") == F.col("label_id"))

    def handed(toxic: Counter, other: Counter, n: list[int]) -> pa.RecordBatch:
        names = [*(toxic.keys() | other.keys())]
        return pa.RecordBatch.from_arrays([
            pa.array(["", *names], pa.string()), pa.array([n[1], *[toxic[p] for p in names]], pa.int64()),
            pa.array([n[0], *[other[p] for p in names]], pa.int64())], ["pattern", "toxic", "other"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, other, n = Counter(), Counter(), [0, 0]
        for batch in batches:
            if len(toxic) + len(other) > HELD_COUNTS:
                yield handed(toxic, other, n)
                toxic, other, n = Counter(), Counter(), [0, 0]
            for text, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found = {p for w in words_of_text(text) for p in patterns_of(w)}
                (toxic if y else other).update(found)
                n[bool(y)] += 1
        yield handed(toxic, other, n)

    counts = settled(rows.select("text", "toxic").mapInArrow(count, "pattern string, toxic long, other long").groupBy("pattern")
                     .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).where(F.col("toxic") + F.col("other") >= LEAST_DOCS),
                     "toxicity-counts")
    size = counts.where("pattern = ''").collect()
    if not size or not size[0]["toxic"] or not size[0]["other"]:
        return [], 0, 0
    n1, n0 = size[0]["toxic"], size[0]["other"]
    p1, p0 = (F.col("toxic") + 0.5) / (n1 + 1.0), (F.col("other") + 0.5) / (n0 + 1.0)
    telling = F.abs(F.log(p1 / p0)) * F.sqrt(F.abs(p1 - p0))
    # A pattern whose rates differ by chance would only add noise to the classifier.
    rate = (F.col("toxic") + F.col("other")) / (n1 + n0)
    beyond = F.abs(F.col("toxic") / n1 - F.col("other") / n0) / F.sqrt(rate * (1 - rate) * (1 / n1 + 1 / n0) + F.lit(1e-12))
    top = counts.where((F.col("pattern") != "") & (beyond >= LEAST_DEVIATIONS)).orderBy(telling.desc(), "pattern").limit(FEATURES).collect()
    return [(r["pattern"], r["toxic"], r["other"]) for r in top], n1, n0


def model_for(counts: list[tuple[str, int, int]], n1: int, n0: int) -> Model:
    """Features by number; voters: all lists and forms, and mined patterns that speak for toxicity, one of each nest of prefixes."""
    features = {p: k for k, (p, _, _) in enumerate(counts)}
    n = len(features)
    voters = list(range(n, n + len(LISTS) + len(FORMS)))
    seen: set[tuple[str, int, int]] = set()
    for p, toxic, other in counts:
        lift = (toxic + 0.5) / (n1 + 1) / ((other + 0.5) / (n0 + 1))
        nest = (p[1:4], toxic, other)
        if toxic >= LEAST_DOCS and lift >= 8 and nest not in seen:
            seen.add(nest)
            voters.append(features[p])
            if len(voters) >= MINED_VOTERS + len(LISTS) + len(FORMS):
                break
    return Model(features, voters)


def noted(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, hits): the numbers of features, lists and forms of each whole text."""
    features = model.features
    longest = max(PREFIXES)

    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                words, hits = words_of_text(text), set()
                for w in words:
                    # Beyond its longest prefix a word counts as itself only, so the memory stays with short forms.
                    found = known.get(w)
                    if found is None:
                        found = tuple(features[p] for p in patterns_of(w) if p in features)
                        if len(known) < 500_000 and len(w) <= 4 * longest:
                            known[w] = found
                    if found:
                        hits.update(found)
                out.append(sorted(hits) + [len(features) + k for k in extras_of(text, words)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(out, pa.list_(pa.int32()))], ["doc_id", "held_out", "hits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), whole_text().alias("text"))
    return rows.mapInArrow(note, "doc_id long, held_out boolean, hits array<int>")


def halves(n_voters: int) -> np.ndarray:
    """``CUTS`` ways of telling the voters apart into two halves, as one row of 0 and 1 each: the digits of the voter's place."""
    return np.stack([(np.arange(n_voters) >> cut) & 1 for cut in range(CUTS)])


def agreements(notes: DataFrame, voters: list[int]) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents in which voters i and j both vote, as a matrix, over all documents; the same of each cut's halves; and their number.

    Two more columns of both count documents with a label and with a label toxic. The second result has one 4 x 4 matrix
    per cut: first half, second half, labelled, labelled toxic.
    """
    place = {v: k for k, v in enumerate(voters)}
    j, cuts = len(voters), halves(len(voters))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, parts, n = np.zeros((j + 2, j + 2), np.int64), np.zeros((CUTS, 4, 4), np.int64), 0
        for batch in batches:
            for hits, label in zip(batch.column("hits").to_pylist(), batch.column("toxic").to_pylist()):
                at = [place[h] for h in hits if h in place]
                told = [] if label is None else [0, 1] if label else [0]
                n += 1
                if at or told:
                    both[np.ix_(at + [j + t for t in told], at + [j + t for t in told])] += 1
                    for cut in range(CUTS):
                        in_cut = sorted({int(h) for h in cuts[cut, at]}) + [2 + t for t in told]
                        parts[cut][np.ix_(in_cut, in_cut)] += 1
        flat = np.concatenate([both.ravel(), parts.ravel()])
        at, = np.nonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *at.tolist()], pa.int32()), pa.array([n, *flat[at].tolist()], pa.int64())], ["at", "n"])

    # At most voters squared rows come back.
    rows = notes.select("hits", "toxic").mapInArrow(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    flat, total = np.zeros((j + 2) ** 2 + CUTS * 16), 0
    for r in rows:
        if r["at"] < 0:
            total = r["n"]
        else:
            flat[r["at"]] = r["n"]
    return flat[:(j + 2) ** 2].reshape(j + 2, j + 2), flat[(j + 2) ** 2:].reshape(CUTS, 4, 4), total


def with_label(both: np.ndarray) -> np.ndarray:
    """Covariance of each voter, or half, with the label on labelled documents; the last two columns are labelled and labelled toxic."""
    labelled = max(1.0, both[-2, -2])
    return both[:-2, -1] / labelled - both[:-2, -2] / labelled * both[-1, -1] / labelled


def label_strength(parts: np.ndarray, n: int, prior: float) -> float:
    """The label's strength by triplets: two halves of the voters agree with it and with one another."""
    most, found = 2 * LABEL_ACCURACY - 1, []
    for part in parts:
        one, two = with_label(part)
        between = part[0, 1] / max(1, n) - part[0, 0] * part[1, 1] / max(1, n) ** 2
        if min(one, two, between) > 0:
            found.append(math.sqrt(one * two / (prior * (1 - prior) * between)))
    return min(float(np.median(found)), most) if found else most


def evidence(both: np.ndarray, n: int, prior: float) -> np.ndarray:
    """Log odds that a vote adds, per voter, from rates and agreements alone."""
    return label_model(both, n, prior)[0]


def label_model(both: np.ndarray, n: int, prior: float, label: np.ndarray | None = None, own: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per voter: the log odds that a vote adds, those that an abstention adds (none or less), and its strength.

    The covariance of two voters is prior (1 - prior) times the product of
    their strengths; a least-squares product is fitted over pairs that agree
    more often than by chance, the only ones the model explains. ``label``
    holds the voters' covariances with the label, whose strength is ``own``:
    one more pair per voter, of the weight of as many as there are voters.
    """
    label = np.zeros(len(both)) if label is None else np.maximum(label, 0)
    weight = len(both) if own > 0 and label.any() else 0
    rate = np.diag(both) / max(1, n)
    covariance = both / max(1, n) - np.outer(rate, rate)
    use = covariance > 0
    np.fill_diagonal(use, False)
    spread = prior * (1 - prior)
    strength = np.sqrt(np.maximum(np.where(use, covariance, 0).max(axis=1, initial=0), 1e-9) / spread)
    for _ in range(200):
        top = (np.where(use, covariance, 0) * strength).sum(axis=1) + weight * label * own
        low = spread * ((use * strength**2).sum(axis=1) + weight * own**2) + 1e-9
        strength = 0.5 * strength + 0.5 * np.where(use.any(axis=1) | (weight > 0), top / low, strength)
    hit_if_toxic = np.clip(rate + (1 - prior) * strength, 1e-6, 1.0)
    accuracy = np.clip(prior * hit_if_toxic / np.maximum(rate, 1e-9), prior, 0.99)
    left = np.where(use, covariance - spread * np.outer(strength, strength), 0)
    scale = np.sqrt(np.outer(rate * (1 - rate), rate * (1 - rate))) + 1e-9
    shared = 1 + np.clip(left / scale, 0, 1).sum(axis=1)
    logit = np.log(accuracy / (1 - accuracy))
    votes = np.where(rate > 0, np.maximum(logit - math.log(prior / (1 - prior)), 0) / shared, 0.0)
    silent_if_toxic = np.maximum(1 - accuracy * rate / prior, 0.01)
    silent_if_clean = np.maximum(1 - (1 - accuracy) * rate / (1 - prior), 0.01)
    abstains = np.where(votes > 0, np.minimum(np.log(silent_if_toxic / silent_if_clean), 0) / shared, 0.0)
    return votes, abstains, np.where(votes > 0, strength, 0.0)


def label_evidence(votes: np.ndarray, labels: np.ndarray, strength: np.ndarray, prior: float) -> tuple[float, float]:
    """Log odds that a label toxic and a label clean add.

    ``votes`` are the votes (0 or 1) on labelled rows. As for two voters, the
    covariance of the label with a voter is prior (1 - prior) times the product
    of their strengths, and the voters' are known.
    """
    most = 2 * LABEL_ACCURACY - 1
    own = most
    if len(labels):
        covariance = ((labels - labels.mean())[:, None] * (votes - votes.mean(axis=0))).mean(axis=0)
        weight = np.where(covariance > 0, strength, 0.0)
        if (weight**2).sum() > 0:
            own = float(np.clip((covariance * weight).sum() / (prior * (1 - prior) * (weight**2).sum()), 0.0, most))
    return told(own, prior)


def told(own: float, prior: float) -> tuple[float, float]:
    """Log odds that a label toxic and a label clean of strength ``own`` add; labels say toxic as often as the prior has it."""
    if_toxic, if_clean = prior + (1 - prior) * own, prior - prior * own
    return math.log(if_toxic / if_clean), math.log((1 - if_toxic) / (1 - if_clean))


def posteriors(rows: list[list[int]], labels: list[int | None], voters: list[int], model: tuple[np.ndarray, np.ndarray, np.ndarray],
               prior: float, own: float | None = None) -> np.ndarray:
    """Probability that a row is toxic, from the votes in its hits and from its label, where it has one.

    The label's strength is ``own``, or follows from the rows and the voters' strengths.
    """
    place = {v: k for k, v in enumerate(voters)}
    votes = np.zeros((len(rows), len(voters)))
    for r, hits in enumerate(rows):
        votes[r, [place[h] for h in hits if h in place]] = 1
    vote, abstain, strength = model
    known = np.array([y is not None for y in labels], bool)
    given = np.array([y or 0 for y in labels], float)
    says_toxic, says_clean = label_evidence(votes[known], given[known], strength, prior) if own is None else told(own, prior)
    logit = math.log(prior / (1 - prior)) + votes @ vote + (1 - votes) @ abstain
    logit += np.where(known, np.where(given > 0, says_toxic, says_clean), 0.0)
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fitted(rows: list[list[int]], target: np.ndarray, n_features: int, weights: np.ndarray | None = None, turns: int = 600,
           ridge: float = 0.3) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels of rows that may weigh differently.

    Accelerated gradient steps with a step size per feature: for features that
    are 0 or 1, the curvature is at most a quarter of the diagonal that holds,
    per feature, the weighted numbers of features of the rows that have it.
    """
    of_row = np.ones(len(rows)) if weights is None else weights
    sizes = np.array([len(r) + 1 for r in rows])
    at = np.repeat(np.arange(len(rows)), sizes)
    col = np.fromiter((c for r in rows for c in [*r, n_features]), np.int64, len(at))
    ridges = np.full(n_features + 1, ridge)
    ridges[-1] = 0
    step = 1 / (np.bincount(col, weights=(of_row * sizes)[at], minlength=n_features + 1) / 4 + ridges + 1e-9)
    w = v = np.zeros(n_features + 1)
    for t in range(turns):
        ahead = v + (t / (t + 3)) * (v - w)
        w = v
        z = np.bincount(at, weights=ahead[col], minlength=len(rows))
        gap = of_row * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        v = ahead - step * (np.bincount(col, weights=gap[at], minlength=n_features + 1) + ridges * ahead)
    return v[:-1], float(v[-1])


def trained(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame]:
    """The fitted model and the noted documents."""
    usable = settled(usable_labels(labels), "toxicity-labels")
    counts, n1, n0 = mined(docs, usable)
    model = model_for(counts, n1, n0)
    notes = noted(docs, model).join(side(usable), F.col("doc_id") == F.col("label_id"), "left").drop("label_id")
    notes = settled(notes, "toxicity-notes")
    size = len(model.features) + len(LISTS) + len(FORMS)
    if not counts:
        model.weights, model.bias = np.full(size, 4.0), -2.0
        return model, notes
    prior = min(0.5, n1 / (n1 + n0))
    both, parts, n = agreements(notes, model.voters)
    own = label_strength(parts, n, prior)
    voted = label_model(both[:-2, :-2], n, prior, with_label(both), own)
    fit = settled(bounded(notes.where("NOT held_out AND doc_id IS NOT NULL").select("doc_id", "hits", "toxic"), "doc_id"), "toxicity-fit")
    rows = fit.select("hits", "toxic").collect()
    hits, given = [r["hits"] for r in rows], [r["toxic"] for r in rows]
    weights = np.array([UNLABELLED_WEIGHT if y is None else 1.0 for y in given])
    model.weights, model.bias = fitted(hits, posteriors(hits, given, model.voters, voted, prior, own), size, weights)
    return model, notes


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    model, notes = trained(docs, labels)
    weights, bias = model.weights, model.bias

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = np.array([weights[h].sum() + bias for h in batch.column("hits").to_pylist()])
            s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()),
                                              pa.array((s >= 0.5).astype(np.int32), pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return notes.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
