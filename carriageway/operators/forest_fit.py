"""Forest classifiers grown on counts per bin, level by level, on rows packed into blocks.

``pyspark.ml`` handles a row at a time: at every level each row walks each tree and is counted by hash maps and loops,
so a forest of 200 trees takes about a microsecond per row, tree and level. Here a row is a few bytes, its bin
numbers, and a whole block of rows walks a tree and is counted at once. A task sends its counts tree by tree, Spark
adds up those of all tasks, and each tree's splits are chosen where its sums meet; the driver holds the trees only.
The rules are those of ``RandomForestClassifier``: a Poisson draw of every row per tree, a subset of the features per
node, Gini gain, ordered categories, leaves of the same class merged. Draws come from a hash of a row's key, so
neither partitions nor the order of rows change a forest, as they do in ``pyspark.ml``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from math import ceil, exp, factorial, sqrt

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carriageway.operators.settle import settled
from carriageway.session import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

#: Rows of a block: its bin numbers stay in a core's cache while it walks a tree.
BLOCK = 65_536
#: Points of a number's distribution that its cuts are taken from.
POINTS = 2_000

BLOCKS = "n int, bins binary, labels binary, hashes binary"
COUNTS = "tree int, counts binary"
SPLITS = "tree int, feature binary, right binary, gain binary, own binary, left binary"
SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
NODE = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                  ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", SPLIT)])
SAVED = pa.schema([("treeID", pa.int32()), ("nodeData", NODE)])


def poisson_table() -> np.ndarray:
    """Times that a row is drawn, by 16 even bits: Poisson numbers of mean one."""
    upto = np.cumsum([exp(-1) / factorial(k) for k in range(9)])
    return np.searchsorted(np.round(upto * 65_536), np.arange(65_536), side="right").astype(np.uint8)


def draws(hashes: np.ndarray, salt: np.uint32, table: np.ndarray) -> np.ndarray:
    """How often each row is drawn for the tree of this salt."""
    h = hashes ^ salt
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    return table.take((h ^ (h >> np.uint32(16))) >> np.uint32(16))


def subset(seed: int, tree: int, level: int, features: int, size: int) -> np.ndarray:
    """The features that each node of a tree's level may split on."""
    return np.random.default_rng([seed, tree, level]).random((1 << level, features)).argsort(axis=1)[:, :size]


def cut_points(df: DataFrame, x: str, arity: dict[int, int], features: int, bins: int) -> list[np.ndarray]:
    """Between which values a number may be split: between any two where there are few, else at even shares of the rows."""
    numbers = [f for f in range(features) if f not in arity]
    steps = F.lit(np.arange(POINTS + 1) / POINTS)
    found = df.agg(*[F.percentile_approx(F.get(x, F.lit(f)), steps, 10_000) for f in numbers]).first() if numbers else []
    cuts = [np.zeros(0)] * features
    for f, points in zip(numbers, found):
        values = np.unique(points)
        ends = values if len(values) <= bins else np.unique(np.array(points)[[round(k * POINTS / bins) for k in range(1, bins)]])
        ends = ends[ends < values[-1]]
        cuts[f] = (ends + values[np.searchsorted(values, ends, side="right")]) / 2
    return cuts


def packed(df: DataFrame, x: str, cuts: list[np.ndarray]) -> DataFrame:
    """Rows of ``x``, ``label`` and ``hash`` as blocks: bin numbers by feature, labels, and the hashes that draws come from."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(parts):
            b, y, h = (np.concatenate(p, axis=-1) for p in zip(*parts))
            return pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32()), *(pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in (b, y, h))], names=["n", "bins", "labels", "hashes"])

        held, n = [], 0
        for batch in batches:
            values = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, len(cuts))
            codes = np.stack([np.searchsorted(c, values[:, f]) if len(c) else values[:, f] for f, c in enumerate(cuts)]).astype(np.uint8)
            held.append((codes, batch.column(1).to_numpy().astype(np.uint8), batch.column(2).to_numpy().astype(np.uint32)))
            n += batch.num_rows
            if n >= BLOCK:
                yield block(held)
                held, n = [], 0
        if n:
            yield block(held)

    return df.select(x, "label", "hash").mapInArrow(pack, BLOCKS)


def level_counts(blocks: DataFrame, level: int, trees: dict, seed: int, salts: np.ndarray, features: int, size: int, bins: int) -> DataFrame:
    """Per tree: drawn rows by class, bin, node of the level, and feature of the node's subset. A row for each task and tree."""
    table, nodes, first = poisson_table(), 1 << level, (1 << level) - 1
    feature, right, live = trees["feature"][:, :first].copy(), trees["right"][:, :first].copy(), trees["live"][:, first:first + nodes].copy()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for n, b, y, h in zip(*(c.to_pylist() for c in batch.columns)):
                held.append((n, np.frombuffer(b, np.uint8), np.frombuffer(y, np.uint8), np.frombuffer(h, np.uint32)))
        for tree in np.flatnonzero(live.any(axis=1)) if held else []:
            sums = np.zeros((size, nodes * bins * 2))
            pick, to_right, alive = subset(seed, tree, level, features, size).T.astype(np.int32).copy(), right[tree].ravel(), live[tree]
            for n, codes, labels, hashes in held:
                drawn = draws(hashes, salts[tree], table)
                rows = np.flatnonzero(drawn).astype(np.int32)
                at, places = np.zeros(len(rows), np.int32), feature[tree] * np.int32(n)
                for _ in range(level):  # every place is one of the table: without "wrap" each one is checked
                    code = codes.take(places.take(at, mode="wrap") + rows, mode="wrap")
                    at = 2 * at + 1 + to_right.take(at * np.int32(bins) + code, mode="wrap")
                at -= np.int32(first)
                if not alive.all():
                    keep = alive.take(at, mode="wrap")
                    rows, at = rows[keep], at[keep]
                weights, of_class = drawn.take(rows, mode="wrap").astype(np.float64), at * np.int32(2 * bins) + labels.take(rows, mode="wrap")
                for k in range(size):
                    code = codes.take((pick[k] * np.int32(n)).take(at, mode="wrap") + rows, mode="wrap")
                    sums[k] += np.bincount(of_class + 2 * code.astype(np.int32), weights, nodes * bins * 2)
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([sums.astype(np.uint32).tobytes()], pa.binary())], names=["tree", "counts"])

    return blocks.mapInArrow(count, COUNTS)


def gini(counts: np.ndarray) -> np.ndarray:
    """Impurity of counts by class, which lie on the last axis; zero where there are none."""
    total = counts.sum(axis=-1)
    return np.where(total > 0, 1 - (counts**2).sum(axis=-1) / np.maximum(total, 1) ** 2, 0)


def best_splits(sums: np.ndarray, pick: np.ndarray, categorical: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Per node: feature (-1: a leaf), bins that go right, gain, its own counts, and those of its left side.

    ``sums`` lie by feature of the subset, node, bin and class.
    """
    size, nodes, bins, _ = sums.shape
    own = sums[0].sum(axis=1)
    total, here = own.sum(axis=1), gini(own)
    best, feature, left = np.zeros(nodes), np.full(nodes, -1, np.int32), np.zeros((nodes, 2))
    right, each = np.zeros((nodes, bins), np.uint8), np.arange(nodes)
    for k in range(size):
        n = sums[k].sum(axis=2)
        share = np.where(n > 0, sums[k][:, :, 1] / np.maximum(n, 1), np.inf)  # categories by the share of class one, those without rows last
        order = np.where(categorical[pick[:, k]][:, None], share.argsort(axis=1, kind="stable"), np.arange(bins))
        upto = np.take_along_axis(sums[k], order[:, :, None], axis=1).cumsum(axis=1)[:, :-1]
        beyond = own[:, None] - upto
        a, b = upto.sum(axis=2), beyond.sum(axis=2)
        gain = here[:, None] - (a * gini(upto) + b * gini(beyond)) / np.maximum(total, 1)[:, None]
        gain = np.where((a >= least) & (b >= least), gain, -np.inf)
        spot = gain.argmax(axis=1)
        won = gain[each, spot] > best
        best[won], feature[won], left[won] = gain[each, spot][won], pick[won, k], upto[each, spot][won]
        places = np.empty_like(order)
        np.put_along_axis(places, order, np.arange(bins)[None, :], axis=1)
        right[won] = (places > spot[:, None])[won]
    return feature, right, best, own, left


def level_splits(counts: DataFrame, level: int, seed: int, features: int, size: int, bins: int, categorical: np.ndarray, least: int) -> DataFrame:
    """A row per tree: the splits of a level, from the sums of all tasks' counts."""
    nodes = 1 << level

    def choose(key: tuple, table: pa.Table) -> pa.Table:
        tree, sums = key[0].as_py(), np.zeros(size * nodes * bins * 2)
        for c in table.column("counts"):
            sums += np.frombuffer(c.as_buffer(), np.uint32)
        found = best_splits(sums.reshape(size, nodes, bins, 2), subset(seed, tree, level, features, size), categorical, least)
        return pa.table([pa.array([tree], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in found)], names=["tree", "feature", "right", "gain", "own", "left"])

    return counts.groupBy("tree").applyInArrow(choose, SPLITS)


def saved_tree(tree: int, trees: dict, cuts: list[np.ndarray], arity: dict[int, int], depth: int) -> list[dict]:
    """The nodes of a tree as ``pyspark.ml`` saves them; a node whose two leaves are of the same class is a leaf."""
    feature, right, stats, gains = (trees[x][tree] for x in ("feature", "right", "stats", "gain"))
    inner, guess = feature >= 0, stats.argmax(axis=1)
    for at in range((1 << depth) - 2, -1, -1):
        a, b = 2 * at + 1, 2 * at + 2
        if inner[at] and not inner[a] and not inner[b] and guess[a] == guess[b]:
            inner[at] = False
    rows, impurity = [], gini(stats)

    def add(at: int) -> int:
        row = {"id": len(rows), "prediction": float(guess[at]), "impurity": float(impurity[at]), "impurityStats": stats[at].tolist(), "rawCount": int(stats[at].sum()),
               "gain": -1.0, "leftChild": -1, "rightChild": -1, "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
        rows.append(row)
        if inner[at]:
            f = int(feature[at])
            to_left = np.flatnonzero(right[at] == 0)
            values = [float(c) for c in to_left if c < arity[f]] if f in arity else [float(cuts[f][to_left[-1]])]
            row.update(gain=float(gains[at]), split={"featureIndex": f, "leftCategoriesOrThreshold": values, "numCategories": arity.get(f, -1)})
            row["leftChild"] = add(2 * at + 1)
            row["rightChild"] = add(2 * at + 2)
        return row["id"]

    add(0)
    return [{"treeID": tree, "nodeData": r} for r in rows]


class BinnedForest(RandomForestClassifier):
    """``RandomForestClassifier`` of two classes, grown as described above; with more classes, weights or other rules it is that of ``pyspark.ml``.

    ``key`` names the column whose hash decides a row's draws; without such a column they follow the row's place.
    """

    def __init__(self, *, key: str | None = None, **params):
        super().__init__(**params)
        self.key = key

    def _fit(self, df: DataFrame) -> RandomForestClassificationModel:
        x, label, bins = self.getFeaturesCol(), F.col(self.getLabelCol()).cast("double"), min(self.getMaxBins(), 256)
        plain = {self.impurity: "gini", self.subsamplingRate: 1.0, self.bootstrap: True, self.featureSubsetStrategy: "auto", self.minInfoGain: 0.0, self.minWeightFractionPerNode: 0.0}
        top = df.agg(F.max(F.when(label.isin(0.0, 1.0), label).otherwise(2.0))).first()[0]
        attrs = df.schema[x].metadata.get("ml_attr", {}).get("attrs", {})
        arity = {a["idx"]: len(a["vals"]) for a in attrs.get("nominal", []) if "vals" in a}
        if top != 1 or max(arity.values(), default=0) > bins or any(self.getOrDefault(k) != v for k, v in plain.items()) or self.isDefined(self.weightCol):
            return super()._fit(df)
        draw = F.xxhash64(self.key if self.key in df.columns else F.monotonically_increasing_id()).bitwiseAND(F.lit(0xFFFFFFFF))
        rows = df.select(vector_to_array(x).alias("_x"), label.alias("label"), draw.alias("hash"))
        features = len(df.select(x).first()[0])
        cuts = cut_points(rows, "_x", arity, features, bins)
        blocks = settled(packed(rows, "_x", cuts), "forest-blocks")
        trees = self._grow(blocks, arity, features, bins)
        # A model of the same parameters, fitted on copies of a row of each class, whose nodes are then replaced by those grown here.
        path = shared_dir(df.sparkSession, "forest-grown")
        some = df.where(label == 0).limit(1).unionByName(df.where(label == 1).limit(1))
        super()._fit(some.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(bins))))).write().save(path)
        nodes = [pa.Table.from_pylist(saved_tree(t, trees, cuts, arity, self.getMaxDepth()), SAVED) for t in range(self.getNumTrees())]
        df.sparkSession.createDataFrame(pa.concat_tables(nodes)).write.mode("overwrite").parquet(f"{path}/data")
        return RandomForestClassificationModel.load(path)

    def _grow(self, blocks: DataFrame, arity: dict[int, int], features: int, bins: int) -> dict:
        """All nodes by tree and place; the children of place p are 2 p + 1 and 2 p + 2."""
        count, depth, least, seed = self.getNumTrees(), self.getMaxDepth(), self.getMinInstancesPerNode(), self.getSeed() & 0xFFFFFFFF
        size, salts = ceil(sqrt(features)), np.random.default_rng(seed).integers(0, 2**32, count, dtype=np.uint32)
        categorical, places = np.array([f in arity for f in range(features)]), (2 << depth) - 1
        trees = {"feature": np.full((count, places), -1, np.int32), "right": np.zeros((count, places, bins), np.uint8),
                 "live": np.zeros((count, places), bool), "gain": np.zeros((count, places)), "stats": np.zeros((count, places, 2))}
        trees["live"][:, 0] = True
        for level in range(depth):
            nodes, first = 1 << level, (1 << level) - 1
            if not trees["live"][:, first:first + nodes].any():
                break

            here = slice(first, first + nodes)
            below = slice(2 * first + 1, 2 * first + 1 + 2 * nodes)
            counts = level_counts(blocks, level, trees, seed, salts, features, size, bins)
            for tree, feature, right, gain, own, left in level_splits(counts, level, seed, features, size, bins, categorical, least).collect():
                feature, own, left = np.frombuffer(feature, np.int32), np.frombuffer(own).reshape(nodes, 2), np.frombuffer(left).reshape(nodes, 2)
                split = feature >= 0
                trees["feature"][tree, here], trees["right"][tree, here], trees["gain"][tree, here] = feature, np.frombuffer(right, np.uint8).reshape(nodes, bins), np.frombuffer(gain)
                if level == 0:
                    trees["stats"][tree, 0] = own[0]
                trees["live"][tree, below] = np.repeat(split, 2)
                trees["stats"][tree, below] = np.where(split[:, None, None], np.stack([left, own - left], axis=1), 0).reshape(2 * nodes, 2)
            trees["live"][:, below] &= level + 1 < depth
        return trees
