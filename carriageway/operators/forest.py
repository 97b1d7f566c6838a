"""Forest classifiers scored a batch of rows at a time.

``pyspark.ml`` walks all trees of a forest for one row before the next, so the nodes of a large forest
are read from main memory again for each row. Here a tree is walked by a whole batch, level by level, on the
nodes as ``pyspark.ml`` saves them. Votes are summed in the order of the trees, so they are the same to the last bit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carriageway.session import shared_dir


def saved_nodes(model: RandomForestClassificationModel, spark) -> tuple[dict, list]:
    """All nodes by tree and number, as arrays; and the cut points of each feature. Their size is the model's."""
    path = shared_dir(spark, "forest")
    model.write().save(path)
    parts = ["id", "leftChild", "rightChild", "split.featureIndex", "split.numCategories", "split.leftCategoriesOrThreshold", "impurityStats"]
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/data").select("treeID", *[f"nodeData.{x}" for x in parts]).orderBy("treeID", "id").collect()]
    n, first, points, width = len(rows), {}, [set() for _ in range(model.numFeatures)], 1
    for at, (tree, _, _, _, f, categories, values, _) in enumerate(rows):
        first.setdefault(tree, at)
        if f >= 0 and categories < 0:
            points[f].add(values[0])
        width = max(width, categories)
    cuts = [np.array(sorted(p)) for p in points]
    width = max(width, *[len(c) + 1 for c in cuts])
    whole = np.int32 if n * width < 2**31 else np.int64
    feature, left, child = np.zeros(n, whole), np.zeros((n, width), np.int8), np.repeat(np.arange(n, dtype=whole), 2)  # a leaf leads to itself
    share, depth = np.zeros((n, model.numClasses)), np.zeros(n, whole)
    for at, (tree, _, to_left, to_right, f, categories, values, stats) in enumerate(rows):
        total = sum(stats)
        if total:
            share[at] = [x / total for x in stats]
        if f >= 0:
            a, b = first[tree] + to_left, first[tree] + to_right
            codes = list(map(int, values)) if categories >= 0 else slice(int(np.searchsorted(cuts[f], values[0])) + 1)
            feature[at], left[at, codes], child[2 * at], child[2 * at + 1] = f, 1, b, a
            depth[a] = depth[b] = depth[at] + 1  # parents are numbered before their children
    roots = sorted(first.values())
    levels = [int(depth[a:b].max()) for a, b in zip(roots, [*roots[1:], n])]
    return {"feature": feature, "left": left, "child": child, "share": share.T.copy(), "trees": list(zip(roots, levels))}, cuts


def forest_votes(model: RandomForestClassificationModel, features: Column, spark) -> Column:
    """``rawPrediction`` of a forest as an array: per class the sum of the trees' shares."""
    nodes, cuts = saved_nodes(model, spark)

    feature, left, child, shares, width = *(nodes[x] for x in ("feature", "left", "child", "share")), nodes["left"].shape[1]

    @F.arrow_udf("array<double>")
    def votes(vectors: pa.Array) -> pa.Array:
        n, whole = len(vectors), child.dtype.type
        values = vectors.flatten().to_numpy().reshape(n, len(cuts))
        # A code per value: how many cut points lie below it, or the category's number.
        codes = np.concatenate([np.searchsorted(c, values[:, f]) if len(c) else values[:, f] for f, c in enumerate(cuts)]).astype(whole)
        column, row, out = feature * whole(n), np.arange(n, dtype=whole), np.zeros((len(shares), n))
        for root, levels in nodes["trees"]:
            at = np.full(n, root, whole)
            for _ in range(levels):  # every place is one of the table: without "wrap" each one is checked
                code = codes.take(column.take(at, mode="wrap") + row, mode="wrap")
                at = child.take(2 * at + left.take(at * whole(width) + code, mode="wrap"), mode="wrap")
            for k, share in enumerate(shares):
                out[k] += share.take(at)
        return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * len(out), out.T.ravel())

    return votes(vector_to_array(features))


def score_forest(model: PipelineModel, df: DataFrame) -> DataFrame:
    """As ``transform`` of a pipeline that ends in a forest classifier; ``probability`` is an array."""
    forest = model.stages[-1]
    for stage in model.stages[:-1]:
        df = stage.transform(df)
    voted = df.withColumn("_votes", forest_votes(forest, F.col(forest.getFeaturesCol()), df.sparkSession))
    total = F.aggregate("_votes", F.lit(0.0), lambda a, v: a + v)
    return voted.withColumns({
        "probability": F.transform("_votes", lambda v: v / total),
        "prediction": (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double"),
    }).drop("_votes")
