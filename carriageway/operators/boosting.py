"""Boosting of several classes: one regression tree per class and round on the residuals of a shared softmax.

``pyspark.ml`` boosts two classes only. Here each round turns the margins of all
classes into probabilities, fits one ``DecisionTreeRegressor`` per class (the
classes of a round side by side) and adds its scaled output to the margins. A
tree's target is the residual over p (1 - p), weighted by it, so a leaf's mean is
a Newton step of the log loss. Rows stay on executors; margins are written to
the shared folder every few rounds, which also cuts the lineage.
"""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carriageway.operators.settle import settled

#: Rounds between two written tables of margins.
SETTLE_EVERY = 10
#: Share of the rows that watch the loss where boosting may end early.
HELD_OUT = 0.1
#: Least weight of a row in a tree: bounds the step of leaves whose rows are all but settled.
LEAST_WEIGHT = 0.05


def shares(margins: Column, classes: int) -> list[Column]:
    """Softmax of an array of margins."""
    top = F.array_max(margins)
    powers = [F.exp(margins[k] - top) for k in range(classes)]
    return [p / sum(powers[1:], powers[0]) for p in powers]


class SoftmaxBoosting(Estimator):
    """``label`` holds class numbers from 0. ``losses`` of the model is the log loss before and after each round.

    With ``patience``, a tenth of the rows is held out of the trees; ``losses``
    are theirs, boosting ends when so many rounds in a row have not lowered the
    least one, and the rounds up to that one stay. ``rounds`` is then the most.
    """

    def __init__(self, rounds: int = 150, depth: int = 8, rate: float = 0.05, subsample: float = 0.8, least_rows: int = 10,
                 bins: int = 64, seed: int = 42, patience: int | None = None, features: str = "features", label: str = "label"):
        super().__init__()
        self.patience = patience
        self.rounds, self.depth, self.rate, self.subsample = rounds, depth, rate, subsample
        self.least_rows, self.bins, self.seed, self.features, self.label = least_rows, bins, seed, features, label

    def _tree(self, frame: DataFrame, k: int, turn: int, classes: int):
        p = shares(F.col("_margins"), classes)[k]
        weight = F.greatest(p * (1 - p), F.lit(LEAST_WEIGHT))
        step = ((F.col(self.label) == k).cast("double") - p) / weight
        rows = frame.where(~F.col("_held")).select(self.features, weight.alias("_weight"), step.alias("_step"))
        return DecisionTreeRegressor(
            featuresCol=self.features, labelCol="_step", weightCol="_weight", predictionCol=f"_tree_{k}", maxDepth=self.depth,
            minInstancesPerNode=self.least_rows, maxBins=self.bins, seed=self.seed,
        ).fit(rows.sample(self.subsample, self.seed + turn) if self.subsample < 1 else rows)

    def _fit(self, df: DataFrame) -> SoftmaxModel:
        counts = {int(r[0]): r[1] for r in df.groupBy(self.label).count().collect()}  # a row per class
        classes, total = max(counts) + 1, sum(counts.values())
        priors = [math.log(max(counts.get(k, 0), 0.5) / total) for k in range(classes)]
        held = F.rand(self.seed) < HELD_OUT if self.patience else F.lit(False)
        frame = settled(df.select(self.features, self.label, held.alias("_held"), F.array(*map(F.lit, priors)).alias("_margins")), "boosting-rows")
        hit = F.coalesce(*[F.when(F.col(self.label) == k, p) for k, p in enumerate(shares(F.col("_margins"), classes))])
        watched = F.col("_held") if self.patience else F.lit(True)

        def loss_of(df: DataFrame) -> float:
            return df.where(watched).agg(F.avg(-F.log(hit))).first()[0]

        losses, rounds, last = [loss_of(frame)], [], None
        with ThreadPool(classes) as pool:
            for turn in range(self.rounds):
                def one(k: int, frame=frame, turn=turn):
                    return self._tree(frame, k, turn, classes)

                trees = pool.map(inheritable_thread_target(df.sparkSession)(one), range(classes))
                rounds.append(trees)
                moved = frame
                for tree in trees:
                    moved = tree.transform(moved)
                margins = F.array(*[F.col("_margins")[k] + self.rate * F.col(f"_tree_{k}") for k in range(classes)])
                moved = moved.select(self.features, self.label, "_held", margins.alias("_margins"))
                if (turn + 1) % SETTLE_EVERY == 0:
                    moved = settled(moved, "boosting-margins")
                moved.persist()
                losses.append(loss_of(moved))
                if last is not None:
                    last.unpersist()
                frame = last = moved
                best = losses.index(min(losses))
                if self.patience and len(losses) - 1 - best >= self.patience:
                    rounds = rounds[:max(best, 1)]
                    break
        last.unpersist()
        sums = [summed([r[k] for r in rounds], self.rate) for k in range(classes)]
        return SoftmaxModel(sums, priors, losses, self.features)


def summed(trees: list, rate: float) -> GBTRegressionModel:
    """The trees of one class as one additive model, which scores all of them in one function."""
    java = [t._java_obj for t in trees]
    gateway = SparkContext._active_spark_context._gateway
    spark_ml = gateway.jvm.org.apache.spark.ml.regression
    array, weights = gateway.new_array(spark_ml.DecisionTreeRegressionModel, len(java)), gateway.new_array(gateway.jvm.double, len(java))
    for n, tree in enumerate(java):
        array[n], weights[n] = tree, rate
    return GBTRegressionModel(spark_ml.GBTRegressionModel(java[0].uid().replace("dtr", "gbtr"), array, weights))


class SoftmaxModel(Model):
    """Adds ``probability``, an array over the classes, and ``prediction``, the first class of the highest one."""

    def __init__(self, sums: list[GBTRegressionModel], priors: list[float], losses: list[float], features: str):
        super().__init__()
        self.sums, self.priors, self.losses, self.features = sums, priors, losses, features

    def _transform(self, df: DataFrame) -> DataFrame:
        names, out = df.columns, df
        for k, model in enumerate(self.sums):
            out = model.setFeaturesCol(self.features).setPredictionCol(f"_sum_{k}").transform(out)
        out = out.withColumn("_margins", F.array(*[F.lit(p) + F.col(f"_sum_{k}") for k, p in enumerate(self.priors)]))
        p = F.array(*shares(F.col("_margins"), len(self.sums)))
        return out.withColumn("probability", p).select(
            *names, "probability", (F.array_position("probability", F.array_max("probability")) - 1).cast("double").alias("prediction"))
