"""Evaluation metrics of predictions, each a small aggregate over scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carriageway.functions.rules import ratio
from carriageway.operators.measures import share_where
from carriageway.operators.ordered import running_totals
from carriageway.operators.settle import settled


# Slices of a score in [0, 1]: only slice totals are ordered in one task.
SCORE_SLICES = 65536


def accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.agg(share_where(F.col(label) == F.col(predicted)).alias("accuracy"))


def class_scores(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Support, precision, recall and F1 per class, from the confusion counts."""
    cells = df.groupBy(F.col(label).alias("l"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(
        F.inline(F.array(
            F.struct(F.col("l").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("guessed"),
                     F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(F.lit(0)).alias("hit")),
            F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("guessed"),
                     F.lit(0).cast("long").alias("hit")),
        ))
    )
    per_class = sides.groupBy("class").agg(
        F.sum("actual").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hits")
    )
    return per_class.select(
        "class", "support",
        F.coalesce(ratio("hits", "guessed"), F.lit(0.0)).alias("precision"),
        F.coalesce(ratio("hits", "support"), F.lit(0.0)).alias("recall"),
        F.coalesce(ratio(F.col("hits") * 2, F.col("support") + F.col("guessed")), F.lit(0.0)).alias("f1"),
    )


def weighted_f1(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return class_scores(df, label, predicted).agg(
        ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1")
    )


def binary_f1(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """F1 of class 1."""
    hit = F.count_if((F.col(label) == 1) & (F.col(predicted) == 1))
    either = F.count_if(F.col(label) == 1) + F.count_if(F.col(predicted) == 1)
    return df.agg(F.coalesce(ratio(hit * 2, either), F.lit(0.0)).alias("f1"))


def regression_errors(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """RMSE, MAE and R squared in one aggregate."""
    error = F.col(label) - F.col(predicted)
    return df.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop(label) * F.count(label))).alias("r2"),
    )


def score_steps(df: DataFrame, label: str, score: str, slice_by: Column | None = None) -> DataFrame:
    """Per distinct score, from the highest down: positives and negatives here and above."""
    steps = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    steps = settled(steps, "score-steps")
    cut = slice_by if slice_by is not None else F.floor(F.col("score") * SCORE_SLICES)
    return running_totals(
        steps, [], [F.col("score").desc()], cut,
        {"pos_so_far": F.col("pos"), "neg_so_far": F.col("neg")}, descending=True,
    )


def roc_auc(df: DataFrame, label: str, score: str, slice_by: Column | None = None) -> DataFrame:
    """Area under the ROC curve; equal scores count half."""
    steps = score_steps(df, label, score, slice_by)
    won = F.col("neg") * (F.col("pos_so_far") - F.col("pos") + F.col("pos") / 2)
    return steps.agg(ratio(F.sum(won), F.sum("pos").cast("double") * F.sum("neg")).alias("auc_roc"))


def average_precision(df: DataFrame, label: str, score: str, slice_by: Column | None = None) -> DataFrame:
    """Step-wise sum of recall gains times precision."""
    steps = score_steps(df, label, score, slice_by)
    gain = F.col("pos") * ratio("pos_so_far", F.col("pos_so_far") + F.col("neg_so_far"))
    return steps.agg(ratio(F.sum(gain), F.sum("pos")).alias("auc_pr"))


def regression_summary(df: DataFrame, predicted: str, high: float = 70.0) -> DataFrame:
    """Scored rows, mean, maximum and share at or above ``high``."""
    return df.agg(
        F.count(F.lit(1)).alias("records_scored"),
        F.avg(predicted).alias("mean_predicted"),
        F.max(predicted).alias("max_predicted"),
        share_where(F.col(predicted) >= high).alias("pct_high"),
    )


def class_summary(df: DataFrame, predicted: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("records_scored"),
        F.countDistinct(predicted).alias("unique_classes_predicted"),
    )
