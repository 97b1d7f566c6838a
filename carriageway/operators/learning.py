"""Models on tables with ``pyspark.ml``: features, training, scoring, importance."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from statistics import fmean, stdev

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carriageway.functions.rules import hash_draw
from carriageway.operators.boosting import SoftmaxBoosting
from carriageway.operators.forest_fit import BinnedForest
from carriageway.operators.ordered import running_totals, value_slice
from carriageway.operators.settle import settled
from carriageway.session import checkpoint_dir, small_splits

SEED = 42
TEST_SHARE = 0.2
#: Labelled rows a model is fitted on at most; with more, rows are drawn by a hash of their key. Scoring has no bound.
FIT_ROWS = 100_000
#: Rows of a partition while a model is fitted: a tree level is one short task per partition.
FIT_PART = 25_000
#: Rows of such a partition at most, where a model is fitted on all rows.
LARGEST_PART = 500_000
#: Bins of a feature: more than the values of any category here.
BINS = 64

# Feature columns of the three models.
SEVERITY_CATEGORIES = ["incident_type", "state_code", "road_condition", "weather_condition"]
SEVERITY_NUMBERS = ["incident_hour", "day_of_week", "vehicles_involved", "is_weekend_int"]
RISK_CATEGORIES = ["bridge_type", "material_type", "owner_type", "state_code"]
RISK_NUMBERS = [
    "bridge_age_years", "span_length_ft", "deck_width_ft", "avg_daily_traffic", "sufficiency_rating",
    "days_since_inspection",
]
WEAR_CATEGORIES = ["pavement_type", "functional_class", "state_code"]
WEAR_NUMBERS = [
    "pavement_age", "iri", "psi", "pcr", "cracking_percent", "rutting_in", "aadt", "truck_percent", "distress_index",
]


def severity_frame(incidents: DataFrame, with_score: bool = False) -> DataFrame:
    """L1. Rows without NULLs. The severity score is a copy of the target and stays out by default."""
    extra = ["severity_score"] if with_score else []
    kept = incidents.select(
        "incident_id", "severity", *SEVERITY_CATEGORIES, "incident_hour", "day_of_week", "is_weekend",
        "vehicles_involved", *extra,
    ).na.drop("any")
    return kept.withColumn("is_weekend_int", F.col("is_weekend").cast("int"))


def risk_frame(bridges: DataFrame) -> DataFrame:
    """L2. Only a missing target drops a row; other gaps are imputed."""
    return bridges.select("bridge_id", "risk_score", *RISK_CATEGORIES, *RISK_NUMBERS).na.drop(subset=["risk_score"])


def wear_frame(pavement: DataFrame) -> DataFrame:
    """L7. Label 1 for a rating of Poor or Very Poor."""
    kept = pavement.select("segment_id", "condition_rating", *WEAR_CATEGORIES, *WEAR_NUMBERS).na.drop("any")
    return kept.withColumn("label", F.col("condition_rating").isin("Poor", "Very Poor").cast("double"))


def split_by_key(df: DataFrame, key: str, test_share: float = TEST_SHARE) -> tuple[DataFrame, DataFrame]:
    """L8. Training and hold-out rows by a hash of the key: stable under any partitioning."""
    in_test = hash_draw(F.col(key), f"split-{SEED}") < test_share
    return df.where(~in_test), df.where(in_test)


def counted(df: DataFrame) -> int:
    """Rows of a table that is made unique on the way: its tasks sort their splits, so these are kept small."""
    with small_splits(df.sparkSession):
        return df.count()


def unique_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns of a table that is made unique on the way, written once for all that read them. As in ``counted``, splits are small."""
    with small_splits(df.sparkSession):
        return settled(df.select(*columns), "unique-rows")


def fit_rows(df: DataFrame, key: str, most: int = FIT_ROWS, n: int | None = None) -> DataFrame:
    """The labelled rows to fit on, written once: all of them up to ``most``, else about that many by a hash of the key.

    ``n`` is their number, where it is known.
    """
    n = counted(df) if n is None else n
    drawn = df if n <= most else df.where(hash_draw(F.col(key), f"fit-{SEED}") < most / n)
    return settled(drawn.repartition(max(1, -(-min(n, most) // FIT_PART)), key), "fit-rows")


def all_fit_rows(df: DataFrame, key: str, n: int | None = None) -> DataFrame:
    """All labelled rows, written once in partitions that grow with them: the sums of a tree level are shuffled once per partition.

    ``n`` is their number, where it is known.
    """
    n = counted(df) if n is None else n
    with small_splits(df.sparkSession):
        return settled(df.repartition(max(1, -(-n // max(FIT_PART, min(n // 64, LARGEST_PART)))), key), "fit-rows")


def encode_categories(columns: Sequence[str]) -> list[Estimator]:
    """L3. One-hot vectors; an unseen category becomes all zeros."""
    index = StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_ix" for c in columns], handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    onehot = OneHotEncoder(
        inputCols=[f"{c}_ix" for c in columns], outputCols=[f"{c}_1h" for c in columns], dropLast=True
    )
    return [index, onehot]


def scale_numbers(columns: Sequence[str], out: str = "numbers_scaled") -> list:
    """L4. Centred numbers of unit spread."""
    return [
        VectorAssembler(inputCols=list(columns), outputCol="numbers", handleInvalid="keep"),
        StandardScaler(inputCol="numbers", outputCol=out, withMean=True, withStd=True),
    ]


def impute_numbers(columns: Sequence[str]) -> Imputer:
    """L5. Missing numbers become the column median."""
    return Imputer(strategy="median", inputCols=list(columns), outputCols=[f"{c}_full" for c in columns])


def impute_median(df: DataFrame, column: str, out: str) -> DataFrame:
    """L5. Missing numbers become the exact lower median of the column.

    Values are counted first and ranked in slices; the driver sees one number.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    ranked = running_totals(counted.withColumn("_all", F.lit(0)), ["_all"], [F.col(column)], value_slice(counted, column), {"_upto": F.col("_rows")})
    half = F.ceil(ranked.agg(F.max("_upto")).scalar() / 2)
    median = ranked.where(F.col("_upto") >= half).agg(F.min(column)).scalar()
    return df.withColumn(out, F.coalesce(column, median))


def label_encoder(column: str) -> StringIndexer:
    """L6. Class number in alphabetical order."""
    return StringIndexer(inputCol=column, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="error")


def tree_stages(categories: Sequence[str], numbers: Sequence[str], impute: bool = False) -> list:
    """One ``features`` vector for trees: categories as numbered values, which trees split as sets, and numbers as they are."""
    index = StringIndexer(inputCols=list(categories), outputCols=[f"{c}_ix" for c in categories], handleInvalid="keep", stringOrderType="alphabetAsc")
    full = [f"{c}_full" for c in numbers] if impute else list(numbers)
    middle = [impute_numbers(numbers)] if impute else []
    return [index, *middle, VectorAssembler(inputCols=[*[f"{c}_ix" for c in categories], *full], outputCol="features")]


def severity_model(trees: int = 150, depth: int = 8, rate: float = 0.05, boosted: bool = True, patience: int | None = None) -> Pipeline:
    """L10. Multiclass severity: boosted trees on a shared softmax, or a forest. ``patience`` ends boosting when a held-out tenth gains no more."""
    if boosted:
        core = SoftmaxBoosting(rounds=trees, depth=depth, rate=rate, subsample=0.8, least_rows=10, bins=BINS, seed=SEED, patience=patience)
    else:
        # Each row's node is kept per tree, so that a level does not walk every tree from its root again. The forest is the same.
        core = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=10, maxBins=BINS, maxMemoryInMB=512, seed=SEED, cacheNodeIds=True)
    return Pipeline(stages=[label_encoder("severity"), *tree_stages(SEVERITY_CATEGORIES, SEVERITY_NUMBERS), core])


def risk_model(trees: int = 150, depth: int = 8, rate: float = 0.05) -> Pipeline:
    """L11. Boosted regression of the bridge risk score."""
    core = GBTRegressor(
        labelCol="risk_score", maxIter=trees, maxDepth=depth, stepSize=rate, subsamplingRate=0.8,
        minInstancesPerNode=10, maxBins=BINS, seed=SEED,
    )
    return Pipeline(stages=[*tree_stages(RISK_CATEGORIES, RISK_NUMBERS, impute=True), core])


def wear_forest(trees: int = 200, depth: int = 10) -> Pipeline:
    """L12. Random forest of pavement deterioration."""
    core = BinnedForest(key="segment_id", numTrees=trees, maxDepth=depth, minInstancesPerNode=5, maxBins=BINS, maxMemoryInMB=512, seed=SEED)
    return Pipeline(stages=[*tree_stages(WEAR_CATEGORIES, WEAR_NUMBERS), core])


def wear_boosted(trees: int = 200, depth: int = 8, rate: float = 0.1) -> Pipeline:
    """L13. Boosted trees of pavement deterioration."""
    core = GBTClassifier(
        maxIter=trees, maxDepth=depth, stepSize=rate, subsamplingRate=0.8, minInstancesPerNode=5, maxBins=BINS, seed=SEED
    )
    return Pipeline(stages=[*tree_stages(WEAR_CATEGORIES, WEAR_NUMBERS), core])


def fold_metrics(make: Callable[[], Pipeline], df: DataFrame, key: str, evaluator: Evaluator, folds: int = 5) -> DataFrame:
    """L9. The metric of each fold, with mean and sample deviation of all. A fold is a hash of the key; folds are fitted side by side."""
    fold = F.floor(hash_draw(F.col(key), f"fold-{SEED}") * folds)
    checkpoint_dir(df.sparkSession)

    def one(k: int) -> tuple[int, int, float]:
        train, test = df.where(fold != k), df.where(fold == k)
        *before, core = make().getStages()
        features = Pipeline(stages=before).fit(train)
        # Every task of a fit carries the plan of its rows, and trees are fitted in thousands of jobs. Checkpointed rows keep their partitions.
        fitted = core.fit(features.transform(train).checkpoint())
        return k, test.count(), float(evaluator.evaluate(fitted.transform(features.transform(test))))

    with ThreadPool(folds) as pool:
        rows = pool.map(inheritable_thread_target(df.sparkSession)(one), range(folds))
    values = [v for _, _, v in rows]
    return df.sparkSession.createDataFrame(
        [(evaluator.getMetricName(), k, n, v, fmean(values), stdev(values)) for k, n, v in rows],
        "metric string, fold int, n_rows long, value double, mean double, sd double")


def importances(model: PipelineModel, scored: DataFrame, top: int = 10) -> DataFrame:
    """L20. Named feature importances, largest first. Its size is the feature count."""
    attrs = scored.schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a.get("name", str(a["idx"])).removesuffix("_ix").removesuffix("_full") for group in attrs.values() for a in group}
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(names.get(i, str(i)), float(w)) for i, w in enumerate(weights)]
    frame = scored.sparkSession.createDataFrame(rows, "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature").limit(top)


def score_table(model: Model, df: DataFrame, keep: Sequence[str], out: str) -> DataFrame:
    """L21. Predictions beside the key columns."""
    return model.transform(df).select(*keep, F.col("prediction").alias(out))


def signature(frame: DataFrame, inputs: Sequence[str]) -> T.StructType:
    """L27. Names and types of all input columns of a model."""
    return T.StructType([frame.schema[c] for c in inputs])


def input_report(df: DataFrame, signature: T.StructType, table: str) -> DataFrame:
    """L27. A table held against a model's input signature: per input its type there, null if missing, and how many rows fill it."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    filled = df.agg(*[F.count(f.name).alias(f.name) for f in signature.fields if f.name in have])  # one scan for all inputs
    rows = [F.struct(F.lit(table).alias("table"), F.lit(f.name).alias("input"), F.lit(f.dataType.simpleString()).alias("expected"),
                     F.lit(have.get(f.name)).cast("string").alias("found"),
                     (F.col(f.name) if f.name in have else F.lit(0)).cast("long").alias("n_filled")) for f in signature.fields]
    return filled.select(F.inline(F.array(*rows)))
