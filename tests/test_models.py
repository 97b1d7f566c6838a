"""Models on fixtures with a known rule: losses, held-out accuracy, importances, folds, bounded fitting rows."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from carriageway.operators import learning
from carriageway.operators.boosting import SoftmaxBoosting

KINDS = ["bend", "bridge", "plain", "tunnel"]


@pytest.fixture(scope="module")
def ruled(spark):
    """Three classes by a category and a number, nine of ten rows as the rule says; ``noise`` says nothing."""
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        kind, x, noise = rng.choice(KINDS), rng.random(), rng.random()
        rule = "high" if kind in ("bend", "tunnel") and x > 0.5 else "mid" if kind == "plain" else "low"
        rows.append((f"r{i}", kind, x, noise, rule if rng.random() < 0.9 else rng.choice(["high", "low", "mid"])))
    df = spark.createDataFrame(rows, "id string, kind string, x double, noise double, class string").repartition(3).cache()
    df.count()
    return df


def staged(core):
    return Pipeline(stages=[learning.label_encoder("class"), *learning.tree_stages(["kind"], ["x", "noise"]), core])


def test_softmax_boosting_learns_the_rule(ruled):
    train, test = learning.split_by_key(ruled, "id")
    fitted = staged(SoftmaxBoosting(rounds=12, depth=3, rate=0.3)).fit(train)
    losses = fitted.stages[-1].losses
    assert len(losses) == 13 and all(b < a for a, b in zip(losses, losses[1:6])) and losses[-1] < losses[0] / 3
    out = fitted.transform(test).cache()
    assert out.where(F.abs(F.aggregate("probability", F.lit(0.0), lambda a, p: a + p) - 1) > 1e-9).count() == 0
    hit = out.agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    majority = max(r["count"] for r in test.groupBy("class").count().collect()) / test.count()
    assert hit > 0.85 > majority + 0.2
    # The reported loss is that of the model's own probabilities.
    own = fitted.transform(train).agg(F.avg(-F.log(F.get("probability", F.col("label").cast("int"))))).first()[0]
    assert abs(own - losses[-1]) < 1e-9


def test_boosting_ends_when_held_out_rows_gain_nothing(ruled):
    noise = ruled.withColumn("class", F.element_at(F.array(F.lit("a"), F.lit("b")), (F.rand(3) * 2).cast("int") + 1))
    model = staged(SoftmaxBoosting(rounds=60, depth=3, rate=0.5, patience=3)).fit(noise).stages[-1]
    best = model.losses.index(min(model.losses))
    assert len(model.losses) == best + 4 < 61
    assert len(model.sums[0].trees) == max(best, 1)


def test_one_softmax_is_shared_by_the_classes(ruled):
    """A round without subsampling is one Newton tree per class from the priors."""
    model = staged(SoftmaxBoosting(rounds=1, depth=2, rate=1.0, subsample=1.0)).fit(ruled)
    frame = model.transform(ruled)
    priors = [F.lit(p) for p in model.stages[-1].priors]
    total = sum((F.exp(p) for p in priors[1:]), F.exp(priors[0]))
    p = F.exp(priors[0]) / total
    data = frame.select("features", (((F.col("label") == 0).cast("double") - p) / (p * (1 - p))).alias("z"), F.col("probability"))
    tree = DecisionTreeRegressor(labelCol="z", maxDepth=2, minInstancesPerNode=10, maxBins=64, seed=42).fit(data)
    assert tree.toDebugString.count("If") == model.stages[-1].sums[0].trees[0].toDebugString.count("If") > 0


def test_planted_feature_leads_the_importances(ruled):
    forest = learning.wear_forest(trees=10, depth=5).getStages()[-1]
    fitted = staged(forest).fit(ruled)
    top = learning.importances(fitted, fitted.transform(ruled)).collect()
    assert [r["feature"] for r in top] == ["kind", "x", "noise"] and sum(r["importance"] for r in top) == pytest.approx(1)


def test_an_unseen_category_is_scored(spark, ruled):
    fitted = staged(learning.wear_forest(trees=5, depth=4).getStages()[-1]).fit(ruled)
    new = spark.createDataFrame([("n", "harbour", 0.9, 0.1, "low")], ruled.schema)
    assert fitted.transform(new).first()["prediction"] in (0.0, 1.0, 2.0)


def test_every_fold_is_reported(ruled):
    rows = ruled.withColumn("y", F.when(F.col("kind") == "plain", 2.0).otherwise(0.0) + F.col("x"))

    def model():
        return Pipeline(stages=[*learning.tree_stages(["kind"], ["x"]), DecisionTreeRegressor(labelCol="y", maxDepth=5)])

    got = learning.fold_metrics(model, rows, "id", RegressionEvaluator(labelCol="y", metricName="r2"), folds=4).collect()
    assert sorted(r["fold"] for r in got) == [0, 1, 2, 3] and sum(r["n_rows"] for r in got) == 1500
    values = [r["value"] for r in got]
    assert min(values) > 0.9 and {round(r["mean"], 9) for r in got} == {round(sum(values) / 4, 9)} and got[0]["sd"] > 0
    forest = learning.fold_metrics(lambda: staged(learning.wear_forest(trees=5, depth=5).getStages()[-1]), ruled, "id",
                                   MulticlassClassificationEvaluator(metricName="accuracy"), folds=2)
    assert forest.agg(F.min("value")).first()[0] > 0.8


def test_fitting_rows_are_bounded_and_stable(spark):
    df = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    assert learning.fit_rows(df, "key", most=5000).count() == 4000
    some = {r[0] for r in learning.fit_rows(df, "key", most=1000).collect()}
    assert 850 < len(some) < 1150 and some == {r[0] for r in learning.fit_rows(df.repartition(7), "key", most=1000).collect()}


def test_wear_forest_is_fitted_on_all_rows(spark, monkeypatch):
    """More rows than other models are fitted on, and all of them reach the forest."""
    from carriageway.registry import QUERIES, model_queries

    seen = []

    class Counted:
        def fit(self, rows):
            seen.append(rows.select("segment_id").distinct().count())
            return learning.Pipeline(stages=[*learning.tree_stages(["kind"], ["x"]), learning.RandomForestClassifier(numTrees=2, maxDepth=2)]).fit(rows)

    n = learning.FIT_ROWS + 20_000
    train = spark.range(n).selectExpr("concat('s', id) AS segment_id", "if(id % 3 = 0, 'a', 'b') AS kind", "id % 7 / 1.0D AS x", "cast(id % 2 AS double) AS label")
    monkeypatch.setattr(model_queries, "wear_split", lambda i: (train, train.limit(5)))
    monkeypatch.setattr(learning, "wear_forest", Counted)
    assert QUERIES["l12_wear_forest"](spark, "unused").count() == 5
    assert seen == [n]


def wear_table(spark, n: int):
    """Pavement rows whose rating follows from their number."""
    numbers = {c: (F.hash(F.col("id"), F.lit(k)) % 50).cast("double") for k, c in enumerate(learning.WEAR_NUMBERS)}
    return spark.range(n).withColumns({"segment_id": F.concat(F.lit("s"), "id"), "condition_rating": F.when(F.col("id") % 3 == 0, "Poor").otherwise("Good"),
                                       **{c: F.concat(F.lit("c"), F.col("id") % 4) for c in learning.WEAR_CATEGORIES}, **numbers})


@pytest.mark.parametrize("name", ["l20_feature_importance", "u05_model_as_function"])
def test_the_shared_wear_forest_is_fitted_on_all_rows(spark, monkeypatch, name):
    """More rows than other models are fitted on, and all of them reach the forest (F4, F5)."""
    from carriageway.registry import QUERIES, core

    seen, forest = [], learning.wear_forest

    class Counted:
        def fit(self, rows):
            seen.append(rows.select("segment_id").distinct().count())
            return forest(2, 2).fit(rows)

    n = learning.FIT_ROWS + 20_000
    monkeypatch.setattr(core, "pin_utc", lambda s: s)
    monkeypatch.setattr(core.Inputs, "pavement", wear_table(spark, n))
    monkeypatch.setattr(learning, "wear_forest", Counted)
    got = QUERIES[name](spark, f"unused-{name}").count()
    assert seen == [n] and got == (n if name.startswith("u05") else 10)


@pytest.mark.parametrize("name, split, key", [("l09_cross_validation", "risk_split", "bridge_id"), ("l09_severity_folds", "severity_split", "incident_id")])
def test_folds_take_all_rows(spark, monkeypatch, name, split, key):
    """More rows than other models are fitted on, and all of them are dealt to the folds (F2, F3)."""
    from carriageway.registry import QUERIES, model_queries

    n = learning.FIT_ROWS + 20_000
    train = spark.range(n).select(F.concat(F.lit("k"), "id").alias(key), (F.col("id") % 7 / 1.0).alias("x"), (F.col("id") % 7 / 2.0).alias("y"))
    folds = learning.fold_metrics
    monkeypatch.setattr(model_queries, split, lambda i: (train, None))
    monkeypatch.setattr(learning, "fold_metrics", lambda make, rows, key, evaluator: folds(
        lambda: Pipeline(stages=[*learning.tree_stages([], ["x"]), DecisionTreeRegressor(labelCol="y", maxDepth=3)]), rows, key, RegressionEvaluator(labelCol="y", metricName="r2")))
    got = QUERIES[name](spark, "unused").collect()
    assert len(got) == 5 and sum(r["n_rows"] for r in got) == n and min(r["value"] for r in got) > 0.9


def test_published_sizes_are_the_defaults():
    assert (learning.severity_model().getStages()[-1].rounds, learning.severity_model().getStages()[-1].depth) == (150, 8)
    sizes = [(m.getStages()[-1].getMaxIter(), m.getStages()[-1].getMaxDepth()) for m in (learning.risk_model(), learning.wear_boosted())]
    assert sizes == [(150, 8), (200, 8)]


def test_signature_report_finds_what_is_missing(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    want = spark.createDataFrame([], "a int, b int, c double").schema
    got = sorted(map(tuple, learning.input_report(df, want, "t").collect()))
    assert got == [("t", "a", "int", "int", 2), ("t", "b", "int", "string", 1), ("t", "c", "double", None, 0)]


def test_a_table_is_made_unique_in_small_splits(spark, tmp_path, monkeypatch):
    """What a task sorts stays the same however large the file is, and the session's own splits are kept (F8)."""
    from carriageway import session
    from carriageway.operators.keys import one_row_per_key

    monkeypatch.setattr(learning, "small_splits", lambda s: session.small_splits(s, 50_000))
    spark.range(300_000).select(F.concat(F.lit("k"), F.col("id") % 200_000).alias("key"), (F.col("id") % 7).alias("v")).coalesce(1).write.option("parquet.block.size", 50_000).parquet(f"{tmp_path}/t")
    before, seen = spark.conf.get("spark.sql.files.maxPartitionBytes"), []
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")

    class Watched:
        sparkSession = spark

        def count(self):
            table = spark.read.parquet(f"{tmp_path}/t")
            seen.append(table.select(F.spark_partition_id().alias("p")).distinct().count())
            return one_row_per_key(table, ["key"]).count()

    try:
        assert learning.counted(Watched()) == 200_000
        rows = learning.unique_rows(one_row_per_key(spark.read.parquet(f"{tmp_path}/t"), ["key"]), ["key"])
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert seen[0] > 8 and rows.columns == ["key"] and rows.count() == rows.distinct().count() == 200_000
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_a_forest_scored_in_batches_votes_as_its_own_transform(spark, ruled):
    """Bit for bit, with categories, an unseen one, cut points and values on them (F9)."""
    from pyspark.ml.functions import vector_to_array

    from carriageway.operators.forest import score_forest

    fitted = staged(learning.wear_forest(trees=20, depth=7).getStages()[-1]).fit(ruled)
    cut = float(next(line for line in fitted.stages[-1].toDebugString.split("\n") if "If (feature 1 <=" in line).split("<= ")[1].rstrip(")"))
    odd = spark.createDataFrame([("n", "harbour", 0.9, 0.1, "low"), ("c", "bend", cut, cut, "high"), ("i", "plain", float("inf"), -0.0, "mid")], ruled.schema)
    rows = ruled.unionByName(odd)
    own = {r[0]: (r[1], list(r[2])) for r in fitted.transform(rows).select("id", "prediction", vector_to_array("probability")).collect()}
    got = {r[0]: (r[1], list(r[2])) for r in score_forest(fitted, rows).select("id", "prediction", "probability").collect()}
    assert len(own) == 1503 and got == own


def test_model_as_function_makes_rows_unique_once(spark, monkeypatch):
    """The rows that are counted are the rows that are scored (F9)."""
    from carriageway.registry import QUERIES, core

    seen, counted = [], []
    n, numbers = 400, {c: (F.hash(F.col("id"), F.lit(k)) % 50).cast("double") for k, c in enumerate(learning.WEAR_NUMBERS)}
    raw = spark.range(n).withColumns({"segment_id": F.concat(F.lit("s"), "id"), "condition_rating": F.when(F.col("id") % 3 == 0, "Poor").otherwise("Good"),
                                      **{c: F.concat(F.lit("c"), F.col("id") % 4) for c in learning.WEAR_CATEGORIES}, **numbers})
    raw = raw.withColumn("iri", F.when(F.col("id") != 5, F.col("iri")))
    monkeypatch.setattr(core, "pin_utc", lambda s: s)
    monkeypatch.setattr(core.Inputs, "pavement", raw)
    unique, counting, forest = learning.unique_rows, learning.counted, learning.wear_forest
    monkeypatch.setattr(learning, "unique_rows", lambda *a: seen.append(1) or unique(*a))
    monkeypatch.setattr(learning, "counted", lambda df: counted.append(1) or counting(df))
    monkeypatch.setattr(learning, "wear_forest", lambda: forest(5, 4))
    got = QUERIES["u05_model_as_function"](spark, "unused-pavement").collect()
    assert (len(seen), len(counted)) == (1, 0) and len(got) == n - 1 and got[0].__fields__ == ["segment_id", "predicted", "score"]


def test_a_fold_is_fitted_on_checkpointed_rows(ruled):
    """The fit's tasks carry no plan of the features; rows, partitions and metrics are those of the whole pipeline's fit (F10)."""
    seen = []

    class Watched(DecisionTreeRegressor):
        def _fit(self, rows):
            seen.append((rows._jdf.queryExecution().logical().nodeName(), rows.rdd.getNumPartitions()))
            return super()._fit(rows)

    rows, evaluator = ruled.withColumn("y", F.when(F.col("kind") == "plain", 2.0).otherwise(0.0) + F.col("x")), RegressionEvaluator(labelCol="y", metricName="r2")

    def model(core=DecisionTreeRegressor):
        return Pipeline(stages=[*learning.tree_stages(["kind"], ["x", "noise"], impute=True), core(labelCol="y", maxDepth=3)])

    got = {r["fold"]: r["value"] for r in learning.fold_metrics(lambda: model(Watched), rows, "id", evaluator, folds=2).collect()}
    fold = F.floor(learning.hash_draw(F.col("id"), f"fold-{learning.SEED}") * 2)
    assert got == {k: evaluator.evaluate(model().fit(rows.where(fold != k)).transform(rows.where(fold == k))) for k in (0, 1)}
    assert len(seen) == 2 and set(seen) == {("LogicalRDD", 3)}


def test_severity_forest_keeps_the_rows_nodes(ruled):
    """A level starts from the nodes of the one before; the forest is the one grown from the roots (F11)."""
    forest = learning.severity_model(boosted=False, trees=12, depth=6).getStages()[-1]
    assert forest.getCacheNodeIds()
    grown = [staged(core).fit(ruled).stages[-1].toDebugString.split("\n")[1:] for core in (forest, forest.copy({forest.cacheNodeIds: False}))]
    assert grown[0] == grown[1] and len(grown[0]) > 100


@pytest.fixture(scope="module")
def two(ruled):
    """The rule's first class against the others."""
    return ruled.withColumn("class", F.when(F.col("class") == "high", "yes").otherwise("no")).withColumnRenamed("id", "segment_id").cache()


def test_a_wear_forest_does_not_depend_on_partitions(two):
    """Draws follow the rows' keys, wherever they lie (F1)."""
    core = learning.wear_forest(trees=8, depth=5).getStages()[-1]
    grown = [staged(core).fit(df).stages[-1].toDebugString.split("\n")[1:] for df in (two, two.repartition(7, "x"), two.orderBy("noise"))]
    assert grown[0] == grown[1] == grown[2] and len(grown[0]) > 50


def test_a_wear_forest_is_what_its_rules_say(spark, two, monkeypatch, tmp_path):
    """Every node holds the drawn rows that reach it, and the roots' splits are the best of all cuts of their features (F1)."""
    import numpy as np

    from carriageway.operators import forest_fit

    monkeypatch.setattr(forest_fit, "BLOCK", 100)  # many blocks
    trees, bins = 6, learning.BINS
    fitted = staged(learning.wear_forest(trees=trees, depth=6).getStages()[-1]).fit(two)
    frame = fitted.transform(two).select("features", "label", F.xxhash64("segment_id").alias("h")).collect()
    x, label = np.array([r["features"].toArray() for r in frame]), np.array([r["label"] for r in frame])
    hashes = np.array([r["h"] & 0xFFFFFFFF for r in frame], np.uint32)
    salts = np.random.default_rng(learning.SEED).integers(0, 2**32, trees, dtype=np.uint32)
    fitted.stages[-1].write().save(f"{tmp_path}/m")
    saved = {}
    for r in spark.read.parquet(f"{tmp_path}/m/data").collect():
        saved.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    assert len(saved) == trees and sum(map(len, saved.values())) > 10 * trees

    def stats(rows, w):
        return [float(w[rows & (label == k)].sum()) for k in (0, 1)]

    def impurity(s):
        return 1 - sum((v / sum(s)) ** 2 for v in s) if sum(s) else 0

    for tree, nodes in saved.items():
        w = forest_fit.draws(hashes, salts[tree], forest_fit.poisson_table()).astype(float)
        assert 0.9 < w.mean() < 1.1 and 0.32 < (w == 0).mean() < 0.42
        todo = [(0, np.ones(len(x), bool))]
        while todo:
            at, rows = todo.pop()
            node = nodes[at]
            assert node["impurityStats"] == stats(rows, w) and node["rawCount"] == w[rows].sum()
            if node["leftChild"] >= 0:
                f, values, kinds = node["split"]
                left = np.isin(x[:, f], values) if kinds >= 0 else x[:, f] <= values[0]
                assert min(w[rows & left].sum(), w[rows & ~left].sum()) >= 5
                todo += [(node["leftChild"], rows & left), (node["rightChild"], rows & ~left)]
        every = np.ones(len(x), bool)
        here = impurity(stats(every, w))
        best = 0
        for f in forest_fit.subset(learning.SEED, tree, 0, 3, 2)[0]:
            values = np.unique(x[:, f])
            if f == 0:
                tests = [np.isin(x[:, 0], values[[bool(m >> k & 1) for k in range(len(values))]]) for m in range(1, 2 ** len(values) - 1)]
            else:
                tests = [x[:, f] <= v for v in np.sort(x[:, f])[[round(k * len(x) / bins) for k in range(1, bins)]]]
            for left in tests:
                a, b = stats(left, w), stats(~left, w)
                best = max(best, here - (sum(a) * impurity(a) + sum(b) * impurity(b)) / (sum(a) + sum(b)))
        assert nodes[0]["gain"] == pytest.approx(best, rel=0.03)


def test_a_wear_forest_learns_what_the_library_s_own_learns(two):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import vector_to_array

    train, test = learning.split_by_key(two, "segment_id")
    rules = {"numTrees": 40, "maxDepth": 6, "minInstancesPerNode": 5, "maxBins": learning.BINS, "seed": learning.SEED}
    grown = [staged(core).fit(train) for core in (learning.wear_forest(trees=40, depth=6).getStages()[-1], RandomForestClassifier(**rules))]
    assert {p.name: v for p, v in grown[0].stages[-1].extractParamMap().items() if p.name != "maxMemoryInMB"} == {p.name: v for p, v in grown[1].stages[-1].extractParamMap().items() if p.name != "maxMemoryInMB"}
    scored = [m.transform(test).select("segment_id", "label", "prediction", vector_to_array("probability")[1].alias(f"score_{k}")) for k, m in enumerate(grown)]
    hits = [s.agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0] for s in scored]
    assert min(hits) > 0.85 and abs(hits[0] - hits[1]) < 0.03
    assert scored[0].join(scored[1].select("segment_id", "score_1"), "segment_id").agg(F.corr("score_0", "score_1")).first()[0] > 0.97
    weights = [m.stages[-1].featureImportances.toArray() for m in grown]
    assert max(abs(weights[0] - weights[1])) < 0.1


def test_wear_forest_scores_every_held_out_row(spark, monkeypatch):
    """The rows and labels that the query's SQL named while it had one: whole rows of the held-out fifth (F6)."""
    from hashlib import md5

    from carriageway.registry import QUERIES, core

    n = 3000
    raw = wear_table(spark, n).withColumn("pcr", F.when(F.col("id") % 50 != 7, F.col("pcr")))
    monkeypatch.setattr(core, "pin_utc", lambda s: s)
    monkeypatch.setattr(core.Inputs, "pavement", raw)
    forest, seen, fitting = learning.wear_forest, [], learning.all_fit_rows
    monkeypatch.setattr(learning, "wear_forest", lambda: forest(5, 4))
    monkeypatch.setattr(learning, "all_fit_rows", lambda df, *a: seen.append({r[0] for r in df.select("segment_id").collect()}) or fitting(df, *a))
    got = QUERIES["l12_wear_forest"](spark, "unused").collect()
    whole = [k for k in range(n) if k % 50 != 7]
    held = {f"s{k}": float(k % 3 == 0) for k in whole if int(md5(f"s{k}|split-{learning.SEED}".encode()).hexdigest()[:7], 16) / 16**7 < 0.2}
    assert {r["segment_id"]: r["label"] for r in got} == held and len(got) == len(held)
    assert seen == [{f"s{k}" for k in whole} - held.keys()]
    assert got[0].__fields__ == ["segment_id", "label", "predicted", "score"] and {r["predicted"] for r in got} <= {0.0, 1.0}
