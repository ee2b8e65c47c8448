import uuid

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shelfcast.operators import features, metrics, models, trees
from shelfcast.plans import training
from shelfcast.session import shared_folder
from shelfcast.sources import results


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(
        [(1.0, 5, "a"), (2.0, 5, "b"), (4.0, 5, "b"), (5.0, 5, None), (None, 5, "it's")], "x double, flat int, kind string"
    )


def test_fit_matches_the_definitions(small):
    fitted = features.fit(small, ["x", "flat"], ["kind"])
    assert fitted.medians == {"x": 3.0, "flat": 5.0}
    filled = np.array([1, 2, 4, 5, 3], dtype=float)
    assert fitted.means["x"] == pytest.approx(filled.mean()) and fitted.deviations["x"] == pytest.approx(filled.std())
    assert fitted.modes == {"kind": "b"} and fitted.categories == {"kind": ["a", "b", "it's"]}
    assert fitted.feature_names == ["scaled_x", "scaled_flat", "kind_a", "kind_b", "kind_it's"]
    out = fitted.model.transform(small).toPandas()
    assert out["scaled_x"].mean() == pytest.approx(0) and out["scaled_x"].std(ddof=0) == pytest.approx(1)
    assert (out["scaled_flat"] == 0).all()
    assert list(out["features"].iloc[3].toArray()[2:]) == [0.0, 1.0, 0.0]


def test_unseen_category_is_all_zero(spark, small):
    fitted = features.fit(small, ["x"], ["kind"])
    new = spark.createDataFrame([(2.0, "zebra")], "x double, kind string")
    assert list(fitted.model.transform(new).first()["features"].toArray()[1:]) == [0.0, 0.0, 0.0]
    assert features.shared_categories(fitted, features.fit(small.where("kind = 'a'"), ["x"], ["kind"])) == {"kind": ["a"]}


def test_column_without_values_is_refused(small):
    with pytest.raises(ValueError, match="no known value"):
        features.fit(small.where("x is null"), ["x"], [])


def test_saved_scorer_scores_alike(spark, small, tmp_path):
    fitted = features.fit(small, ["x"], ["kind"])
    learner = models.estimator("LinearRegression").fit(fitted.model.transform(small.withColumn("label", F.lit(1.0) + F.coalesce("x", F.lit(0.0)))))
    scorer = models.full_scorer(fitted.model, learner)
    results.save_fitted(scorer, f"{tmp_path}/m")
    again = results.load_fitted(f"{tmp_path}/m")
    assert [r["prediction"] for r in again.transform(small).collect()] == [r["prediction"] for r in scorer.transform(small).collect()]


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    y, p = np.array([1, 2, 4.0]), np.array([1.5, 2, 3.0])
    assert row["rmse"] == pytest.approx(np.sqrt(((y - p) ** 2).mean())) and row["mae"] == pytest.approx(0.5)
    assert row["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    assert metrics.regression_metrics(flat, "y", "p").first()["r2"] is None


def test_gates(spark):
    scores = spark.createDataFrame([("a", 0.74), ("b", 0.75), ("c", 0.80), ("d", 0.81)], "model string, r2 double")
    stages = {r["model"]: r["stage"] for r in metrics.promotion(scores).collect()}
    assert stages == {"a": "None", "b": "Staging", "c": "Staging", "d": "Production"}
    best = metrics.best_model(scores).first()
    assert best["model"] == "d" and best["accepted"]
    assert not metrics.best_model(scores, 0.9).first()["accepted"]


def test_verdicts(spark):
    rows = [("under", "train", 1.0, 0.8), ("under", "test", 1.0, 0.8), ("over", "train", 1.0, 0.9), ("over", "test", 1.3, 0.7),
            ("fine", "train", 1.0, 0.9), ("fine", "test", 1.1, 0.88)]
    df = spark.createDataFrame(rows, "model string, split string, rmse double, r2 double")
    got = {r["model"]: (r["verdict"], round(r["gap_percent"], 6)) for r in metrics.generalisation(df).collect()}
    assert got == {"under": ("underfitting", 0.0), "over": ("overfitting", 30.0), "fine": ("balanced", 10.0)}


def test_draws_are_seeded_and_distinct():
    a = models.drawn_from(models.RANDOM_SPACE, 5)
    assert a == models.drawn_from(models.RANDOM_SPACE, 5) and len({tuple(sorted(d.items())) for d in a}) == 5
    assert len(models.combinations_of(models.GRIDS["RandomForest"])) == 9


def test_early_stopping_uses_the_validation_rows(spark):
    df = spark.range(400).select((F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 20 % 3).cast("double").alias("label"), F.col("id"))
    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    noise = rows.withColumn("label", F.rand(1))
    model = models.fit_with_early_stop(rows, noise, maxIter=20, maxDepth=2)
    assert model.getNumTrees < 20


def test_blend(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert models.blend(df, {"a": 0.6, "b": 0.4}).first()["prediction"] == pytest.approx(1.4)


def test_training_job(spark, sf_dir, tmp_path):
    from shelfcast.operators.retrieve import rule_documents
    from shelfcast.sources.canonical import merged, store, table

    folder = str(tmp_path)
    rules = rule_documents(table(spark, sf_dir, "benchmark"), "item_id", "text")
    arguments = (spark, merged(spark, sf_dir), store(spark, sf_dir), rules, folder)
    with pytest.raises(training.ValidationFailed):
        training.run(*arguments)  # sales above 50000
    trained = training.run(*arguments, grids={"LinearRegression": {"regParam": [0.0]}}, folds=2, subset=["sales_lag_30"], check=False)
    assert trained.family == "LinearRegression"
    for name in ("validation_results", "model_runs", "model_metrics", "model_versions", "document_vectors"):
        assert spark.read.parquet(f"{folder}/{name}").count() > 0
    assert spark.read.parquet(f"{folder}/model_versions").first()["stage"] == "Production"
    rows = spark.read.parquet(f"{folder}/features")
    assert results.load_fitted(f"{folder}/model").transform(rows).where("prediction is null").count() == 0
    with pytest.raises(training.ModelRejected):
        training.train(rows.withColumn("label", F.rand(3)), f"{folder}/bad", {"LinearRegression": {"regParam": [0.0]}}, 2)


@pytest.mark.parametrize("family, settings", [("RandomForest", {"numTrees": 5, "maxDepth": 7}), ("GradientBoosting", {"maxIter": 4, "maxDepth": 3})])
def test_tree_contributions_add_up_to_the_prediction(spark, family, settings):
    rows = spark.range(600).select(
        "id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"), (F.xxhash64("id") % 100).cast("double").alias("c"),
        F.lit(1.0).alias("never"))
    rows = rows.withColumn(models.LABEL, F.col("a") * F.col("b") + F.sqrt(F.abs("c")))
    names = ["a", "b", "c", "never"]
    ready = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    model = models.estimator(family, **settings).fit(ready)
    found = trees.tree_attribution(ready, model, names, ["id"])
    sums = found.groupBy("id").agg(F.first("prediction").alias("p"), (F.first("base") + F.sum("contribution")).alias("s")).collect()
    assert len(sums) == 600 and all(r["p"] == pytest.approx(r["s"], abs=1e-9) for r in sums)
    assert found.where("feature = 'never'").count() == 0
    assert model.transform(ready).select("id", "prediction").exceptAll(found.select("id", "prediction").distinct()).count() == 0
    nodes = {(r["tree"], r["node"]): r for r in trees.node_table(spark, model).collect()}  # one row by hand
    thresholds = {(r["treeID"], r["nodeData"]["id"]): r["nodeData"]["split"]["leftCategoriesOrThreshold"]
                  for r in spark.read.parquet(_saved(spark, model)).collect()}
    values, want = ready.where("id = 7").first()["features"].toArray(), {}
    for tree in {t for t, _ in nodes}:
        at = nodes[tree, 0]
        while at["leaf"] is None:
            below = nodes[tree, at["left"] if values[at["feature"]] <= thresholds[tree, at["node"]][0] else at["right"]]
            want[names[at["feature"]]] = want.get(names[at["feature"]], 0.0) + below["value"] - at["value"]
            at = below
    assert {r["feature"]: r["contribution"] for r in found.where("id = 7").collect()} == pytest.approx(want)
    assert [r["place"] for r in trees.largest(found, ["id"], 2).where("id = 7").orderBy("place").collect()] == [1, 2]


def _saved(spark, model):
    path = f"{shared_folder(spark)}/models/test-{uuid.uuid4().hex}"
    model.write().save(path)
    return f"{path}/data"


def test_saved_models_score_alike(spark, tmp_path):
    rows = spark.range(200).select("id", (F.col("id") % 7).cast("double").alias("a"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("k"))
    rows = rows.withColumn(models.LABEL, F.col("a") * 2 + F.when(F.col("k") == "x", 1).otherwise(0))
    fitted = features.fit(rows, ["a"], ["k"])
    scorer = models.full_scorer(fitted.model, models.estimator("LinearRegression").fit(fitted.model.transform(rows)))
    results.save_fitted(scorer, f"{tmp_path}/m")
    a, b = (m.transform(rows).select("id", "prediction").orderBy("id").collect() for m in (scorer, results.load_fitted(f"{tmp_path}/m")))
    assert a == b and a[3]["prediction"] == pytest.approx(7.0, abs=1e-6)
