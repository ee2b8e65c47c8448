"""Steps that have to grow no faster than their input: what is written once, dealt out or done in tasks."""

import datetime as dt
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shelfcast.operators import features, models, retrieve
from shelfcast.plans import training
from shelfcast.plans.catalog import QUERIES
from shelfcast.session import written
from shelfcast.sources import files
from shelfcast.streaming import lags


def plan(df):
    return df._jdf.queryExecution().toString()


def test_text_files_are_written_by_tasks(spark, tmp_path):
    rows = [("store-1", "a "), ("store-1", "a "), ("store-2", None), (None, "z"), ("store-3", "\u00e9")]
    docs = spark.createDataFrame(rows, "doc_id string, page_content string")
    files.write_text_documents(docs, f"{tmp_path}/texts", files=2)
    found = {p.name: p.read_text("utf-8") for p in Path(f"{tmp_path}/texts").rglob("*.txt")}
    want = {"store-1": "a \na \n", "store-2": "\n", files.NO_ID: "z\n", "store-3": "\u00e9\n"}
    assert found == {f"doc_id={name}.txt": text for name, text in want.items()}
    assert len(list(Path(f"{tmp_path}/texts").iterdir())) <= 2  # no folder for each
    assert {r["page_content"] for r in files.read_text_documents(spark, f"{tmp_path}/texts").collect()} == set(found.values())
    files.write_text_documents(docs.limit(0), f"{tmp_path}/none")
    assert files.read_text_documents(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.parametrize("shard", [7, 1000])
def test_nearest_with_many_ties(spark, shard):
    rng = np.random.default_rng(5)
    few = rng.integers(0, 3, (6, 4)).astype(float)
    docs = [(f"d{k}", few[k % 6].tolist()) for k in range(60)]
    asked = [(k, rng.integers(0, 3, 4).astype(float).tolist()) for k in range(20)]
    got = retrieve.nearest(
        spark.createDataFrame(asked, "query_id bigint, embedding array<double>"), spark.createDataFrame(docs, "doc_id string, embedding array<double>"),
        7, doc_id="doc_id", shard=shard)
    want = {(q, rank + 1): d for q, v in asked for rank, (_, d) in enumerate(sorted(
        (round(float(np.linalg.norm(np.subtract(v, w))), 9), d) for d, w in docs)[:7])}
    assert {(r["query_id"], r["rank"]): r["doc_id"] for r in got.collect()} == want


def test_vectors_are_written_before_they_are_counted(spark, monkeypatch):
    names = []
    monkeypatch.setattr(retrieve, "written", lambda df, name: names.append(name) or df)
    docs = spark.createDataFrame([("a", "red green"), ("b", "blue")], "doc_id string, page_content string")
    got = retrieve.retrieve_context(spark.createDataFrame([(1, "blue sky")], "query_id bigint, text string"), docs)
    assert got.where("rank = 1").first()["doc_id"] == "b" and {"question-vectors", "document-vectors"} <= set(names)


def test_dense_vectors_fill_all_dimensions(spark):
    entries = [(1, 0, 0.5), (1, 3, 0.25), (1, retrieve.DIMENSIONS - 1, 1.0), (2, 7, 1.0)]
    made = retrieve.dense_vectors(spark.createDataFrame(entries, "doc_id bigint, dim int, weight double"))
    assert "map_from_entries" not in plan(made)  # a look-up for each dimension is a search through the map
    got = {r["doc_id"]: r["embedding"] for r in made.collect()}
    want = {key: [dict((d, w) for k, d, w in entries if k == key).get(d, 0.0) for d in range(retrieve.DIMENSIONS)] for key in (1, 2)}
    assert got == want


def test_learners_get_parts_by_rows(spark):
    rows = spark.range(1000).coalesce(1)
    parts = models.spread(rows, 100).rdd.glom().map(len).collect()
    assert len(parts) == 10 and sum(parts) == 1000 and max(parts) < 300
    assert models.spread(rows, 1000) is rows


def test_search_spreads_trees_and_trains_them_in_turn(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    seen = []
    monkeypatch.setattr(models, "spread", lambda df: seen.append(1) or df.repartition(3))
    rows = [(k, dt.date(2024, 1, 1), Vectors.dense([float(k % 7)]), float(k % 7)) for k in range(60)]
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("Store", T.LongType()), T.StructField("Date", T.DateType()), T.StructField("features", VectorUDT()), T.StructField("label", T.DoubleType())])
    train = spark.createDataFrame(rows, schema)
    assert max(models.search(train, "RandomForest", [{"maxDepth": 4}], 2, numTrees=3).avgMetrics) > 0.5
    assert seen == [1]


def test_categories_are_counted_over_distinct_rows(spark, monkeypatch):
    fitted = []
    indexer = features.StringIndexer
    monkeypatch.setattr(features, "StringIndexer", lambda **kw: type("Spy", (), {"fit": lambda self, df: fitted.append(df) or indexer(**kw).fit(df)})())
    rows = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "c string")
    categories, _ = features.encoders(rows, {"c": "b"})
    assert categories == {"c": ["a", "b"]} and fitted[0].count() == 2


@pytest.mark.parametrize("name", ["scaled_features", "attribution_top5", "forecast_single"])
def test_sales_are_derived_once(spark, sf_dir, name):
    assert "l_extendedprice" not in plan(QUERIES[name](spark, sf_dir))


def test_retraining_reads_its_rows_once(spark, sf_dir, monkeypatch):
    names, write = [], training.written
    monkeypatch.setattr(training, "written", lambda df, name: names.append(name) or write(df, name))
    assert QUERIES["retrain_loop"](spark, sf_dir).count() > 0 and set(names) == {"learn"}


def test_state_of_a_store_is_asked_for_once():
    class State:  # no call but these
        held = None

        def get(self):
            return self.held

        def update(self, held):
            self.held = held

    keeper = lags.NewestDays(held=31)
    keeper.days = State()
    block = pd.DataFrame({"Store": 7, "Date": [dt.date(2024, 1, d) for d in (9, 2)], "Sales": [90, 20]})
    row = list(keeper.handleInputRows((7,), iter([block]), None))[0].iloc[0]
    assert row["Date"] == dt.date(2024, 1, 9) and row["sales_lag_1"] == 20 and np.isnan(row["sales_lag_7"]) and np.isnan(row["sales_roll_mean_7"])


def test_random_search_draws_five_from_the_whole_space(spark, sf_dir, monkeypatch):
    asked = []

    def search(train, family, settings, folds=3, metric="r2", **fixed):
        asked.append((family, settings, folds, metric, fixed))
        raise StopIteration  # the fits take long

    monkeypatch.setattr(models, "search", search)
    with pytest.raises(StopIteration):
        QUERIES["random_search"](spark, sf_dir)
    family, settings, folds, metric, fixed = asked[0]
    assert (family, folds, metric, fixed) == ("GradientBoosting", 2, "mse", {}) and len(settings) == 5
    assert all(s in models.combinations_of(models.RANDOM_SPACE) for s in settings)


def test_boosting_in_a_search_has_a_folder_for_checkpoints(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(models, "with_checkpoints", lambda session: asked.append(session))
    rows = spark.range(60).selectExpr("id as Store", "date'2024-01-01' as Date", "double(id % 7) as x", "double(id % 7) as label")
    train = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    models.search(train, "GradientBoosting", [{"maxIter": 2}], 2)
    assert asked == [spark]


def test_many_queries_do_not_pass_through_the_driver(spark, monkeypatch):
    passed = []
    frame = type(spark.range(1))
    collect = frame.toPandas

    def spy(df):
        out = collect(df)
        passed.append(len(out))
        return out

    monkeypatch.setattr(frame, "toPandas", spy)
    monkeypatch.setattr(retrieve, "FEW", 11)
    docs = spark.createDataFrame([(k, [float(k), 0.0]) for k in range(60)], "vec_id bigint, embedding array<double>")
    for queries, most in ((11, 11), (50, 12)):
        asked = docs.where(f"vec_id < {queries}").withColumnRenamed("vec_id", "query_id")
        got = retrieve.nearest(asked, docs, 1, shard=100).select("query_id", "doc_id").collect()
        assert sorted(tuple(r) for r in got) == [(k, k) for k in range(queries)] and passed.pop() <= most


def vectors(spark, count, parts=1):
    rows = spark.range(0, count, 1, parts).selectExpr(
        "id % 50 as Store", "date_add(date'2024-01-01', int(id / 50)) as Date", "double(id % 7) as x", "double(hash(id) % 9) as y", "double(id % 7) + 1 as label")
    return VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(rows).select("Store", "Date", "features", "label")


def test_files_are_read_in_parts_by_rows_without_a_shuffle(spark):
    table = written(vectors(spark, 5000), "vectors", 500)
    assert len(table.inputFiles()) == 10
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with models.parts_by_rows(table, 500) as many:
        assert many and spark.conf.get("spark.sql.files.maxPartitionBytes") != before
        sizes = [n for n in table.select("*").rdd.glom().map(len).collect() if n]
        assert models.spread(table, 500) is table and max(sizes) <= 1000 and sum(sizes) == 5000
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    with models.parts_by_rows(written(vectors(spark, 5000), "vectors"), 500) as many:  # one file, which may not be cut
        assert not many
    with models.parts_by_rows(vectors(spark, 5000), 500) as many:
        assert not many
    with models.parts_by_rows(table, 5000) as many:
        assert not many and spark.conf.get("spark.sql.files.maxPartitionBytes") == before


@pytest.mark.parametrize("family, settings", [("RandomForest", [{"maxDepth": 2}, {"maxDepth": 4}]), ("LinearRegression", [{"regParam": 0.5}, {"regParam": 0.0}])])
def test_searches_hold_no_fold_in_memory(spark, monkeypatch, family, settings):
    from pyspark.ml.tuning import CrossValidator

    train = vectors(spark, 600, 2)
    fixed = {"numTrees": 3} if family == "RandomForest" else {}
    frame, cached = type(train), []
    with monkeypatch.context() as patch:
        for name in ("cache", "persist"):
            patch.setattr(frame, name, lambda self, *a: cached.append(1))
        found = models.search(train, family, settings, 2, **fixed)
    assert not cached
    validator = CrossValidator(
        estimator=models.estimator(family, **fixed), numFolds=2, foldCol="fold", evaluator=models.RegressionEvaluator(metricName="r2"))
    model = validator.getEstimator()
    validator.setEstimatorParamMaps([{model.getParam(k): v for k, v in s.items()} for s in settings])
    want = validator.fit(models.with_fold(train, 2).select("features", "label", "fold"))
    assert found.avgMetrics == pytest.approx(want.avgMetrics) and found.stdMetrics == pytest.approx(want.stdMetrics)
    assert models.search_scores(found, family)[0][2] == pytest.approx(want.avgMetrics[0])
    new = train.limit(50)
    assert [r[0] for r in found.bestModel.transform(new).select("prediction").collect()] == pytest.approx(
        [r[0] for r in want.bestModel.transform(new).select("prediction").collect()])


def test_recent_rows_hold_the_latest_of_every_store(spark):
    from shelfcast.operators import timeseries

    days = [(1, "2024-01-05", 1), (1, "2024-01-09", 2), (2, "2024-01-07", 3), (2, "2024-01-01", 4), (2, None, 5), (3, None, 6), (4, "2024-01-08", 7), (4, "2024-01-08", 8)]
    rows = spark.createDataFrame(days, "Store int, Date string, x int").withColumn("Date", F.col("Date").cast("date"))
    recent = timeseries.recent_rows(rows)
    assert {r["x"] for r in recent.collect()} == {2, 3, 5, 6, 7, 8}
    got, want = (sorted(map(tuple, timeseries.latest_per_store(df, ["x"]).collect()), key=str) for df in (recent, rows))
    assert got == want and len(want) == 4
    assert timeseries.latest_per_store(timeseries.recent_rows(rows.where("Store = 3")), ["x"]).first()["x"] == 6
