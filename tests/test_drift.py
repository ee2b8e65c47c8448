import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import drift as D
from shelfcast.plans import training


def table(spark, values, kinds):
    return spark.createDataFrame(list(zip(values, kinds)), "v double, k string")


@pytest.fixture(scope="module")
def sides(spark):
    rng = np.random.default_rng(3)
    a = table(spark, rng.normal(0, 2, 3000).round(2).tolist(), rng.choice(list("abc"), 3000).tolist())
    b = table(spark, rng.normal(1, 3, 2000).round(2).tolist(), rng.choice(list("abd"), 2000, p=[0.6, 0.3, 0.1]).tolist())
    return a, b


def test_numeric_distances_equal_brute_force(sides):
    a, b = (s.toPandas()["v"].to_numpy() for s in sides)
    points = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), points, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), points, side="right") / len(b)
    got = D.numeric_drift(*sides, ["v"]).first()
    w1 = np.sum(np.abs(fa - fb)[:-1] * np.diff(points))
    assert got["ks"] == pytest.approx(np.max(np.abs(fa - fb)))
    assert got["w1"] == pytest.approx(w1) and got["w1_norm"] == pytest.approx(w1 / a.std())


def test_categorical_distances_equal_brute_force(sides):
    a, b = (s.toPandas()["k"].value_counts() for s in sides)
    names = sorted(set(a.index) | set(b.index))
    na, nb = (np.array([s.get(n, 0) for n in names], dtype=float) for s in (a, b))
    p, q = na / na.sum(), nb / nb.sum()
    m = (p + q) / 2
    kl = lambda x: sum(x[i] * np.log(x[i] / m[i]) for i in range(len(x)) if x[i] > 0)
    got = D.categorical_drift(*sides, ["k"]).first()
    assert got["js"] == pytest.approx(np.sqrt((kl(p) + kl(q)) / 2))
    fp, fq = np.maximum(p, 1e-4), np.maximum(q, 1e-4)
    assert got["psi"] == pytest.approx(np.sum((fq - fp) * np.log(fq / fp)))
    e = p * nb.sum()
    assert got["chi2"] == pytest.approx(np.sum((nb[e > 0] - e[e > 0]) ** 2 / e[e > 0]))


def test_a_table_does_not_drift_from_itself(sides):
    summary = D.drift_summary(D.drift_report(sides[0], sides[0], ["v"], ["k"])).first()
    assert summary.asDict() == {"status": "success", "drift_share": 0.0, "drifted_columns_count": 0, "requires_retraining": False}


def test_constant_columns_do_not_drift(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    got = D.numeric_drift(df, df, ["v"]).first()
    assert got["ks"] == 0.0 and got["w1"] == 0.0 and got["w1_norm"] == 0.0


def test_empty_log_is_skipped(sides):
    empty = sides[0].where("false")
    assert D.drift_summary(D.drift_report(sides[0], empty, ["v"], ["k"])).first()["status"] == "skipped"


def test_period_report_equals_separate_reports(spark, sides):
    a, b = sides
    both = a.withColumn("p", F.lit(1)).unionByName(b.withColumn("p", F.lit(2)))
    got = {(r["p"], r["column"]): r["score"] for r in D.drift_report(a, both, ["v"], ["k"], period="p").collect()}
    alone = {r["column"]: r["score"] for r in D.drift_report(a, b, ["v"], ["k"]).collect()}
    assert got[(1, "v")] == 0.0 and got[(1, "k")] == 0.0
    assert got[(2, "v")] == pytest.approx(alone["v"]) and got[(2, "k")] == pytest.approx(alone["k"])


def test_perturbation_is_bounded_and_repeatable(spark):
    df = spark.range(500).select(F.col("id").alias("Store"), F.lit(100.0).alias("CompetitionDistance"))
    out = D.perturb(df)
    low, high = out.agg(F.min("CompetitionDistance"), F.max("CompetitionDistance")).first()
    assert 110.0 <= low < 112 and 148 < high < 150.0
    assert out.exceptAll(D.perturb(df.repartition(3))).count() == 0


def test_retraining_follows_the_threshold(spark, sides, tmp_path):
    calls = []
    assert training.monitor(*sides, ["v"], ["k"], str(tmp_path), lambda: calls.append(1))
    assert not training.monitor(sides[0], sides[0], ["v"], ["k"], str(tmp_path), lambda: calls.append(2))
    assert calls == [1]
    assert spark.read.parquet(f"{tmp_path}/drift_results").count() == 2


def test_levels(spark):
    df = spark.createDataFrame([(0.1,), (0.3,), (0.5,)], "drift_share double")
    assert [r["level"] for r in D.with_level(df).collect()] == ["ok", "warning", "critical"]
