import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.operators import quantiles as Q

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 1.0]


def picked(df, columns=("v",)):
    row = Q.quantiles(df, list(columns), PROBABILITIES).collect()
    return {r["column"]: [r[Q.quantile_name(p)] for p in PROBABILITIES] for r in row}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50), st.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_small_lists(spark, values):
    known = [float(v) for v in values if v is not None]
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    if not known:
        assert picked(df) == {}
        return
    assert picked(df)["v"] == pytest.approx(np.quantile(known, PROBABILITIES), rel=1e-12, abs=1e-9)


def test_more_rows_than_the_sketch_resolves(spark):
    df = spark.range(200_000).select(
        (F.xxhash64("id") % 1_000_003).cast("double").alias("spread"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") * 0.5).alias("hot"),
        F.lit(5).alias("constant"),
    )
    data = df.toPandas()
    got = picked(df, ["spread", "hot", "constant"])
    for column in got:
        assert got[column] == pytest.approx(np.quantile(data[column], PROBABILITIES), rel=1e-12)


def test_median_of_even_count_is_the_middle(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (5.0,)], "v double")
    assert Q.quantiles(df, ["v"], [0.5]).first()["q50"] == 3.0


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "v string")
    assert Q.modes(df, ["v"]).first()["value"] == "a"
    numbers = spark.createDataFrame([(10,), (9,), (10,), (9,)], "v int")
    assert Q.modes(numbers, ["v"]).first()["value"] == "9"


def test_running_counts(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("g"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.xxhash64("id") % 5000).cast("double").alias("value"),
    ).groupBy("g", "value").agg(F.count("*").alias("n"))
    got = Q.running_counts(df, ["g"], ["n"]).toPandas()
    for _, part in got.groupby("g"):
        part = part.sort_values("value")
        assert (part["seen_n"].to_numpy() == part["n"].cumsum().to_numpy()).all()
        assert (part["all_n"] == part["n"].sum()).all()
        assert (part["next_value"].to_numpy()[:-1] == part["value"].to_numpy()[1:]).all()
        assert np.isnan(part["next_value"].to_numpy()[-1])


def test_ordered_bits_follow_every_double(spark):
    rng = np.random.default_rng(5)
    some = [0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, np.nextafter(1.0, 0), np.nextafter(2.0, 0), 2.0, 1.7976931348623157e308, float("inf")]
    values = np.concatenate([some, 2.0 ** np.arange(-1074, 1024), rng.integers(0, 2047 << 52, 3000).view(np.float64)])
    values = np.concatenate([values, np.nextafter(values[(values > 0) & (values < np.inf)], 0), -values])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = Q.with_ordered_bits(df, "v", "b").toPandas()
    want = np.abs(got["v"].to_numpy()).view(np.int64) * np.where(got["v"] < 0, -1, 1)
    assert (got["b"].to_numpy() == want).all()
    assert Q.with_ordered_bits(df.limit(1).select(F.lit(float("nan")).alias("v")), "v", "b").first()["b"] == 2 ** 63 - 1


def test_values_that_mislead_a_sketch(spark):
    """Half of the rows one value, the rest spread over all sizes of doubles."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 2 == 0, 1.0).otherwise(F.pow(F.lit(2.0), F.pmod(F.xxhash64("id"), F.lit(2000)) - 1000)).alias("v"),
        F.when(F.col("id") % 997 == 0, float("-inf")).otherwise(-F.pow(F.lit(1.0001), F.col("id") % 50000)).alias("w"))
    data = df.toPandas()
    for column, values in picked(df, ["v", "w"]).items():
        ranked = np.sort(data[column].to_numpy())
        places = np.array(PROBABILITIES) * (len(ranked) - 1)
        low, high = ranked[np.floor(places).astype(int)], ranked[np.ceil(places).astype(int)]
        want = [a if a == b else a + (b - a) * (p - np.floor(p)) for a, b, p in zip(low, high, places)]
        assert values == pytest.approx(want, rel=1e-12)


def test_running_counts_over_more_than_256_pieces(spark):
    df = spark.range(9_000).select(
        F.when(F.col("id") % 4 == 0, "x").otherwise("y").alias("g"), (F.xxhash64("id") % 4001).cast("double").alias("value"),
    ).groupBy("g", "value").agg(F.count("*").alias("n"), F.sum(F.lit(2)).alias("m"))
    got = Q.running_counts(df, ["g"], ["n", "m"], piece_rows=20).toPandas()
    assert len(got) > 256 * 20
    for _, part in got.groupby("g"):
        part = part.sort_values("value")
        assert (part["seen_n"].to_numpy() == part["n"].cumsum().to_numpy()).all() and (2 * part["seen_n"] == part["seen_m"]).all()
        assert (part["all_n"] == part["n"].sum()).all()
        assert (part["next_value"].to_numpy()[:-1] == part["value"].to_numpy()[1:]).all()
