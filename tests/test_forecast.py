import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import baseline, features, forecast, models

START = dt.date(2015, 8, 1)


@pytest.fixture(scope="module")
def requests(spark):
    return spark.createDataFrame([(1, START, 100.0, 0), (2, START, 0.0, 1)], "Store bigint, start_date date, sales_lag_1 double, Promo int")


def score(lag, date):
    return 2.0 + 0.001 * lag + 0.01 * F.dayofmonth(date) + 0.1 * F.col("Promo")


def by_hand(lag, promo, days):
    out = []
    for i in range(days):
        lag = math.expm1(2.0 + 0.001 * lag + 0.01 * (START + dt.timedelta(days=i)).day + 0.1 * promo)
        out.append(lag)
    return out


@pytest.mark.parametrize("days", [1, 7, 30])
def test_recursion_equals_a_loop(requests, days):
    rows = forecast.recursive_linear(requests, days, score).orderBy("Store", "Date").collect()
    got = {s: [r["prediction"] for r in rows if r["Store"] == s] for s in (1, 2)}
    assert got[1] == pytest.approx(by_hand(100.0, 0, days)) and got[2] == pytest.approx(by_hand(0.0, 1, days))
    assert rows[days - 1]["Date"] == START + dt.timedelta(days=days - 1)


@pytest.mark.parametrize("days", [0, 31])
def test_horizon_limits(requests, days):
    with pytest.raises(ValueError):
        forecast.recursive_linear(requests, days, score)


def test_equal_scenarios_have_no_uplift(requests):
    cases = forecast.scenarios(requests)
    flat = lambda lag, date: F.lit(3.0) + 0.0 * lag
    days = forecast.compare_days(forecast.recursive_linear(cases, 7, flat))
    assert {(r["uplift"], r["uplift_percent"]) for r in forecast.uplift(days).collect()} == {(0.0, 0.0)}


def test_uplift_of_a_zero_base_is_zero_percent(spark):
    df = spark.createDataFrame([(1, START, 0.0, 5.0)], "Store int, Date date, base double, promo double")
    row = forecast.uplift(df).first()
    assert row["uplift"] == 5.0 and row["uplift_percent"] == 0.0


def test_range_result(requests):
    path = forecast.recursive_linear(requests, 3, score)
    row = forecast.range_result(path).where("store_id = 1").first()
    want = by_hand(100.0, 0, 3)
    assert [d["prediction"] for d in row["daily_forecasts"]] == [round(v, 2) for v in want]
    assert [d["date"] for d in row["daily_forecasts"]] == ["2015-08-01", "2015-08-02", "2015-08-03"]
    assert row["total_estimated_sales"] == round(sum(want), 2) and row["end_date"] == dt.date(2015, 8, 3)


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(5)
    rows = [(float(l), int(d), float(np.log1p(50 + 0.4 * l + 3 * d))) for l, d in zip(rng.integers(0, 500, 300), rng.integers(1, 8, 300))]
    df = spark.createDataFrame(rows, "sales_lag_1 double, DayOfWeek int, label double")
    prep = features.fit(df, ["sales_lag_1", "DayOfWeek"], [])
    return prep, models.estimator("LinearRegression").fit(prep.model.transform(df))


def test_model_recursion_equals_a_loop_across_lineage_cuts(spark, fitted):
    prep, model = fitted
    scorer = models.full_scorer(prep.model, model)
    asked = spark.createDataFrame([(7, START, 120.0)], "Store bigint, start_date date, sales_lag_1 double")
    got = [r["prediction"] for r in forecast.recursive_model(asked, 23, scorer).orderBy("Date").collect()]
    lag, want = 120.0, []
    w = model.coefficients.toArray()
    for i in range(23):
        z = [(lag - prep.means["sales_lag_1"]) / prep.deviations["sales_lag_1"],
             ((START + dt.timedelta(days=i)).isoweekday() - prep.means["DayOfWeek"]) / prep.deviations["DayOfWeek"]]
        lag = math.expm1(model.intercept + float(np.dot(w, z)))
        want.append(lag)
    assert got == pytest.approx(want)


def test_horizon_one_equals_a_single_forecast(spark, fitted):
    prep, model = fitted
    scorer = models.full_scorer(prep.model, model)
    asked = spark.createDataFrame([(7, START, 120.0)], "Store bigint, start_date date, sales_lag_1 double")
    path = forecast.recursive_model(asked, 1, scorer).first()["prediction"]
    single = spark.createDataFrame([(7, 6, "2015-08-01", 1)], "store bigint, DayOfWeek int, Date string, open int")
    latest = spark.createDataFrame([(7, 120.0, 0.0, 0.0, 0.0)], "Store bigint, sales_lag_1 double, sales_lag_7 double, sales_lag_30 double, sales_roll_mean_7 double")
    row = forecast.forecast(single, latest, scorer).first()
    assert row["prediction"] == round(path, 2) and row["has_history"] and row["Open"] == 1


def test_attribution_is_largest_first(spark):
    df = spark.createDataFrame([(1.0, -4.0, 2.0, 0.5, 0.0, 3.0)], "a double, b double, c double, d double, e double, f double")
    weights = {"a": 1.0, "b": 1.0, "c": -1.0, "d": 2.0, "e": 9.0, "f": 0.1}
    rows = forecast.attribution(df, weights, {"e": 1.0}).first()["explanation"]
    assert [(r["feature"], round(r["contribution"], 6)) for r in rows] == [("e", -9.0), ("b", -4.0), ("c", -2.0), ("a", 1.0), ("d", 1.0)]


def test_closed_form_fit_equals_least_squares(spark):
    rng = np.random.default_rng(2)
    x1, x2 = rng.integers(0, 1000, 500).astype(float), rng.integers(0, 2, 500)
    y = 1.5 + 0.003 * x1 + 0.2 * x2 + rng.normal(0, 0.1, 500)
    df = spark.createDataFrame([(float(a), int(b), float(c)) for a, b, c in zip(x1, x2, y)], "sales_lag_1 double, Promo int, label double")
    row = baseline.fit(df).first()
    want = np.linalg.lstsq(np.column_stack([np.ones(500), x1, x2]), y, rcond=None)[0]
    assert [row["intercept"], row["lag_weight"], row["promo_weight"]] == pytest.approx(want.tolist())


def test_all_lags_move_with_the_predictions(spark, series):
    """The fold equals a loop over a list, also past the thirtieth value and for short histories."""
    history = {1: [(d, 100 + 7 * d) for d in range(45)], 2: [(0, 40), (5, 60)]}
    rings = forecast.newest_sales(series(history)).withColumn("start_date", F.date_add("last_date", 1))
    weights = {"sales_lag_1": 0.001, "sales_lag_7": 0.0005, "sales_lag_30": 0.0002, "sales_roll_mean_7": 0.0003}
    path = forecast.recursive_lags(
        rings, 30, lambda lags, date: sum((lags[c] * w for c, w in weights.items()), F.dayofmonth(date) * 0.01) + 3)
    got = {}
    for r in path.orderBy("Store", "Date").collect():
        got.setdefault(r["Store"], []).append((r["Date"], r["prediction"]))
    for store, days in history.items():
        known = [0.0] * (30 - len(days)) + [float(s) for _, s in days]
        for date, prediction in got[store]:
            lags = {"sales_lag_1": known[-1], "sales_lag_7": known[-7], "sales_lag_30": known[-30], "sales_roll_mean_7": sum(known[-7:]) / 7}
            want = np.expm1(sum(lags[c] * w for c, w in weights.items()) + date.day * 0.01 + 3)
            assert prediction == pytest.approx(want)
            known.append(prediction)
        assert len(got[store]) == 30
