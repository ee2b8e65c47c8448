import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.operators import timeseries as TS


def by_day(df, store=1):
    return df.where(F.col("Store") == store).orderBy("Date").toPandas()


def test_rolling_needs_a_full_frame(series):
    out = TS.with_production_lags(series({6: [(i, 10 * i) for i in range(6)], 7: [(i, 10 * i) for i in range(7)]}))
    assert by_day(out, 6)["sales_roll_mean_7"].isna().all()
    seven = by_day(out, 7)["sales_roll_mean_7"]
    assert seven.notna().sum() == 1 and seven.iloc[-1] == 30.0


def test_lags_count_rows_not_days(series):
    out = by_day(TS.with_production_lags(series({1: [(i * 3, i) for i in range(31)]})))
    assert out["sales_lag_1"].iloc[5] == 4
    assert out["sales_lag_30"].notna().sum() == 1 and out["sales_lag_30"].iloc[30] == 0


def test_null_inside_the_frame_empties_it(series):
    df = series({1: [(i, None if i == 3 else i) for i in range(12)]})
    out = by_day(TS.with_production_lags(df))
    assert list(out["sales_roll_mean_7"].notna()) == [False] * 10 + [True] * 2


def test_log_lags_equal_pandas(series):
    rng = np.random.default_rng(1)
    df = series({s: [(int(d), int(v)) for d, v in zip(range(50), rng.integers(0, 9000, 50))] for s in (1, 2)})
    got = by_day(TS.with_log_lags(df))
    logs = pd.Series(np.log1p(got["Sales"].to_numpy(dtype=float)))
    assert np.allclose(got["rolling_std_7"].to_numpy(dtype=float), logs.rolling(7).std().to_numpy(), equal_nan=True)
    assert np.allclose(got["rolling_mean_3"].to_numpy(dtype=float), logs.rolling(3).mean().to_numpy(), equal_nan=True)
    assert np.allclose(got["lag_14"].to_numpy(dtype=float), logs.shift(14).to_numpy(), equal_nan=True)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(1, 3), st.sets(st.integers(0, 2500), min_size=1, max_size=80), min_size=1), st.integers(5, 400))
def test_slices_equal_whole_series(spark, stores, width):
    start = dt.date(2012, 1, 1)
    rows = [(s, start + dt.timedelta(days=d), d * 7 % 101) for s, days in stores.items() for d in days]
    df = spark.createDataFrame(rows, "Store bigint, Date date, Sales bigint")
    whole = TS.with_production_lags(df)
    piece = F.floor(F.datediff("Date", F.lit(start)) / width)
    cut = TS.over_slices(df, lambda d, by: TS.with_production_lags(d, by), 30, piece=piece)
    assert cut.count() == whole.count() == len(rows)
    assert cut.exceptAll(whole.select(cut.columns)).count() == 0


def test_latest_and_lookup(spark, series):
    df = TS.with_production_lags(series({1: [(i, i) for i in range(40)], 2: [(0, 5)]}))
    latest = TS.latest_per_store(df)
    got = {r["Store"]: r for r in latest.collect()}
    assert got[1]["sales_lag_1"] == 38 and got[1]["sales_lag_30"] == 9 and got[2]["sales_lag_1"] is None
    asked = TS.with_latest_lags(spark.createDataFrame([(1,), (99,)], "Store bigint"), latest)
    out = {r["Store"]: r for r in asked.collect()}
    assert out[1]["has_history"] and out[1]["sales_lag_1"] == 38.0
    assert not out[99]["has_history"] and out[99]["sales_roll_mean_7"] == 0.0


def test_exclude_current(series):
    out = by_day(TS.with_production_lags(series({1: [(i, i) for i in range(9)]}), exclude_current=True))
    assert out["sales_roll_mean_7"].iloc[7] == pytest.approx(3.0) and out["sales_roll_mean_7"].notna().sum() == 2


def test_feature_table_drops_rows_of_stores_without_promotion(spark, sf_dir):
    from shelfcast.operators.prepare import with_split
    from shelfcast.sources.canonical import merged

    rows = with_split(merged(spark, sf_dir))
    strict = TS.feature_table(rows)
    assert strict.where("Promo2 = 0").count() == 0
    assert TS.feature_table(rows, subset=["sales_lag_30"]).where("Promo2 = 0").count() > 0
