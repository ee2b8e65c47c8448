import datetime as dt

from pyspark.sql import functions as F

from shelfcast.functions import business as B
from shelfcast.functions import dates as D
from shelfcast.operators import explore, prepare
from shelfcast.sources.canonical import merged, sales, store


def test_left_join_keeps_unknown_stores(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20)], "Store bigint, Sales bigint")
    dim = spark.createDataFrame([(1, "a")], "Store bigint, StoreType string")
    out = {r["Store"]: r["StoreType"] for r in prepare.join_store(facts, dim).collect()}
    assert out == {1: "a", 2: None}


def test_join_keeps_fact_count(spark, sf_dir):
    assert merged(spark, sf_dir).count() == sales(spark, sf_dir).count()


def test_splits_are_disjoint_and_complete(spark, sf_dir):
    rows = sales(spark, sf_dir)
    n = rows.count()
    parts = {r["split"]: r["count"] for r in prepare.with_split(rows).groupBy("split").count().collect()}
    assert sum(parts.values()) == n and 0.17 < parts["test"] / n < 0.23
    dated = prepare.date_split(rows)
    last = dated.where("split='train'").agg(F.max("Date")).first()[0]
    first = dated.where("split='test'").agg(F.min("Date")).first()[0]
    assert last < first and 0.88 < dated.where("split='train'").count() / n < 0.92


def test_sample_has_exactly_n_rows_and_repeats(spark, sf_dir):
    rows = sales(spark, sf_dir)
    one = prepare.sample_rows(rows, 137, ["Store", "Date"])
    again = prepare.sample_rows(rows.repartition(5), 137, ["Store", "Date"])
    assert one.count() == 137 and one.exceptAll(again).count() == 0
    assert prepare.sample_rows(rows, 10**7, ["Store", "Date"]).count() == rows.count()
    other = prepare.sample_rows(rows, 137, ["Store", "Date"], seed=7)
    assert one.exceptAll(other).count() > 0


def test_union_log_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "x int, z int")
    assert sorted(map(tuple, prepare.union_log(a, b).collect()), key=str) == [(1, 2, None), (3, None, 4)]


def test_first_of_each_name(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("a", "b", "a")
    out = prepare.first_of_each_name(df)
    assert out.columns == ["a", "b"] and tuple(out.first()) == (1, 2)


def test_shared_columns_keep_left_order(spark):
    left = spark.createDataFrame([(1, 2, 3)], "z int, Sales int, a int")
    right = spark.createDataFrame([(1, 2, 3)], "a int, z int, Sales int")
    assert prepare.shared_columns(left, right) == ["z", "a"]


def test_request_validation(spark):
    good = dict(store=1, DayOfWeek=5, Date="2015-07-31", open=1, Promo=1, StateHoliday="0", SchoolHoliday=1,
                StoreType="c", Assortment="a", CompetitionDistance=1270.0)
    faults = [{}, {"store": 0}, {"DayOfWeek": 8}, {"Date": "2015-02-30"}, {"Date": "31-07-2015"}, {"Date": "2012-12-31"},
              {"open": 2}, {"Promo": None}, {"StateHoliday": None}]
    from shelfcast.schemas import REQUEST_SCHEMA

    rows = [{**good, **f} for f in faults]
    df = spark.createDataFrame([tuple(r[f.name] for f in REQUEST_SCHEMA.fields) for r in rows], REQUEST_SCHEMA)
    valid, refused = prepare.quarantine(df, prepare.request_checks())
    assert valid.count() == 1
    reasons = sorted(r["reasons"][0] for r in refused.collect() if len(r["reasons"]) == 1)
    assert reasons == sorted([
        "store must be positive", "DayOfWeek must be 1 to 7", "Date must be yyyy-MM-dd", "Date must be yyyy-MM-dd",
        "Date must be between 2013 and 2026", "open must be 0 or 1", "Promo must be 0 or 1", "StateHoliday is missing",
    ])


def test_range_requests_allow_1_to_30_days(spark):
    rows = [(1, "2015-08-01", d, 1, 0) for d in (0, 1, 7, 30, 31)]
    df = spark.createDataFrame(rows, "store int, start_date string, days int, open_status int, promo_active int")
    valid, _ = prepare.quarantine(df, prepare.range_checks())
    assert sorted(r["days"] for r in valid.collect()) == [1, 7, 30]


def test_iso_weeks(spark):
    df = spark.createDataFrame([(dt.date(2012, 12, 31),), (dt.date(2016, 1, 3),)], "Date date")
    assert [r["WeekOfYear"] for r in D.with_date_parts(df).orderBy("Date").collect()] == [1, 53]


def test_competition_and_promotion_age(spark):
    df = spark.createDataFrame([
        (2015, 7, 31, 2014, 5, 2015, 10), (2015, 7, 31, 0, 0, 0, 0), (2015, 7, 31, 2016, 1, 2016, 1),
    ], "Year int, Month int, WeekOfYear int, CompetitionOpenSinceYear int, CompetitionOpenSinceMonth int, Promo2SinceYear int, Promo2SinceWeek int")
    out = df.select(B.competition_months().alias("c"), B.promo_months().alias("p")).collect()
    assert [r["c"] for r in out] == [14, 0, 0]
    assert [r["p"] for r in out] == [round(21 / 4.345, 1), 0.0, 0.0]


def test_business_columns_at_the_edges(spark):
    df = spark.createDataFrame([(100, 0, None, 1, 6), (0, 10, "0", 0, 1)],
                               "Sales bigint, Customers bigint, StateHoliday string, Promo int, DayOfWeek int")
    out = df.select((F.col("Sales") / (F.col("Customers") + B.CUSTOMER_EPSILON)).alias("s"), B.is_holiday().alias("h"),
                    B.is_weekend().alias("w")).collect()
    assert [r["h"] for r in out] == [1, 0] and [r["w"] for r in out] == [1, 0] and out[0]["s"] == 100 / 1e-5


def test_fills(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (4.0, "b"), (5.0, "a"), (None, None)], "v double, k string")
    assert prepare.fill_medians(df, ["v"]).where("v = 3.0").count() == 1
    assert prepare.fill_modes(df, ["k"]).where("k = 'a'").count() == 3


def test_correlation_edges(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0, None), (2.0, 4.0, 5.0, 1.0), (3.0, None, 5.0, None), (4.0, 9.0, 5.0, 2.0)],
        "a double, b double, constant double, sparse double",
    )
    got = {(r["a"], r["b"]): r["corr"] for r in explore.correlations(df).collect()}
    want = df.toPandas().corr()
    for (a, b), r in got.items():
        expected = want.loc[a, b]
        assert (r is None and expected != expected) or abs(r - expected) < 1e-9
    assert len(got) == 12


def test_duplicates_and_constant_histogram(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert explore.duplicate_rows(df).first()["duplicates"] == 1
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    rows = explore.histogram(flat, ["v"]).collect()
    assert len(rows) == 1 and rows[0]["rows"] == 2


def test_labels(spark, sf_dir):
    out = store(spark, sf_dir).select(B.code_to_label("StoreType", B.STORE_TYPE_LABELS).alias("l")).distinct()
    assert {r["l"] for r in out.collect()} <= set(B.STORE_TYPE_LABELS)
    assert spark.range(1).select(B.label_to_code(F.lit("Nothing"), B.HOLIDAY_LABELS)).first()[0] is None
