"""Lags, rolling statistics, feature tables and fitted preprocessing."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions.business import competition_months, promo_months
from shelfcast.functions.dates import with_date_parts
from shelfcast.operators import features as fit_features
from shelfcast.operators import prepare, timeseries
from shelfcast.plans.registry import SPLIT_SQL, day_text, query, rounded, sql
from shelfcast.schemas import CATEGORICAL_FEATURES, LAG_COLUMNS, LOG_FEATURES, NUMERIC_FEATURES, PRUNED_FEATURES
from shelfcast.session import written
from shelfcast.sources.canonical import merged, sales

_LAGS_SQL = """select *, lag(Sales,1) over w as sales_lag_1, lag(Sales,7) over w as sales_lag_7, lag(Sales,30) over w as sales_lag_30,
 case when count(Sales) over r7 = 7 then avg(Sales) over r7 end as sales_roll_mean_7
 from {source} window w as (partition by {by} order by Date), r7 as (partition by {by} order by Date rows 6 preceding)"""
_LAG_OUTPUT = "select Store, cast(Date as varchar) as Date, sales_lag_1, sales_lag_7, sales_lag_30, round(sales_roll_mean_7,6) as sales_roll_mean_7 from lagged"


def _lag_output(df):
    return rounded(df.select("Store", day_text().alias("Date"), *LAG_COLUMNS), "sales_roll_mean_7")


@query(sql(_LAG_OUTPUT, lagged=_LAGS_SQL.format(source="sales", by="Store")))
def lag_features(spark, sf_dir):
    return _lag_output(timeseries.with_production_lags(sales(spark, sf_dir)))


@query(sql(_LAG_OUTPUT, lagged=_LAGS_SQL.format(source="sales", by="Store")))
def lag_features_sliced(spark, sf_dir):
    """The same lags with each series cut into years that run as separate tasks."""
    cut = timeseries.over_slices(
        sales(spark, sf_dir).select("Store", "Date", "Sales"),
        lambda df, by: timeseries.with_production_lags(df, by), depth=30,
    )
    return _lag_output(cut)


@query(sql("select Store, cast(Date as varchar) as Date, round(case when count(*) over w = 7 then avg(Sales) over w end,6) as sales_roll_mean_7 from sales window w as (partition by Store order by Date rows between 7 preceding and 1 preceding)"))
def rolling_before(spark, sf_dir):
    """Rolling mean of the seven rows before the current one."""
    out = timeseries.with_production_lags(sales(spark, sf_dir), lags=(), exclude_current=True)
    return rounded(out.select("Store", day_text().alias("Date"), "sales_roll_mean_7"), "sales_roll_mean_7")


_LOG_SQL = """select *, lag(LogSales,1) over w as lag_1, lag(LogSales,2) over w as lag_2, lag(LogSales,3) over w as lag_3, lag(LogSales,7) over w as lag_7,
 lag(LogSales,14) over w as lag_14, lag(LogSales,30) over w as lag_30,
 case when count(*) over r3 = 3 then avg(LogSales) over r3 end as rolling_mean_3, case when count(*) over r7 = 7 then avg(LogSales) over r7 end as rolling_mean_7,
 case when count(*) over r7 = 7 then stddev_samp(LogSales) over r7 end as rolling_std_7
 from (select *, ln(1+Sales::double) as LogSales from merged where Open = 1)
 window w as (partition by Store order by Date), r3 as (partition by Store order by Date rows 2 preceding), r7 as (partition by Store order by Date rows 6 preceding)"""
_LOG_COLUMNS = ["lag_1", "lag_2", "lag_3", "lag_7", "lag_14", "lag_30", "rolling_mean_3", "rolling_mean_7", "rolling_std_7"]


@query(sql("select Store, cast(Date as varchar) as Date, " + ", ".join(f"round({c},6) as {c}" for c in _LOG_COLUMNS) + " from logged", logged=_LOG_SQL))
def rolling_features(spark, sf_dir):
    out = timeseries.with_log_lags(merged(spark, sf_dir))
    return rounded(out.select("Store", day_text().alias("Date"), *_LOG_COLUMNS), *_LOG_COLUMNS)


_LOG_FEATURES_SQL = """select * from (select Store, cast(Date as varchar) as Date, DayOfWeek, Promo, StateHoliday, SchoolHoliday, StoreType, Assortment, CompetitionDistance,
 cast(case when coalesce(CompetitionOpenSinceYear,0)=0 then 0 else greatest(0, (year(Date)-CompetitionOpenSinceYear)*12 + month(Date)-CompetitionOpenSinceMonth) end as int) as CompetitionOpenMonths,
 Promo2, cast(case when coalesce(Promo2SinceYear,0)=0 then 0 else greatest(0.0, round((year(Date)-Promo2SinceYear)*12 + (week(Date)-Promo2SinceWeek)/4.345::double, 1)) end as double) as Promo2OpenMonths,
 cast(year(Date) as int) as Year, cast(month(Date) as int) as Month, cast(day(Date) as int) as Day, cast(week(Date) as int) as WeekOfYear, """ + ", ".join(
    f"round({c},6) as {c}" for c in _LOG_COLUMNS) + """ from logged)
 where lag_30 is not null and CompetitionDistance is not null"""


@query(sql(_LOG_FEATURES_SQL, logged=_LOG_SQL))
def feature_table_log(spark, sf_dir):
    """The 24 features on log sales of open days; the last year is for testing."""
    whole = ["CompetitionOpenSinceMonth", "CompetitionOpenSinceYear", "Promo2SinceWeek", "Promo2SinceYear"]
    filled = prepare.fill_constants(merged(spark, sf_dir), {**{c: 0 for c in whole}, "PromoInterval": "No Promo"})
    dated = with_date_parts(timeseries.with_log_lags(filled)).withColumns(
        {"CompetitionOpenMonths": competition_months(), "Promo2OpenMonths": promo_months()}
    )
    kept = prepare.year_split(prepare.drop_null_rows(dated)).withColumn("Date", day_text())
    return rounded(kept.select(*LOG_FEATURES[:1], "Date", *LOG_FEATURES[1:]), *_LOG_COLUMNS)


@query(sql(f"select * exclude (lag_30, lag_14, Month) from ({_LOG_FEATURES_SQL})", logged=_LOG_SQL))
def pruned_features(spark, sf_dir):
    """The same without the features that were pruned."""
    return feature_table_log(spark, sf_dir).drop(*PRUNED_FEATURES)


@query(sql("select Store, cast(Date as varchar) as Date, sales_lag_1, sales_lag_7, sales_lag_30, round(sales_roll_mean_7,6) as sales_roll_mean_7 from lagged qualify row_number() over (partition by Store order by Date desc) = 1",
           lagged=_LAGS_SQL.format(source="sales", by="Store")))
def latest_per_store(spark, sf_dir):
    return _lag_output(timeseries.latest_per_store(timeseries.with_production_lags(sales(spark, sf_dir))))


@query(sql("""select t.Store, cast(Date as varchar) as Date, coalesce(l1,0.0)::double as sales_lag_1, l1 is not null as has_history
 from (select Store, Date from sales) t left join
 (select Store, lag1 as l1 from (select Store, Date, lag(Sales) over (partition by Store order by Date) as lag1 from sales)
  qualify row_number() over (partition by Store order by Date desc) = 1) k on t.Store = k.Store"""))
def lag_lookup(spark, sf_dir):
    """Last lags joined to every store-day."""
    facts = sales(spark, sf_dir)
    history = timeseries.with_production_lags(facts, lags=(1,), means=())
    latest = timeseries.latest_per_store(history, ["sales_lag_1"])
    out = timeseries.with_latest_lags(facts.select("Store", "Date"), latest, ["sales_lag_1"])
    return out.select("Store", day_text().alias("Date"), "sales_lag_1", "has_history")


_FEATURE_SQL = {
    "splitted": f"select *, {SPLIT_SQL} as split from merged",
    "lagged": _LAGS_SQL.format(source="splitted", by="split, Store"),
    "features": """select *, cast(day(Date) as int) as Day, cast(month(Date) as int) as Month, cast(year(Date) as int) as Year, cast(week(Date) as int) as WeekOfYear
 from lagged where sales_lag_30 is not null and sales_roll_mean_7 is not null and CompetitionDistance is not null and CompetitionOpenSinceMonth is not null
 and CompetitionOpenSinceYear is not null and Promo2SinceWeek is not null and Promo2SinceYear is not null and PromoInterval is not null""",
}
_ROOMY_SQL = {**_FEATURE_SQL, "features": """select *, cast(day(Date) as int) as Day, cast(month(Date) as int) as Month, cast(year(Date) as int) as Year, cast(week(Date) as int) as WeekOfYear
 from lagged where sales_lag_30 is not null"""}


def _features(spark, sf_dir, subset=None):
    return timeseries.feature_table(prepare.with_split(merged(spark, sf_dir)), subset=subset)


@query(sql("select Store, cast(Date as varchar) as Date, split, Sales, sales_lag_1, sales_lag_7, sales_lag_30, round(sales_roll_mean_7,6) as sales_roll_mean_7, Day, Month, Year, WeekOfYear, StoreType, round(ln(1+Sales::double),6) as label from features",
           **_FEATURE_SQL))
def feature_table(spark, sf_dir):
    out = _features(spark, sf_dir).withColumn("label", F.log1p("Sales"))
    return rounded(out.select("Store", day_text().alias("Date"), "split", "Sales", *LAG_COLUMNS, "Day", "Month", "Year",
                              "WeekOfYear", "StoreType", "label"), "sales_roll_mean_7", "label")


@query(sql("select StoreType, Promo, round(avg(Sales),6) as mean_sales, round(avg(sales_roll_mean_7),4) as mean_week, count(*) as rows from features group by 1, 2", **_ROOMY_SQL))
def feature_means(spark, sf_dir):
    """Mean sales by store type and promotion over the feature table, lags taken inside each split."""
    grouped = _features(spark, sf_dir, ["sales_lag_30"]).groupBy("StoreType", "Promo").agg(
        F.avg("Sales").alias("mean_sales"), F.avg("sales_roll_mean_7").alias("mean_week"), F.count("*").alias("rows")
    )
    return rounded(rounded(grouped, "mean_sales"), "mean_week", places=4)


@query(sql("select Store, cast(Date as varchar) as Date, " + ", ".join(f"round({f}(2*3.141592653589793::double*{c}/{n}),6) as {c}_{f}" for c, n in [("DayOfWeek", 7), ("Month", 12), ("WeekOfYear", 52)] for f in ("sin", "cos"))
           + " from (select Store, Date, DayOfWeek, month(Date) as Month, week(Date) as WeekOfYear from sales)"))
def cyclical_features(spark, sf_dir):
    out = timeseries.with_cyclical(with_date_parts(sales(spark, sf_dir)))
    names = [f"{c}_{f}" for c in ("DayOfWeek", "Month", "WeekOfYear") for f in ("sin", "cos")]
    return rounded(out.select("Store", day_text().alias("Date"), *names), *names)


def _scaled_sql() -> str:
    parts = []
    for c in NUMERIC_FEATURES:
        filled = f"coalesce({c}::double, s.med_{c})"
        parts.append(f"round(({filled} - s.mean_{c}) / case when s.dev_{c} = 0 then 1 else s.dev_{c} end, 6) as scaled_{c}")
    return f"select Store, cast(Date as varchar) as Date, split, {', '.join(parts)} from features, stats s"


_STATS_SQL = {
    "medians": "select " + ", ".join(f"quantile_cont({c}::double,0.5) as med_{c}" for c in NUMERIC_FEATURES) + " from features where split = 'train'",
    "stats": "select any_value(m) as m, " + ", ".join(
        f"any_value(m.med_{c}) as med_{c}, avg(coalesce({c}::double, m.med_{c})) as mean_{c}, stddev_pop(coalesce({c}::double, m.med_{c})) as dev_{c}" for c in NUMERIC_FEATURES
    ) + " from features, medians m where split = 'train'",
}


@query(sql(_scaled_sql(), **_ROOMY_SQL, **_STATS_SQL))
def scaled_features(spark, sf_dir):
    """Median-filled numeric features in training deviations from the training mean."""
    rows = _features(spark, sf_dir, ["sales_lag_30"]).select("Store", "Date", "split", *NUMERIC_FEATURES)
    rows = written(rows, "features")  # read for the scales and for the result
    fitted = fit_features.fit(rows.where("split = 'train'"), categorical=[])
    names = [f"scaled_{c}" for c in NUMERIC_FEATURES]
    out = fitted.model.transform(rows)
    return rounded(out.select("Store", day_text().alias("Date"), "split", *names), *names)


@query(sql(" union all ".join(
    f"select Store, cast(Date as varchar) as Date, split, concat('{c}_', {c}) as feature from features where {c} in (select {c} from features where split = 'train')"
    for c in CATEGORICAL_FEATURES), **_ROOMY_SQL))
def onehot_features(spark, sf_dir):
    """Active one-hot slots of every row; categories come from the training rows."""
    rows = _features(spark, sf_dir, ["sales_lag_30"])
    fitted = fit_features.fit(rows.where("split = 'train'"), numeric=[])
    out = fit_features.active_categories(rows, fitted, ["Store", "Date", "split"])
    return out.select("Store", day_text().alias("Date"), "split", "feature")


@query(sql(" union all ".join(
    f"select distinct concat('{c}_', {c}) as feature from features where split = 'train' and {c} in (select {c} from features where split = 'test')"
    for c in CATEGORICAL_FEATURES), **_ROOMY_SQL))
def aligned_categories(spark, sf_dir):
    """One-hot columns that encodings fitted on each split have in common."""
    return fit_features.common_categories(_features(spark, sf_dir, ["sales_lag_30"]), CATEGORICAL_FEATURES)
