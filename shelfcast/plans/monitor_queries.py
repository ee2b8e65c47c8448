"""Monitoring metrics in batch and as streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import baseline, monitor, timeseries
from shelfcast.operators.drift import SHARE_THRESHOLD
from shelfcast.plans import training
from shelfcast.plans.drift_queries import ALL_SQL, CATEGORICAL, NUMERIC, _categorical_sql, _numeric_sql, sides
from shelfcast.plans.forecast_queries import MODEL_SQL, _model
from shelfcast.plans.registry import SPLIT_SQL, day_text, query, rounded, sql, time_text
from shelfcast.schemas import rules_from
from shelfcast.session import written
from shelfcast.sources import files
from shelfcast.sources.canonical import sales, store, table
from shelfcast.streaming import monitor as live
from shelfcast.streaming import lags, scoring
from shelfcast.streaming.runs import read_stream, run_arrivals, run_folder, run_to_end, run_to_table, start_files, start_log
from shelfcast.streaming.tables import StreamTable


def _requests(spark, sf_dir):
    return monitor.requests_from(table(spark, sf_dir, "events"))


_MINUTE = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
# Each event falls into the five windows that start at its minute and the four before.
_SLIDING = """(select date_trunc('minute', ts) - s * interval 1 minute as window_start, event_type, value from events, (select unnest([0,1,2,3,4]) as s))"""
_CLOSED = "window_start + interval 5 minute <= (select max(ts) - interval 10 minute from events)"


@query("select count(*) as total_requests from events")
def total_requests(spark, sf_dir):
    return monitor.total_requests(_requests(spark, sf_dir))


@query(f"""with seen as (select window_start + interval 5 minute as t, count(*) as requests, count(case when event_type='error' then 1 end) as failures from {_SLIDING} group by 1),
 every as (select unnest(generate_series(min(t), max(t), interval 1 minute)) as t from seen)
 select {_MINUTE.format('every.t')} as window_end, coalesce(requests,0) as requests, coalesce(failures,0) as failures, coalesce(round(failures/requests*100,6),0) as error_percent from every left join seen on every.t = seen.t""")
def error_rate_5m(spark, sf_dir):
    out = monitor.error_rate(_requests(spark, sf_dir))
    return rounded(out, "error_percent").withColumn("window_end", time_text("window_end"))


@query(f"select {_MINUTE.format('date_trunc(' + chr(39) + 'minute' + chr(39) + ', ts)')} as window_start, event_type as handler, count(*) as requests, round(count(*)/60,6) as per_second from events group by 1, 2")
def rate_1m(spark, sf_dir):
    out = monitor.request_rate(_requests(spark, sf_dir))
    return rounded(out, "per_second").withColumn("window_start", time_text("window_start"))


_LATENCY = f"""select {_MINUTE.format('window_start')} as window_start, count(*) as requests, quantile_disc(value,0.5) as p50, quantile_disc(value,0.95) as p95, quantile_disc(value,0.99) as p99 from {_SLIDING}"""


@query(f"{_LATENCY} group by 1")
def latency_pcts(spark, sf_dir):
    out = monitor.latency_percentiles(_requests(spark, sf_dir))
    return out.withColumn("window_start", time_text("window_start"))


@query(f"select {_MINUTE.format('m')} as minute, predictions, cast(sum(predictions) over (order by m) as bigint) as total from (select date_trunc('minute', ts) as m, count(*) as predictions from events group by 1)")
def running_predictions(spark, sf_dir):
    out = monitor.running_total(_requests(spark, sf_dir))
    return out.withColumn("minute", time_text("minute"))


_LAST = "select user_id as key, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, value from events qualify row_number() over (partition by user_id order by events.ts desc, event_id desc) = 1"


@query(_LAST)
def last_gauge(spark, sf_dir):
    return monitor.latest_value(_requests(spark, sf_dir)).withColumn("ts", time_text("ts"))


@query("select event_type as handler, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, value from events qualify row_number() over (partition by event_type order by events.ts desc, event_id desc) = 1")
def last_latency(spark, sf_dir):
    return monitor.latest_value(_requests(spark, sf_dir), "handler").withColumn("ts", time_text("ts"))


_OUTCOMES = "select count(case when event_type<>'error' then 1 end) as successes, count(case when event_type='error' then 1 end) as failures, (select value from events order by ts desc, event_id desc limit 1) as last_latency from events"


@query(_OUTCOMES)
def outcome_counts(spark, sf_dir):
    return monitor.outcome_counts(_requests(spark, sf_dir))


# Streaming. Append mode writes a window once the watermark has passed its end.


@query(f"""select {_MINUTE.format('window_start')} as window_start, requests, failures, round(failures/requests*100,6) as error_percent from
 (select window_start, count(*) as requests, count(case when event_type='error' then 1 end) as failures from {_SLIDING} group by 1) where {_CLOSED}""")
def stream_error_rate(spark, sf_dir):
    out = live.error_rate(spark, sf_dir).drop("window_end")
    return rounded(out, "error_percent").withColumn("window_start", time_text("window_start"))


@query(f"""select {_MINUTE.format('window_start')} as window_start, handler, requests, round(requests/60,6) as per_second from
 (select date_trunc('minute', ts) as window_start, event_type as handler, count(*) as requests from events group by 1, 2)
 where window_start + interval 1 minute <= (select max(ts) - interval 10 minute from events)""")
def stream_request_rate(spark, sf_dir):
    out = live.request_rate(spark, sf_dir)
    return rounded(out, "per_second").withColumn("window_start", time_text("window_start"))


def _bucket_sql(p: float) -> str:
    """The value at a rank from counts in fixed buckets: the first bucket that reaches it."""
    cases = []
    for k, high in enumerate(monitor.BUCKETS):
        low, under = (monitor.BUCKETS[k - 1], f"le{k - 1}") if k else (0.0, "0")
        line = f"{low}::double + ({high}::double - {low}::double) * case when le{k} > {under} then (n * {p}::double - {under}) / (le{k} - {under})::double else 1.0 end"
        cases.append(f"when le{k} >= n * {p}::double then {line}")
    return f"round(case when n > 0 then case {' '.join(cases)} else {monitor.BUCKETS[-1]}::double end end, 6)"


_BUCKETS = ", ".join(f"count(case when value <= {b}::double then 1 end) as le{k}" for k, b in enumerate(monitor.BUCKETS))


@query(f"""select {_MINUTE.format('window_start')} as window_start, requests, {_bucket_sql(0.5)} as p50, {_bucket_sql(0.95)} as p95, {_bucket_sql(0.99)} as p99
 from (select window_start, count(*) as requests, count(value) as n, {_BUCKETS} from {_SLIDING} where {_CLOSED} group by 1)""")
def stream_latency(spark, sf_dir):
    out = rounded(live.latency_percentiles(spark, sf_dir), "p50", "p95", "p99")
    return out.withColumn("window_start", time_text("window_start"))


@query(_LAST)
def stream_last_gauge(spark, sf_dir):
    return live.latest_value(spark, sf_dir).withColumn("ts", time_text("ts"))


@query(_OUTCOMES)
def stream_outcomes(spark, sf_dir):
    return live.outcome_counts(spark, sf_dir)


@query("select distinct event_id, event_type as handler, user_id as key, value from events")
def stream_distinct(spark, sf_dir):
    return live.distinct_requests(spark, sf_dir).select("event_id", "handler", "key", "value")


_LAST_LAG = "select Store, l1 from (select Store, Date, lag(Sales) over (partition by Store order by Date) as l1 from sales) qualify row_number() over (partition by Store order by Date desc) = 1"
_SCORED_LINES = """lineitem left join store r on r.Store = l_suppkey left join lasts k on k.Store = l_suppkey, model"""
_LINE_PREDICTION = "round(exp(b0+b1*coalesce(l1,0)+b2*cast(case when l_discount>0.05 then 1 else 0 end as int))-1,2) as prediction"


def _scored_lines(spark, sf_dir):
    """Order lines arriving as requests: enriched and scored."""
    history = timeseries.with_production_lags(sales(spark, sf_dir), lags=(1,), means=())
    latest = written(timeseries.latest_per_store(history, ["sales_lag_1"]), "last-lags")  # not again in every micro-batch
    m = _model(spark, sf_dir).first()  # one row: a served model's weights are fixed while it serves
    weights = {name: F.lit(m[name]) for name in ("intercept", "lag_weight", "promo_weight")}
    return scoring.score(
        scoring.request_stream(spark, sf_dir), store(spark, sf_dir), latest,
        lambda lag, promo: baseline.log_prediction(weights, lag, promo),
    )


@query(sql(f"select l_orderkey as order_id, l_linenumber as line, l_suppkey as Store, cast(cast(l_shipdate as date) as varchar) as Date, r.StoreType, {_LINE_PREDICTION} from {_SCORED_LINES}",
           **MODEL_SQL, lasts=_LAST_LAG))
def stream_scoring(spark, sf_dir):
    """Order lines arriving as requests: enriched, scored and written."""
    scored = _scored_lines(spark, sf_dir)
    logged = run_to_end(scored.select("order_id", "line", "Store", "Date", "StoreType", "prediction"), "scoring", start_files)
    return logged.withColumn("Date", F.date_format("Date", "yyyy-MM-dd"))


@query(sql(f"""select l_orderkey as order_id, l_linenumber as line, l_suppkey as Store, cast(cast(l_shipdate as date) as varchar) as Date, cast(case when l_discount>0.05 then 1 else 0 end as int) as Promo,
 r.StoreType, coalesce(l1,0)::double as sales_lag_1, {_LINE_PREDICTION}, 'closed-form-1' as model_version, strftime(cast(l_shipdate as date)::timestamp, '%Y-%m-%d %H:%M:%S') as event_time from {_SCORED_LINES}""",
           **MODEL_SQL, lasts=_LAST_LAG))
def prediction_log(spark, sf_dir):
    """The log of all answers: request, prediction, model version and event time, committed by batch."""
    scored = scoring.prediction_log(_scored_lines(spark, sf_dir), "closed-form-1", F.col("Date").cast("timestamp_ntz"))
    folder = run_folder(spark, "prediction-log")
    start_log(scored, folder).awaitTermination()
    rows = StreamTable(spark, f"{folder}/log", scored.schema).read()
    return rows.withColumns({"Date": F.date_format("Date", "yyyy-MM-dd"), "event_time": time_text("event_time")})


def _as_stream(spark, df, name, files_per_trigger=None):
    """A stream over a table written for it."""
    folder = run_folder(spark, name)
    files.write_parquet(df, folder)
    return read_stream(spark, folder, df.schema, files_per_trigger)


@query(sql("select Store, cast(Date as varchar) as Date, Sales from sales qualify row_number() over (partition by Store order by Date desc) = 1"))
def stream_latest_sales(spark, sf_dir):
    """Last day and sales of each store, kept as streaming state."""
    days = _as_stream(spark, sales(spark, sf_dir).select("Store", "Date", "Sales"), "store-days")
    return run_to_table(scoring.latest_sales(days), "latest-sales", ("Store",)).withColumn("Date", F.date_format("Date", "yyyy-MM-dd"))


@query(sql("""select Store, cast(Date as varchar) as Date, l1::double as sales_lag_1, l7::double as sales_lag_7, l30::double as sales_lag_30, round(m7,6) as sales_roll_mean_7 from (
 select Store, Date, lag(Sales,1) over w as l1, lag(Sales,7) over w as l7, lag(Sales,30) over w as l30,
  case when count(Sales) over (partition by Store order by Date rows between 6 preceding and current row) = 7 then avg(Sales) over (partition by Store order by Date rows between 6 preceding and current row) end as m7
 from sales window w as (partition by Store order by Date)) qualify row_number() over (partition by Store order by Date desc) = 1"""))
def stream_latest_lags(spark, sf_dir):
    """All four lags of each store, kept as days arrive out of order in several batches."""
    days = sales(spark, sf_dir).select("Store", "Date", "Sales")
    parts = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    mixed = days.repartition(parts, F.xxhash64("Date"))  # every file holds days of the whole calendar
    stream = _as_stream(spark, mixed, "mixed-days", files_per_trigger=-(-parts // 4))
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, lags.PROVIDER)
    try:
        latest = run_to_table(lags.current_lags(stream), "latest-lags", ("Store",))
    finally:
        spark.conf.set(provider, before)
    return rounded(latest, "sales_roll_mean_7").withColumn("Date", day_text())


_LOG_YEARS = range(1998, 2002)  # the log arrives in four parts, the last without an end


def _after(year):
    return f"date '{year + 1}-01-01'" if year != _LOG_YEARS[-1] else "date '9999-01-01'"


def _summary_sql(batches: dict[int, tuple[str, str, list[str], list[str]]], threshold: float) -> str:
    """For each batch, from (reference, log so far, numeric, categorical): the summary of its check."""
    parts = []
    for batch, (reference, current, numeric, categorical) in batches.items():
        scores = " union all ".join(
            [f"(select w1/greatest(std,0.001) as score, current_rows from ({_numeric_sql(c, reference, current)}))" for c in numeric]
            + [f"(select js as score, current_rows from ({_categorical_sql(c, reference, current)}))" for c in categorical])
        parts.append(f"""(select {batch}::bigint as batch, 'success' as status, round(avg(case when score >= 0.1 then 1.0 else 0.0 end),4) as drift_share,
 cast(sum(case when score >= 0.1 then 1 else 0 end) as bigint) as drifted_columns_count, avg(case when score >= 0.1 then 1.0 else 0.0 end) > {threshold} as requires_retraining,
 cast(max(current_rows) as bigint) as log_rows from ({scores}))""")
    return " union all ".join(parts)


@query(sql("select * from checks", **{name: text for name, text in ALL_SQL.items() if name == "older"}, **{
    f"upto{k}": f"select * from merged where Date >= date '1998-01-01' and Date < {_after(y)}" for k, y in enumerate(_LOG_YEARS)},
    checks=_summary_sql({k: ("older", f"upto{k}", NUMERIC, CATEGORICAL) for k in range(len(_LOG_YEARS))}, SHARE_THRESHOLD)))
def stream_drift(spark, sf_dir):
    """The newer rows arriving year by year, the whole log checked against the older rows after each."""
    older, newer = sides(spark, sf_dir)
    columns = [*NUMERIC, *CATEGORICAL]
    folder = run_folder(spark, "drift")
    watch = scoring.DriftWatch.at(f"{folder}/watch", older.select(columns), NUMERIC, CATEGORICAL, SHARE_THRESHOLD)
    year = F.least(F.year("Date"), F.lit(_LOG_YEARS[-1]))
    held = written(newer.withColumn("_year", year).select("_year", *columns), "log")
    parts = [held.where(F.col("_year") == y).drop("_year") for y in _LOG_YEARS]
    run_arrivals(parts, folder, lambda stream: scoring.start_drift_checks(stream, watch, f"{folder}/run", trigger={"availableNow": True}))
    return watch.results.read()


# A service that starts in spring sees summer, autumn and whole years later on.
_LOOP_NUMERIC, _LOOP_CATEGORICAL = ["Customers", "Month", "Promo", "DayOfWeek"], ["StateHoliday", "SchoolHoliday"]
_LOOP_DAYS = ["1995-05-01", "1995-07-01", "1996-01-01", "1998-01-01", "9999-01-01"]
_LOOP_RULES = {
    "Store": {"dtype": "int64", "nullable": False},
    "Sales": {"dtype": "int64", "nullable": False, "min": 0},
    "Open": {"dtype": "int64", "nullable": False, "allowed_values": [0, 1]},
}


def _loop_sql() -> dict[str, str]:
    tables = {"dated": "select *, cast(month(Date) as int) as Month from sales", "spring": f"select * from dated where Date < date '{_LOOP_DAYS[0]}'"}
    fits = []
    for k, day in enumerate(_LOOP_DAYS[1:]):
        tables[f"log{k}"] = f"select * from dated where Date >= date '{_LOOP_DAYS[0]}' and Date < date '{day}'"
        tables[f"learn{k}"] = f"""select *, ln(1+Sales::double) as label from (select *, {SPLIT_SQL} as split, lag(Sales) over (partition by Store order by Date) as lag1 from sales where Date < date '{day}')
 where Open = 1 and lag1 is not null and split = 'train'"""
        fits.append(f"""select {k}::bigint as batch, n, (v2*c1-c12*c2)/(v1*v2-c12*c12) as b1, (v1*c2-c12*c1)/(v1*v2-c12*c12) as b2, my, m1, m2 from (
 select count(*) as n, avg(label) as my, avg(lag1) as m1, avg(Promo) as m2, var_pop(lag1::double) as v1, var_pop(Promo::double) as v2,
  covar_pop(lag1::double, Promo::double) as c12, covar_pop(lag1::double, label) as c1, covar_pop(Promo::double, label) as c2 from learn{k})""")
    tables["checks"] = _summary_sql({k: ("spring", f"log{k}", _LOOP_NUMERIC, _LOOP_CATEGORICAL) for k in range(len(_LOOP_DAYS) - 1)}, SHARE_THRESHOLD)
    tables["fits"] = " union all ".join(fits)
    return tables


@query(sql("""select c.batch, status, drift_share, drifted_columns_count, requires_retraining, log_rows, requires_retraining as retrained,
 case when requires_retraining then cast(sum(case when requires_retraining then 1 else 0 end) over (order by c.batch) as int) end as model_version,
 case when requires_retraining then n end as training_rows, case when requires_retraining then round(my-b1*m1-b2*m2,6) end as intercept,
 case when requires_retraining then round(b1,12) end as lag_weight, case when requires_retraining then round(b2,6) end as promo_weight
 from checks c join fits f on c.batch = f.batch""", **_loop_sql()))
def retrain_loop(spark, sf_dir):
    """The closed loop over the whole history: log, check, fit again where too much has drifted."""
    facts = written(sales(spark, sf_dir).withColumn("Month", F.month("Date").cast("int")), "loop-facts")
    day = [F.lit(d).cast("date") for d in _LOOP_DAYS]
    parts = [facts.where((F.col("Date") >= a) & (F.col("Date") < b)) for a, b in zip(day, day[1:])]
    out = training.closed_loop(
        facts.where(F.col("Date") < day[0]), parts, run_folder(spark, "loop"), _LOOP_NUMERIC, _LOOP_CATEGORICAL, rules_from(_LOOP_RULES))
    return rounded(rounded(out, "intercept", "promo_weight"), "lag_weight", places=12)
