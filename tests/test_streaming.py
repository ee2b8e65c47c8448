import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators import monitor, timeseries
from shelfcast.operators.drift import drift_report, drift_summary
from shelfcast.plans import training
from shelfcast.schemas import EVENT_SCHEMA, rules_from
from shelfcast.sources.canonical import sales
from shelfcast.streaming import lags, runs, scoring
from shelfcast.streaming.tables import Ledger, StreamTable

T0 = dt.datetime(2024, 1, 1, 0, 0)


def event(i, minute, kind="view", value=1.0):
    return (i, T0 + dt.timedelta(minutes=minute), i % 3, kind, float(value), "{}")


@pytest.fixture()
def log(spark, tmp_path):
    """Writes each batch of events as one file, in order."""
    def write(*batches):
        folder = f"{tmp_path}/events"
        for n, rows in enumerate(batches):
            spark.createDataFrame(rows, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream = runs.read_stream(spark, folder, EVENT_SCHEMA, files_per_trigger=1)
        return runs.on_time(monitor.requests_from(stream))

    return write


def test_late_rows_are_dropped_and_windows_closed(spark, log):
    batches = [[event(1, 1), event(2, 2, "error")], [event(3, 60)], [event(4, 61)], [event(5, 1), event(6, 62)], [event(7, 200)]]
    out = runs.run_to_end(monitor.request_rate(log(*batches)), "late")
    got = {(r["window_start"].minute + 60 * r["window_start"].hour, r["handler"]): r["requests"] for r in out.collect()}
    # minute 1 counts event 1 alone: event 5 arrived an hour late
    assert got == {(1, "view"): 1, (2, "error"): 1, (60, "view"): 1, (61, "view"): 1, (62, "view"): 1}


def test_replayed_events_count_once(log):
    rows = [event(1, 1), event(2, 2)]
    out = runs.run_to_end(runs.once_each(log(rows, rows, [event(3, 3)])), "replay")
    assert sorted(r["event_id"] for r in out.collect()) == [1, 2, 3]


def test_stream_equals_batch_after_a_last_event(spark, log, tmp_path):
    rows = [event(i, i % 47, "error" if i % 5 == 0 else "view", i) for i in range(300)]
    last = event(999, 10_000)
    out = runs.run_to_end(monitor.error_rate_windows(log(rows, [last])), "equal")
    batch = monitor.error_rate_windows(monitor.requests_from(spark.createDataFrame(rows, EVENT_SCHEMA)))
    assert out.exceptAll(batch).count() == 0 and out.count() == batch.count()


def test_latest_value_is_replaced(log):
    stream = log([event(3, 1, value=5)], [event(6, 9, value=7)], [event(9, 4, value=9)])
    out = runs.run_to_table(monitor.latest_value(stream), "latest", ("key",))
    assert [(r["key"], r["value"]) for r in out.collect()] == [(0, 7.0)]


def test_error_rate_is_zero_without_traffic(spark):
    rows = [event(1, 0, "error"), event(2, 20)]
    out = monitor.error_rate(monitor.requests_from(spark.createDataFrame(rows, EVENT_SCHEMA))).orderBy("window_end").collect()
    assert len(out) == 25 and [r["error_percent"] for r in out] == [100.0] * 5 + [0.0] * 20
    assert sum(r["requests"] for r in out) == 10


def test_drift_checks_call_retraining_once_per_drifted_batch(spark, tmp_path):
    reference = spark.range(500).select((F.col("id") % 10).cast("double").alias("v"), F.lit("a").alias("k"))
    same, moved = reference, reference.select((F.col("v") + 100).alias("v"), F.lit("b").alias("k"))
    folder = f"{tmp_path}/log"
    for part in (same, moved):
        part.coalesce(1).write.mode("append").parquet(folder)
    calls = []
    watch = scoring.DriftWatch.at(f"{tmp_path}/watch", reference, ["v"], ["k"], 0.3)
    scoring.start_drift_checks(
        runs.read_stream(spark, folder, reference.schema, files_per_trigger=1), watch, f"{tmp_path}/out",
        retrain=lambda batch: calls.append(batch) or {"batch": batch}, trigger={"availableNow": True},
    ).awaitTermination()
    rows = watch.results.read().orderBy("batch").collect()
    assert [r["requires_retraining"] for r in rows] == [False, True] and calls == [1]
    assert [r["log_rows"] for r in rows] == [500, 1000]


def test_drift_of_the_log_so_far_and_replayed_batches(spark, tmp_path):
    """The state counts every batch once, and equals one comparison of all records so far."""
    rows = spark.range(900).select((F.col("id") % 13).cast("double").alias("v"), (F.col("id") % 3).cast("string").alias("k"), (F.col("id") % 3).alias("b"))
    reference = rows.where("v < 9").drop("b")
    watch = scoring.DriftWatch.at(f"{tmp_path}/watch", reference, ["v"], ["k"], 0.3)
    for batch in (0, 1, 1, 2, 0, 2):
        watch.check(rows.where(F.col("b") == batch).drop("b"), batch)
    again = scoring.DriftWatch.at(f"{tmp_path}/watch", reference.limit(1), ["v"], ["k"], 0.3)  # counted already
    found = {r["batch"]: r for r in again.results.read().collect()}
    assert sorted(found) == [0, 1, 2] and [found[k]["log_rows"] for k in range(3)] == [300, 600, 900]
    for batch in found:
        want = drift_summary(drift_report(reference, rows.where(F.col("b") <= batch), ["v"], ["k"]), 0.3).first()
        assert all(found[batch][c] == want[c] for c in want.asDict())


def stream_table(spark, tmp_path, merge="append", keys=(), **more):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("n", T.LongType())])
    return StreamTable(spark, f"{tmp_path}/{merge}", schema, keys, merge, **more)


def pairs(df):
    return sorted((r["k"], r["n"]) for r in df.collect())


def test_log_counts_whole_batches_once(spark, tmp_path):
    log = stream_table(spark, tmp_path)
    one, two = (spark.createDataFrame([(b, 1), (b, 2)], "k long, n long") for b in (1, 2))
    assert log.read().count() == 0
    assert log.apply(one, 0) and not log.apply(two, 0)
    broken = two.withColumn("n", F.when(F.col("n") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="lost"):
        log.apply(broken, 1)
    two.write.mode("append").parquet(log._rows(1))  # what a failed attempt left behind
    assert pairs(log.read()) == [(1, 1), (1, 2)]
    assert log.apply(two, 1) and not log.apply(two, 1) and pairs(log.read()) == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert pairs(log.read(upto=0)) == [(1, 1), (1, 2)]
    empty = log.apply(one.where("false"), 2)
    assert empty and log.batches() == [0, 1, 2] and log.read().count() == 4


@pytest.mark.parametrize("merge", ["latest", "add"])
def test_keyed_table_over_compactions(spark, tmp_path, merge):
    table = stream_table(spark, tmp_path, merge, ("k",), compact_every=3)
    want = {}
    for batch in range(10):
        rows = [(batch % 4, batch), (None, 1)]
        held = table.read()  # a reader that started before the batch
        before = dict(want)
        assert table.apply(spark.createDataFrame(rows, "k long, n long"), batch)
        assert {r["k"]: r["n"] for r in held.collect()} == before
        for k, n in rows:
            want[k] = n if merge == "latest" else want.get(k, 0) + n
        assert {r["k"]: r["n"] for r in table.read().collect()} == want
        assert not table.apply(spark.createDataFrame(rows, "k long, n long"), batch)
    assert table.bases() == [2, 5, 8]
    table.vacuum()
    assert table.bases() == [5, 8] and table.batches() == [6, 7, 8, 9] and table.holds(1)
    assert {r["k"]: r["n"] for r in table.read().collect()} == want and not table.apply(table.read(), 3)
    assert table.read(upto=5).count() == 5


def test_keyed_table_without_keys_is_one_row(spark, tmp_path):
    table = stream_table(spark, tmp_path, "latest")
    for batch in range(3):
        table.apply(spark.createDataFrame([(batch, batch)], "k long, n long"), batch)
    assert pairs(table.read()) == [(2, 2)]
    with pytest.raises(ValueError):
        stream_table(spark, tmp_path, "append", ("k",))


def test_work_is_done_once_and_picked_up_after_a_crash(spark, tmp_path):
    ledger, calls = Ledger(spark, f"{tmp_path}/ledger"), []

    def work(batch):
        calls.append(batch)
        if len(calls) == 1:
            raise RuntimeError("killed between claim and commit")
        return {"batch": batch, "version": len(calls)}

    with pytest.raises(RuntimeError):
        ledger.once(4, work)
    assert ledger.unfinished() == [4] and ledger.outcome(4) is None and ledger.outcomes() == []
    assert ledger.once(4, work) == {"batch": 4, "version": 2} == ledger.once(4, work)
    assert calls == [4, 4] and ledger.unfinished() == [] and Ledger(spark, f"{tmp_path}/ledger").outcomes() == [{"batch": 4, "version": 2}]


def test_closed_loop_goes_on_after_a_crash(spark, sf_dir, tmp_path, monkeypatch):
    """Killed while it fits, the loop started again fits the batch once and counts its rows once."""
    days = sales(spark, sf_dir).withColumn("Month", F.month("Date")).where("Date < date'1996-06-01'")
    reference, parts = days.where("Month <= 2 and Date < date'1996-01-01'"), [days.where("Month between 3 and 8 and Date < date'1996-01-01'")]
    rules = rules_from({"Sales": {"dtype": "int64", "nullable": False, "min": 0}})
    fit, calls = training.refit, []

    def failing(*args):
        calls.append(args[3])
        if len(calls) == 1:
            raise RuntimeError("killed")
        return fit(*args)

    monkeypatch.setattr(training, "refit", failing)
    with pytest.raises(Exception, match="killed"):
        training.closed_loop(reference, parts, f"{tmp_path}/loop", ["Month"], ["SchoolHoliday"], rules)
    out = training.closed_loop(reference, [days.where("false")], f"{tmp_path}/loop", ["Month"], ["SchoolHoliday"], rules).orderBy("batch").collect()
    assert calls[:2] == [0, 0] and out[0]["retrained"] and out[0]["model_version"] == 1
    assert out[0]["log_rows"] == parts[0].count() and out[0]["training_rows"] > 0
    again = fit(days.withColumn("Sales", F.lit(-1)), rules, f"{tmp_path}/bad", 0, 1)
    assert again == {"batch": 0, "retrained": False}


def lag_rows(out):
    return {r["Store"]: tuple(r)[1:] for r in out.collect()}


def test_lags_of_days_out_of_order(spark, tmp_path, series):
    days = series({1: [(d, d * d) for d in range(50)], 2: [(0, 5), (3, 7)], 3: [(d, 1) for d in range(30)]}).select("Store", "Date", "Sales")
    folder, provider = f"{tmp_path}/days", "spark.sql.streaming.stateStore.providerClass"
    for k in (2, 0, 1):
        days.where(F.dayofyear("Date") % 3 == k).coalesce(1).write.mode("append").parquet(folder)
    days.where("Store = 2").coalesce(1).write.mode("append").parquet(folder)  # arrives again
    before = spark.conf.get(provider)
    spark.conf.set(provider, lags.PROVIDER)
    try:
        out = runs.run_to_table(lags.current_lags(runs.read_stream(spark, folder, days.schema, 1)), "lags", ("Store",))
        got = lag_rows(out)
    finally:
        spark.conf.set(provider, before)
    want = lag_rows(timeseries.latest_per_store(timeseries.with_production_lags(days)))
    assert got == want and got[2][1:] == (5.0, None, None, None)


def test_newest_days_pass_over_older_ones():
    class State:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, held):
            self.held = held

    keeper = lags.NewestDays(held=4)
    keeper.days = State()

    def arrive(*days):
        block = pd.DataFrame({"Store": 7, "Date": [dt.date(2024, 1, d) for d, _ in days], "Sales": [s for _, s in days]})
        return list(keeper.handleInputRows((7,), iter([block]), None))[0].iloc[0]

    assert arrive((5, 50), (2, 20))["sales_lag_1"] == 20
    assert arrive((3, 30), (4, 40))["sales_lag_1"] == 40
    assert arrive((1, 10), (4, 44))["sales_lag_1"] == 44 and keeper.days.held[1] == [20.0, 30.0, 44.0, 50.0]
    assert arrive((9, 90))["Date"] == dt.date(2024, 1, 9) and len(keeper.days.held[0]) == 4


def test_prediction_log_keeps_request_and_answer(spark, tmp_path):
    requests = spark.createDataFrame([(1, 1, 5, dt.date(2024, 1, 2), 1), (2, 1, 6, dt.date(2024, 1, 3), 0)], "order_id long, line int, Store long, Date date, Promo int")
    requests.coalesce(1).write.parquet(f"{tmp_path}/requests")
    stores = spark.createDataFrame([(5, "a")], "Store long, StoreType string")
    latest = spark.createDataFrame([(5, 100)], "Store long, sales_lag_1 long")
    scored = scoring.score(runs.read_stream(spark, f"{tmp_path}/requests", requests.schema), stores, latest, lambda lag, promo: lag * 0.01 + promo)
    logged = scoring.prediction_log(scored, "m1", F.col("Date").cast("timestamp_ntz"))
    for _ in range(2):  # started again, it logs nothing twice
        runs.start_log(logged, f"{tmp_path}/out").awaitTermination()
    rows = StreamTable(spark, f"{tmp_path}/out/log", logged.schema).read().orderBy("order_id").collect()
    assert [(r["Store"], r["Promo"], r["sales_lag_1"], r["prediction"], r["model_version"]) for r in rows] == [(5, 1, 100.0, 6.39, "m1"), (6, 0, 0.0, 0.0, "m1")]
    assert rows[0]["event_time"] == dt.datetime(2024, 1, 2)


def test_latency_is_exact_for_busy_windows(spark):
    events = spark.range(30_000).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:30'").alias("ts"), F.lit("view").alias("event_type"),
        (F.col("id") % 7).alias("user_id"), ((F.col("id") * 7919) % 30_000 / 10).alias("value"), F.lit(None).cast("string").alias("props"))
    out = monitor.latency_percentiles(monitor.requests_from(events)).collect()
    assert len(out) == 5 and {(r["requests"], r["p50"], r["p95"], r["p99"]) for r in out} == {(30_000, 1499.9, 2849.9, 2969.9)}


def test_latency_buckets_interpolate(spark):
    rows = spark.createDataFrame([(0.5,), (1.5,), (2.0,), (2000.0,), (None,)], "value double").select(
        F.expr("timestamp'2024-01-01 00:00:30'").alias("ts"), "value")
    row = monitor.latency_buckets(rows, [0.25, 0.5, 1.0]).first()
    assert (row["requests"], row["p25"], row["p50"], row["p100"]) == (5, 1.0, 1.75, 1000.0)


def test_running_total_over_days(spark):
    rows = spark.createDataFrame([("2024-01-01 23:59:10",), ("2024-01-01 23:59:50",), ("2024-01-03 00:00:00",)], "t string").select(
        F.to_timestamp("t").alias("ts"))
    assert [(r["predictions"], r["total"]) for r in monitor.running_total(rows).orderBy("minute").collect()] == [(2, 2), (1, 3)]
