"""Request, latency and prediction metrics over an event table.

Every function works on a batch and on a streaming DataFrame unless it says otherwise. An
event has an id, a time, a handler, a key and a measured value; ``failed`` marks errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

PERCENTILES = [0.5, 0.95, 0.99]
BUCKETS = [1.0, 2.5, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0, 1000.0]  # upper bounds of latency buckets
MINUTE = 60


def requests_from(events: DataFrame) -> DataFrame:
    """Monitoring columns of the event table. Watermarks need a zoned time."""
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("handler"),
        F.col("user_id").alias("key"),
        "value",
        (F.col("event_type") == "error").alias("failed"),
    )


def total_requests(requests: DataFrame) -> DataFrame:
    return requests.agg(F.count("*").alias("total_requests"))


def _error_rate() -> list[Column]:
    return [
        F.count("*").alias("requests"),
        F.count_if("failed").alias("failures"),
        (F.count_if("failed") / F.count("*") * 100).alias("error_percent"),
    ]


def _sliding(minutes: DataFrame, *by: str) -> DataFrame:
    """(window_start, by..., counts summed) of counts per ``minute``, each counted in the five
    windows that hold it. Events are folded to minutes before they are spread."""
    counts = [c for c in minutes.columns if c not in ("minute", *by)]
    starts = F.explode(F.sequence(F.col("minute") - F.expr("interval 4 minutes"), F.col("minute"), F.expr("interval 1 minute")))
    return minutes.withColumn("window_start", starts).groupBy("window_start", *by).agg(*[F.sum(c).alias(c) for c in counts])


def error_rate_windows(requests: DataFrame) -> DataFrame:
    """Error share over each 5 minutes that saw traffic, every minute."""
    if not requests.isStreaming:
        minutes = requests.groupBy(F.date_trunc("minute", "ts").alias("minute")).agg(
            F.count("*").alias("requests"), F.count_if("failed").alias("failures"))
        return _sliding(minutes.where("minute is not null")).select(
            "window_start", (F.col("window_start") + F.expr("interval 5 minutes")).alias("window_end"), "requests", "failures",
            (F.col("failures") / F.col("requests") * 100).alias("error_percent"))
    return requests.groupBy(F.window("ts", "5 minutes", "1 minute")).agg(*_error_rate()).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "requests", "failures", "error_percent",
    )


def error_rate(requests: DataFrame) -> DataFrame:
    """As ``error_rate_windows`` for every minute between the first and the last window, 0 where
    nothing was requested. Batch only."""
    seen = error_rate_windows(requests)
    spark = requests.sparkSession
    # Two numbers; the minutes between are made in parallel.
    first, last = requests.agg(*(F.floor(F.unix_timestamp(f(F.date_trunc("minute", "ts"))) / MINUTE) for f in (F.min, F.max))).first()
    grid = spark.range(0) if first is None else spark.range(first + 1, last + 6)
    every = grid.select(F.timestamp_seconds(F.col("id") * MINUTE).alias("window_end"))
    return every.join(seen, "window_end", "left").select(
        "window_end",
        F.coalesce("requests", F.lit(0)).alias("requests"),
        F.coalesce("failures", F.lit(0)).alias("failures"),
        F.coalesce("error_percent", F.lit(0.0)).alias("error_percent"),
    )


def request_rate(requests: DataFrame) -> DataFrame:
    """Requests per second of each handler and minute."""
    return requests.groupBy(F.window("ts", "1 minute"), "handler").agg(F.count("*").alias("requests")).select(
        F.col("window.start").alias("window_start"), "handler", "requests", (F.col("requests") / 60).alias("per_second")
    )


def latency_percentiles(requests: DataFrame, percentiles: list[float] | None = None) -> DataFrame:
    """Exact p50, p95 and p99 over each 5 minutes, every minute: the smallest value that so many
    values do not exceed. Batch only. Equal values of a minute fold before they are spread, and
    a window's running count is over its distinct values."""
    percentiles = percentiles or PERCENTILES
    minutes = requests.groupBy(F.date_trunc("minute", "ts").alias("minute"), "value").agg(F.count("*").alias("rows"))
    counted = _sliding(minutes.where("minute is not null"), "value")
    upto = W.partitionBy("window_start").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    known = F.when(F.col("value").isNotNull(), F.col("rows")).otherwise(0)  # nulls come first and count as requests only
    seen = counted.withColumn("seen", F.sum(known).over(upto))
    whole = W.partitionBy("window_start")
    ranked = seen.withColumn("n", F.sum(known).over(whole))
    picks = [
        F.min(F.when(F.col("value").isNotNull() & (F.col("seen") >= F.greatest(F.lit(1), F.col("n") - F.floor(F.col("n") - F.col("n") * p))), F.col("value")))
        .alias(f"p{p * 100:g}") for p in percentiles
    ]
    return ranked.groupBy("window_start").agg(F.sum("rows").alias("requests"), *picks)


def latency_buckets(requests: DataFrame, percentiles: list[float] | None = None, buckets: list[float] | None = None) -> DataFrame:
    """p50, p95 and p99 over each 5 minutes, every minute, from counts in fixed buckets: linear
    inside the bucket that holds the rank, the largest bound beyond it. The state of a window is
    one count for each bucket, whatever its traffic."""
    percentiles, buckets = percentiles or PERCENTILES, buckets or BUCKETS
    counts = [F.count_if(F.col("value") <= b).alias(f"le{k}") for k, b in enumerate(buckets)]
    grouped = requests.groupBy(F.window("ts", "5 minutes", "1 minute")).agg(
        F.count("*").alias("requests"), F.count("value").alias("n"), *counts)

    def at(p: float) -> Column:
        rank, found = F.col("n") * p, F.lit(float(buckets[-1]))
        for k in reversed(range(len(buckets))):
            low, under = (buckets[k - 1], F.col(f"le{k - 1}")) if k else (0.0, F.lit(0))
            inside = F.col(f"le{k}") - under
            line = low + (buckets[k] - low) * F.when(inside > 0, (rank - under) / inside).otherwise(1.0)
            found = F.when(F.col(f"le{k}") >= rank, line).otherwise(found)
        return F.when(F.col("n") > 0, found)

    return grouped.select(F.col("window.start").alias("window_start"), "requests", *[at(p).alias(f"p{p * 100:g}") for p in percentiles])


def running_total(requests: DataFrame) -> DataFrame:
    """Predictions per minute and so far. Batch only. Minutes are summed inside their day, and
    days are shifted by the days before: one row for each day of the calendar."""
    minutes = requests.groupBy(F.date_trunc("minute", "ts").alias("minute")).agg(F.count("*").alias("predictions"))
    dated = minutes.withColumn("day", F.to_date("minute"))
    before = W.orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    days = dated.groupBy("day").agg(F.sum("predictions").alias("in_day")).select(
        "day", F.coalesce(F.sum("in_day").over(before), F.lit(0)).alias("before"))
    upto = W.partitionBy("day").orderBy("minute").rowsBetween(W.unboundedPreceding, W.currentRow)
    return dated.join(days, "day").select("minute", "predictions", (F.col("before") + F.sum("predictions").over(upto)).alias("total"))


def latest_value(requests: DataFrame, by: str = "key") -> DataFrame:
    """Last value and its time per label, by partial aggregation."""
    last = F.max_by(F.struct("ts", "value"), F.struct("ts", "event_id")).alias("last")
    return requests.groupBy(by).agg(last).select(by, F.col("last.ts").alias("ts"), F.col("last.value").alias("value"))


def outcome_counts(requests: DataFrame) -> DataFrame:
    """Successes, failures and the last latency over all answers."""
    return requests.agg(
        F.count_if(~F.col("failed")).alias("successes"),
        F.count_if("failed").alias("failures"),
        F.max_by("value", F.struct("ts", "event_id")).alias("last_latency"),
    )
