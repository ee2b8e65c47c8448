"""Arriving records: enrich, score, log; keep the latest lags current; check drift on a clock."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators.drift import drift_report_of_counts, drift_summary, value_counts
from shelfcast.operators.timeseries import with_latest_lags
from shelfcast.schemas import LINEITEM_SCHEMA
from shelfcast.streaming.runs import read_stream
from shelfcast.streaming.tables import Ledger, StreamTable

DRIFT_INTERVAL = "10 minutes"


def request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as forecast requests: store, day and promotion flag."""
    lines = read_stream(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet", LINEITEM_SCHEMA)
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("Store"),
        F.col("l_shipdate").cast("date").alias("Date"),
        F.when(F.col("l_discount") > 0.05, 1).otherwise(0).alias("Promo"),
    )


def score(requests: DataFrame, store: DataFrame, latest: DataFrame, prediction: Callable[[Column, Column], Column]) -> DataFrame:
    """Join the static store table and last lags, predict, keep what was asked with what was
    answered. Stateless, so it runs in append mode without a watermark."""
    enriched = with_latest_lags(requests.join(store, "Store", "left"), latest, ["sales_lag_1"])
    return enriched.withColumn("prediction", F.round(F.expm1(prediction(F.col("sales_lag_1"), F.col("Promo"))), 2))


def prediction_log(scored: DataFrame, model_version: str, event_time: Column) -> DataFrame:
    """What was asked, what was answered, by which model and for when: the rows of the log."""
    return scored.select(
        "order_id", "line", "Store", "Date", "Promo", "StoreType", "sales_lag_1", "prediction",
        F.lit(model_version).alias("model_version"), event_time.alias("event_time"))


def latest_sales(sales_stream: DataFrame) -> DataFrame:
    """Last known sales of each store, as streaming state of one row per store."""
    return sales_stream.groupBy("Store").agg(F.max_by(F.struct("Date", "Sales"), F.struct("Date", "Sales")).alias("last")).select(
        "Store", "last.*"
    )


DRIFT_SCHEMA = T.StructType([
    T.StructField("batch", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("drift_share", T.DoubleType()),
    T.StructField("drifted_columns_count", T.LongType()),
    T.StructField("requires_retraining", T.BooleanType()),
    T.StructField("log_rows", T.LongType()),
])


@dataclass(frozen=True)
class DriftWatch:
    """Drift of everything logged so far against a reference that was counted once.

    The state is a table of counts by value: a batch adds its own counts, so a check costs the
    distinct values and not the log. ``results`` has a row for each batch; ``runs`` records what
    retraining a batch led to. A replayed batch changes none of them.
    """

    counts: StreamTable
    results: StreamTable
    runs: Ledger
    reference: DataFrame
    numeric: list[str]
    categorical: list[str]
    threshold: float

    @classmethod
    def at(cls, folder: str, reference: DataFrame, numeric: list[str], categorical: list[str], threshold: float) -> DriftWatch:
        """The watch whose state lies in a folder; the reference is counted there if it is not yet."""
        spark = reference.sparkSession
        counted = value_counts(reference, numeric, categorical)
        once = StreamTable(spark, f"{folder}/reference", counted.schema)
        once.apply(counted, 0)
        return cls(
            StreamTable(spark, f"{folder}/counts", counted.schema, ("column", "number", "text"), "add"),
            StreamTable(spark, f"{folder}/results", DRIFT_SCHEMA),
            Ledger(spark, f"{folder}/retraining"), once.read(), numeric, categorical, threshold)

    def check(self, batch: DataFrame, batch_id: int) -> bool:
        """Add a batch and compare the whole log; true if it calls for retraining."""
        self.counts.apply(value_counts(batch, self.numeric, self.categorical), batch_id)
        if not self.results.holds(batch_id):
            logged = self.counts.read(batch_id)
            report = drift_report_of_counts(self.reference, logged, bool(self.numeric), bool(self.categorical))
            # Log rows by the column that is known in most of them.
            rows = logged.groupBy("column").agg(F.sum("rows").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).scalar()
            summary = drift_summary(report, self.threshold).withColumns({"log_rows": rows, "batch": F.lit(batch_id)})
            self.results.apply(summary, batch_id)
        return bool(self.results.read(batch_id).where(F.col("batch") == batch_id).first()["requires_retraining"])  # one row


def start_drift_checks(
    log: DataFrame, watch: DriftWatch, folder: str, retrain: Callable[[int], dict] | None = None, trigger: dict | None = None,
    keep: StreamTable | None = None,
):
    """Check the log so far after every batch of records. ``retrain(batch)`` is called when the
    share of drifted columns is above the threshold, until a run of it is committed for the batch,
    and returns what to record. ``keep`` is a log table to which the records are added first."""
    def check(batch: DataFrame, batch_id: int) -> None:
        if keep:
            keep.apply(batch, batch_id)
        if watch.check(batch, batch_id) and retrain:
            watch.runs.once(batch_id, retrain)

    return (
        log.writeStream.foreachBatch(check).option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**(trigger or {"processingTime": DRIFT_INTERVAL})).start()
    )
