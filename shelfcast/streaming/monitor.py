"""Monitoring metrics as streaming queries, on the same expressions as the batch ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators import monitor
from shelfcast.schemas import EVENT_SCHEMA
from shelfcast.streaming.runs import on_time, once_each, read_stream, run_to_end, run_to_table, start_files


def request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return on_time(monitor.requests_from(read_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet", EVENT_SCHEMA)))


def error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_to_end(monitor.error_rate_windows(request_stream(spark, sf_dir)), "error-rate", start_files)


def request_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_to_end(monitor.request_rate(request_stream(spark, sf_dir)), "request-rate", start_files)


def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_to_end(monitor.latency_buckets(request_stream(spark, sf_dir)), "latency", start_files)


def latest_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_to_table(monitor.latest_value(request_stream(spark, sf_dir)), "latest", ("key",))


def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_to_table(monitor.outcome_counts(request_stream(spark, sf_dir)), "outcomes")


def distinct_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request log with replayed ids dropped."""
    return run_to_end(once_each(request_stream(spark, sf_dir)), "distinct", start_files)
