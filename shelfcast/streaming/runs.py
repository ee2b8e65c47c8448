"""Sources, sinks and one-shot runs of streaming queries.

Sinks are files in the shared checkpoint folder, so a restarted query goes on where it
stopped and nothing is kept on the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfcast.session import shared_folder
from shelfcast.sources.files import append_parquet
from shelfcast.streaming.tables import StreamTable

LATENESS = "10 minutes"


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Rows of new Parquet files in a folder, or of the files with that name in theirs."""
    reader = spark.readStream.schema(schema)
    if path.endswith(".parquet"):
        path, name = path.rsplit("/", 1)
        reader = reader.option("pathGlobFilter", name)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def on_time(events: DataFrame, time: str = "ts", lateness: str = LATENESS) -> DataFrame:
    """Rows later than ``lateness`` behind the newest may be dropped by stateful operators."""
    return events.withWatermark(time, lateness)


def once_each(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Drop repeats of an event id that arrive within the lateness: replaying a log counts once."""
    return events.dropDuplicatesWithinWatermark([key])


def run_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/streams/{name}-{uuid.uuid4().hex}"


def start_files(stream: DataFrame, folder: str, trigger: dict | None = None):
    """Append finished rows to ``folder/rows``."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def keyed_table(stream: DataFrame, folder: str, keys: tuple[str, ...]) -> StreamTable:
    return StreamTable(stream.sparkSession, f"{folder}/table", stream.schema, keys, "latest")


def start_table(stream: DataFrame, folder: str, keys: tuple[str, ...] = (), trigger: dict | None = None):
    """Keep ``keyed_table`` at the newest row of every key: a batch adds the rows that changed, and
    readers see the table as of a whole batch. Without keys the table is one row."""
    table = keyed_table(stream, folder, keys)
    return _start_batches(stream, folder, lambda batch, batch_id: table.apply(batch, batch_id), trigger, "update")


def start_log(stream: DataFrame, folder: str, trigger: dict | None = None):
    """Append every batch to the log ``folder/log``, where it counts once and only when it is whole."""
    log = StreamTable(stream.sparkSession, f"{folder}/log", stream.schema)
    return _start_batches(stream, folder, lambda batch, batch_id: log.apply(batch, batch_id), trigger, "append")


def _start_batches(stream: DataFrame, folder: str, work, trigger: dict | None, mode: str):
    return (
        stream.writeStream.outputMode(mode).foreachBatch(work).option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def run_arrivals(parts: list[DataFrame], folder: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Let tables arrive one after the other under ``folder/arrived`` and run the query that
    ``start(stream)`` starts to its end after each, from where it stopped: a batch for each part."""
    for part in parts:
        append_parquet(part, f"{folder}/arrived")
        start(read_stream(part.sparkSession, f"{folder}/arrived", part.schema)).awaitTermination()


def run_to_end(stream: DataFrame, name: str, start=start_files) -> DataFrame:
    """Process everything available now and return the rows the query wrote."""
    spark = stream.sparkSession
    folder = run_folder(spark, name)
    start(stream, folder).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def run_to_table(stream: DataFrame, name: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """As ``run_to_end`` for a result with one row per key."""
    folder = run_folder(stream.sparkSession, name)
    start_table(stream, folder, keys).awaitTermination()
    return keyed_table(stream, folder, keys).read()
