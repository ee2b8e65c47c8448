"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

# Settings that do not depend on the size of the cluster. Shuffle width, executor count and
# memory belong to the cluster's own configuration; AQE then fits partitions to the data.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Recording the Python call site of every column makes wide queries slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


_local_folders: dict[str, str] = {}


def build_session(app: str = "shelfcast", master: str | None = None, **conf: str) -> SparkSession:
    """Get a session with the defaults above. Keyword names use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="shelfcast-")
    return _local_folders[application]


def with_checkpoints(spark: SparkSession) -> None:
    """Checkpoints of this session go to the shared folder, if nothing else was set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there."""
    with_checkpoints(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str, rows: int = 0) -> DataFrame:
    """The rows from a table written to the shared folder: for results that several queries
    read, so that they are computed once and outlive lost executors. With ``rows``, a file has no more."""
    path = f"{shared_folder(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, column: str) -> DataFrame:
    """The rows from a table in the shared folder that is dealt by a column, in as many buckets as a
    shuffle has parts: a join on the column moves the other side only. Texts are packed tightly."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.format("parquet").option("path", f"{shared_folder(spark)}/tables/{table}").option("compression", "zstd")
    writer.bucketBy(buckets, column).saveAsTable(table)
    return spark.table(table)


def forget(table: DataFrame) -> None:
    """Delete what ``written`` or ``bucketed`` wrote for this table, once nothing will read it again. Rows
    that come from elsewhere, or from several tables, are left alone."""
    spark = table.sparkSession
    root = f"{shared_folder(spark)}/tables/"
    folders = {file.rsplit("/", 1)[0] for file in table.inputFiles()}
    path = next(iter(folders), "")
    if len(folders) != 1 or urlparse(path).path.rsplit("/", 1)[0] != urlparse(root).path.rstrip("/"):
        return
    spark.sql(f"drop table if exists `{path.rsplit('/', 1)[1]}`")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
