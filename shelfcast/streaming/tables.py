"""Tables that a stream keeps up to date and readers see whole.

A table is a folder. Every batch writes a folder of its own under ``rows`` and is then committed by
one small marker file, created only if it is not there yet. Readers list the markers and read the
folders they name: rows of a failed or running batch are never seen, a replayed batch is recognised
by its marker and writes nothing, and no committed file is ever replaced.

``merge`` says what several rows of a key mean:

* ``append``: the table is a log, all rows count;
* ``latest``: the row of the newest batch counts;
* ``add``: the numbers are added up.

Keyed tables are compacted: every so many batches the current rows are written as a base, with a
marker of its own, and readers start from the newest base. ``vacuum`` removes what lies before the
base before, so whoever reads the last version can finish.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPACT_EVERY = 10
BATCH = "_batch"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def mark(spark: SparkSession, path: str, content: str = "") -> bool:
    """Create a small file; false if it is there already."""
    store, place = _place(spark, path)
    if store.exists(place):
        return False
    try:
        file = store.create(place, False)
    except Exception as error:  # another run was faster
        if store.exists(place):
            return False
        raise error
    file.write(bytearray(content.encode()))
    file.close()
    return True


def marks(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder, in order; none if there is no folder."""
    store, place = _place(spark, folder)
    return sorted(s.getPath().getName() for s in store.listStatus(place)) if store.exists(place) else []


def content(spark: SparkSession, path: str) -> str:
    return "".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())  # one small file


def remove(spark: SparkSession, path: str) -> None:
    store, place = _place(spark, path)
    store.delete(place, True)


@dataclass(frozen=True)
class StreamTable:
    """A table of rows with ``schema`` under ``folder``; ``keys`` identify a row unless it is a log; without
    keys a ``latest`` or ``add`` table has one row."""

    spark: SparkSession
    folder: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    merge: str = "append"
    compact_every: int = COMPACT_EVERY

    def __post_init__(self):
        if self.merge not in ("append", "latest", "add") or self.merge == "append" and self.keys:
            raise ValueError(f"merge {self.merge!r} with keys {self.keys}")

    def _rows(self, batch: int) -> str:
        return f"{self.folder}/rows/{BATCH}={batch}"

    def _base(self, batch: int) -> str:
        return f"{self.folder}/bases/upto={batch}"

    def batches(self) -> list[int]:
        """Committed batches, in order, as far as they are still there one by one."""
        return [int(n) for n in marks(self.spark, f"{self.folder}/commits")]

    def bases(self) -> list[int]:
        return [int(n) for n in marks(self.spark, f"{self.folder}/base_commits")]

    def holds(self, batch: int) -> bool:
        """Is this batch in the table? Batches come in order, so a base holds all up to its own."""
        return batch in self.batches() or any(b >= batch for b in self.bases())

    def apply(self, rows: DataFrame, batch: int) -> bool:
        """Write a batch and commit it; false, and nothing written, if the table holds it."""
        if self.holds(batch):
            return False
        wanted = rows.select(*(F.col(f.name).cast(f.dataType) for f in self.schema.fields))
        wanted.write.mode("overwrite").parquet(self._rows(batch))  # replaces what a failed attempt left
        mark(self.spark, f"{self.folder}/commits/{batch:020d}")
        if self.merge != "append" and len([b for b in self.batches() if b > max(self.bases(), default=-1)]) >= self.compact_every:
            self.compact()
        return True

    def compact(self) -> None:
        """Write the current rows as a base up to the newest batch."""
        newest = max(self.batches())
        if newest in self.bases():
            return
        self.read(newest).write.mode("overwrite").parquet(self._base(newest))
        mark(self.spark, f"{self.folder}/base_commits/{newest:020d}")

    def vacuum(self) -> None:
        """Remove bases and batches that lie before the last base but one."""
        bases = self.bases()
        if len(bases) < 2:
            return
        for base in bases[:-2]:
            remove(self.spark, f"{self.folder}/base_commits/{base:020d}")
            remove(self.spark, self._base(base))
        for batch in self.batches():
            if batch <= bases[-2]:
                remove(self.spark, f"{self.folder}/commits/{batch:020d}")
                remove(self.spark, self._rows(batch))

    def read(self, upto: int | None = None) -> DataFrame:
        """The table as of a batch, the newest by default."""
        bases = [b for b in self.bases() if upto is None or b <= upto] if self.merge != "append" else []
        base = max(bases, default=-1)
        later = [b for b in self.batches() if b > base and (upto is None or b <= upto)]
        reader = self.spark.read.schema(self.schema)
        parts = [reader.parquet(self._base(base)).withColumn(BATCH, F.lit(base).cast("bigint"))] if base >= 0 else []
        if later:
            parts.append(self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())]))
                         .option("basePath", f"{self.folder}/rows").parquet(*map(self._rows, later)))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = reduce(DataFrame.unionByName, parts)
        values = [f.name for f in self.schema.fields if f.name not in self.keys]
        if self.merge == "latest":
            rows = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), BATCH).alias("_row")).select(*self.keys, "_row.*")
        elif self.merge == "add":
            rows = rows.groupBy(*self.keys).agg(*(F.sum(v).alias(v) for v in values))
        return rows.select(*(F.col(f.name).cast(f.dataType) for f in self.schema.fields))


@dataclass(frozen=True)
class Ledger:
    """Work that is done once for a batch, whatever fails in between.

    A batch is claimed, worked on and committed with its outcome. A replay of a committed batch
    gets the recorded outcome; one that was claimed but not committed is worked on again, so the
    work writes under the batch's own number and counts only when the commit names it.
    """

    spark: SparkSession
    folder: str

    def outcome(self, batch: int) -> dict | None:
        name = f"{batch:020d}"
        if name not in marks(self.spark, f"{self.folder}/commits"):
            return None
        return json.loads(content(self.spark, f"{self.folder}/commits/{name}"))

    def once(self, batch: int, work) -> dict:
        """The outcome of ``work(batch)``, a small dict, done at most once per commit."""
        done = self.outcome(batch)
        if done is None:
            mark(self.spark, f"{self.folder}/claims/{batch:020d}")
            mark(self.spark, f"{self.folder}/commits/{batch:020d}", json.dumps(work(batch)))
            done = self.outcome(batch)
        return done

    def unfinished(self) -> list[int]:
        """Batches that were claimed and not committed: a crash in between."""
        done = set(marks(self.spark, f"{self.folder}/commits"))
        return [int(n) for n in marks(self.spark, f"{self.folder}/claims") if n not in done]

    def outcomes(self) -> list[dict]:
        """All outcomes in order of their batches, one small file each."""
        return [json.loads(content(self.spark, f"{self.folder}/commits/{n}")) for n in marks(self.spark, f"{self.folder}/commits")]
