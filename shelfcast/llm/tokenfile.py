"""Token ids of a corpus as flat unsigned integer files with 64-bit document offsets.

A folder holds, for every part p of the corpus in order of the identifier:

* ``ids-p.bin``: the ids of its documents one after another, little-endian unsigned integers of 16
  bits, or of 32 where the vocabulary needs them;
* ``offsets-p.bin``: for each document the number of ids of the whole corpus before it, and the end
  of the last one, little-endian signed 64-bit integers;
* ``docs-p.arrow``: the identifiers, an Arrow file;

and ``manifest``, a Parquet table with a row for each part: part, width (bytes of an id), docs, ids,
first_doc and first_id (what lies before the part). Readers map the files into memory.

Texts are dealt by ranges of the identifier, encoded in order and written as they come, so a task
holds one block of documents. A part knows its place only when all parts are counted:
the prefix sums run over the manifest, one row a part, and a second pass over the lengths writes
the offsets. All files are written under a draft name and renamed, so a repeated task replaces a
file by the same bytes.

Null and empty texts are documents of the closing id alone. Null identifiers come first. Documents
that share an identifier are ordered by their texts' hash; repeated rows are documents of their own,
and any number of them is dealt over several parts. An empty table gives a manifest without rows.
Extra columns are dropped, whatever their names.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.columns import blocks, texts_only
from shelfcast.llm.store import _local as mounted
from shelfcast.llm.wordpieces import run_ids
from shelfcast.session import shared_folder, written

END_ID = 2
PART_BYTES = 64 << 20  # of a file of ids, about
CHUNK = 1 << 20        # ids read or lengths summed at once
MANIFEST = "part bigint, width int, docs bigint, ids bigint"


@lru_cache(maxsize=2)
def id_width(path: str, end_id: int = END_ID) -> int:
    """Bytes of an id: two if all ids of the vocabulary fit, else four."""
    from tokenizers import Tokenizer

    most = max([end_id, *Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()])
    return 2 if most < 1 << 16 else 4


@contextmanager
def output(folder: str, name: str):
    """A file to write; it gets its name only when it is whole."""
    path = mounted(folder)
    if path is None:  # an object store shows a file once it is closed
        store, path = fs.FileSystem.from_uri(folder)
        with store.open_output_stream(f"{path}/{name}") as file:
            yield file
        return
    os.makedirs(path, exist_ok=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with open(draft, "wb") as file:
        yield file
    os.replace(draft, f"{path}/{name}")


class Flat:
    """Integers of a file: mapped into memory where the folder is mounted, else read by ranges."""

    def __init__(self, folder: str, name: str, kind: str):
        self.kind, path = np.dtype(kind), mounted(folder)
        if path is None:
            store, path = fs.FileSystem.from_uri(folder)
            self.file = store.open_input_file(f"{path}/{name}")
            self.array = None
        else:
            empty = os.path.getsize(f"{path}/{name}") == 0
            self.array = np.zeros(0, self.kind) if empty else np.memmap(f"{path}/{name}", dtype=self.kind, mode="r")

    def __getitem__(self, span: slice) -> np.ndarray:
        if self.array is not None:
            return self.array[span]
        self.file.seek(span.start * self.kind.itemsize)
        return np.frombuffer(self.file.read((span.stop - span.start) * self.kind.itemsize), dtype=self.kind)


def identifiers(folder: str, part: int) -> Iterator[pa.Array]:
    """The identifiers of a part, batch by batch."""
    path = mounted(folder)
    if path is None:
        store, path = fs.FileSystem.from_uri(folder)
        source = store.open_input_file(f"{path}/docs-{part:08d}.arrow")
    else:
        source = pa.memory_map(f"{path}/docs-{part:08d}.arrow")
    with source, pa.ipc.open_file(source) as reader:
        for k in range(reader.num_record_batches):
            yield reader.get_batch(k).column(0)


def encoded(path: str, texts: pa.Array, width: int, end_id: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """Rows from, rows to, and the flat ids of those texts, ``end_id`` at the end of each."""
    end = np.array([end_id], dtype="<u4").tobytes()
    for low, high, _, data, offsets in blocks(texts):
        bounds, flat = offsets.tolist(), data.tobytes()
        made = [ids + end for ids in run_ids(path).encode([flat[a:b] for a, b in zip(bounds, bounds[1:])])]
        yield low, high, made if width == 4 else [np.frombuffer(ids, "<u4").astype("<u2").tobytes() for ids in made]


def write(
    docs: DataFrame, path: str, folder: str | None = None, id_column: str = "doc_id", text: str = "text", end_id: int = END_ID,
    part_bytes: int = PART_BYTES,
) -> str:
    """Write the files of all documents, which come from a stored table, and return their folder, a
    new one in the shared folder by default. The number of parts follows from the length of the
    texts, which have about four bytes an id, and is at least the number of shuffle partitions."""
    source, width = texts_only(docs, id_column, text), id_width(path, end_id)
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    size = source.agg(F.sum(F.octet_length(text).cast("bigint") + 4)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size * width // (4 * part_bytes)))
    # The row's number only spreads equal rows; it is the same whenever the table is read.
    order = [id_column, "__hash", "__row"]
    named = source.select(
        id_column, F.col(text).alias("text"), F.xxhash64(text).alias("__hash"), F.monotonically_increasing_id().alias("__row"))
    dealt = named.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(id_column, "text")

    def run(batches):
        part, n_docs, n_ids = TaskContext.get().partitionId(), 0, 0
        with output(folder, f"ids-{part:08d}.bin") as flat, output(folder, f"lengths-{part:08d}.bin") as lengths, \
                output(folder, f"docs-{part:08d}.arrow") as names:
            writer = None
            for batch in batches:
                for low, high, made in encoded(path, batch.column(1), width, end_id):
                    flat.write(b"".join(made))
                    sizes = np.array([len(ids) // width for ids in made], dtype="<i8")
                    lengths.write(sizes.tobytes())
                    block = pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low)], names=["id"])
                    writer = writer or pa.ipc.new_file(names, block.schema)
                    writer.write_batch(block)
                    n_docs, n_ids = n_docs + len(made), n_ids + int(sizes.sum())
            if writer:
                writer.close()
        if n_docs:
            yield pa.RecordBatch.from_pydict({"part": [part], "width": pa.array([width], pa.int32()), "docs": [n_docs], "ids": [n_ids]})

    counted = written(dealt.mapInArrow(run, MANIFEST), "parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    placed = counted.withColumns({f"first_{c[:-1]}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("docs", "ids")})

    def offsets(batches):
        for batch in batches:
            for part, docs, first in zip(*(batch.column(c).to_pylist() for c in ("part", "docs", "first_id"))):
                lengths, at = Flat(folder, f"lengths-{part:08d}.bin", "<i8"), first
                with output(folder, f"offsets-{part:08d}.bin") as file:
                    file.write(np.array([at], dtype="<i8").tobytes())
                    for low in range(0, docs, CHUNK):
                        ends = at + np.cumsum(lengths[low:min(docs, low + CHUNK)])
                        file.write(ends.astype("<i8").tobytes())
                        at = int(ends[-1])
            yield batch

    spread = placed.repartition(max(1, counted.count()))
    spread.mapInArrow(offsets, placed.schema).write.parquet(f"{folder}/manifest")
    return folder


def read(spark: SparkSession, folder: str, id_column: str = "doc_id") -> DataFrame:
    """The documents of a folder: identifier, ``start`` (ids of the corpus before it), ``n_tokens``
    and ``ids`` as little-endian unsigned 32-bit integers. Every part is read by a task of its own."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    parts = manifest.count()
    if not parts:
        return spark.createDataFrame([], f"`{id_column}` bigint, start bigint, n_tokens bigint, ids binary")
    kind = manifest.orderBy("part").limit(1).mapInArrow(_kind(folder), "kind string").first()[0]

    def run(batches):
        for batch in batches:
            for part, width, first in zip(*(batch.column(c).to_pylist() for c in ("part", "width", "first_id"))):
                flat, places, at = Flat(folder, f"ids-{part:08d}.bin", f"<u{width}"), Flat(folder, f"offsets-{part:08d}.bin", "<i8"), 0
                for names in identifiers(folder, part):
                    starts = places[at:at + len(names) + 1]
                    at, low = at + len(names), 0
                    while low < len(names):  # documents of about CHUNK ids, or one longer document
                        high = max(low + 1, int(np.searchsorted(starts, starts[low] + CHUNK, "right")) - 1)
                        data = flat[int(starts[low] - first):int(starts[high] - first)].astype("<u4")
                        ends = 4 * (starts[low:high + 1] - starts[low])
                        ids = pa.Array.from_buffers(
                            pa.large_binary(), high - low, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
                        yield pa.RecordBatch.from_arrays(
                            [names.slice(low, high - low), pa.array(starts[low:high], pa.int64()),
                             pa.array(np.diff(starts[low:high + 1]), pa.int64()), ids.cast(pa.binary())],
                            names=[id_column, "start", "n_tokens", "ids"])
                        low = high

    return manifest.repartition(parts).mapInArrow(run, f"`{id_column}` {kind}, start bigint, n_tokens bigint, ids binary")


def _kind(folder: str):
    """Spark's name of the identifiers' type, from the file of a part."""
    from pyspark.sql.pandas.types import from_arrow_type

    def run(batches):
        for batch in batches:
            for part in batch.column("part").to_pylist():
                names = next(identifiers(folder, part))
                yield pa.RecordBatch.from_pydict({"kind": [from_arrow_type(names.type).simpleString()]})

    return run
