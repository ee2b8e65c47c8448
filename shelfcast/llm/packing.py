"""Packing of tokenized documents into fixed windows by best-fit decreasing.

A document's ids are cut into full windows and one rest. Pieces are dealt by hash into bins of
about ``BIN`` pieces. Inside a bin they go longest first into the open window with the least
room that still holds them; a segment tree over the remaining capacity finds it. A bin with
thousands of pieces leaves hardly any room unused, so the bins need not know of each other, and
their number grows with the corpus. A bin carries lengths and places only, never ids.

Null and empty texts are one piece that holds only the closing id. Repeated rows are pieces of
their own. An empty table gives an empty table. Ties are ordered by identifier, start and
checksum; equal rows are interchangeable. Extra columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.columns import blocks, texts_only
from shelfcast.llm.wordpieces import WordIds as WordIds
from shelfcast.llm.wordpieces import run_ids
from shelfcast.session import written

WINDOW = 4096
END_ID = 2
BIN = 8192


def pieces(
    docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID,
) -> DataFrame:
    """Pieces of at most ``window`` ids: start, length, the ids as little-endian unsigned 32-bit
    integers, and the number of ids of the document. Each document ends with ``end_id``."""
    source = texts_only(docs, id_column, text)
    kind = source.schema[0].dataType.simpleString()
    names = [id_column, "start", "length", "ids", "doc_tokens"]
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        for batch in batches:
            for low, high, _, data, offsets in blocks(batch.column(1)):
                bounds, flat = offsets.tolist(), data.tobytes()
                rows: list[list] = [[], [], [], [], []]
                for k, ids in enumerate(run_ids(path).encode([flat[a:b] for a, b in zip(bounds, bounds[1:])])):
                    ids += end
                    for at in range(0, len(ids), 4 * window):
                        part = ids[at:at + 4 * window]
                        for column, value in zip(rows, (low + k, at // 4, len(part) // 4, part, len(ids) // 4)):
                            column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows[0], pa.int64()))] + [pa.array(v, t) for v, t in zip(rows[1:], kinds)], names=names)

    return source.mapInArrow(run, f"`{id_column}` {kind}, start bigint, length bigint, ids binary, doc_tokens bigint")


class OpenWindows:
    """Open windows by remaining capacity; a segment tree counts them over ranges of capacity."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, by: int) -> None:
        node = capacity + self.size
        while node:
            self.tree[node] += by
            node >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        self._add(capacity, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return (capacity, window) of the tightest window with that much room."""
        tree, node = self.tree, length + self.size
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        capacity = node - self.size
        self._add(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int]]:
    """Window and offset of every piece; lengths come in descending order."""
    held, windows, offsets, count = OpenWindows(window), [], [], 0
    for length in lengths:
        found = held.take(length)
        if found is None:
            found = window, count
            count += 1
        capacity, at = found
        windows.append(at)
        offsets.append(window - capacity)
        if capacity > length:
            held.put(capacity - length, at)
    return windows, offsets


def place(parts: DataFrame, order: list[str], window: int = WINDOW, per_bin: int = BIN) -> DataFrame:
    """The rows, which have a ``length`` of at most ``window``, with ``sequence_id`` and
    ``offset``. ``order`` names columns that tell pieces of equal length apart. The number of
    bins comes from a count, so give rows that are written already."""
    bins = max(1, -(-parts.count() // per_bin))
    schema = parts.schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", *order], ascending=[False] + [True] * len(order), kind="stable")
        windows, offsets = best_fit(pdf["length"].tolist(), window)
        return pdf.drop(columns="__bin").assign(sequence_id=(int(key[0]) << 32) + np.array(windows, dtype=np.int64), offset=offsets)

    return parts.withColumn("__bin", F.pmod(F.xxhash64("length", *order), F.lit(bins))).groupBy("__bin").applyInPandas(
        run, f"{fields}, sequence_id bigint, offset bigint")


def pack(
    docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID,
) -> DataFrame:
    """All pieces of all documents with their place, without the ids: identifier, start, length,
    ids_crc32, doc_tokens, sequence_id, offset."""
    cut = pieces(docs, path, id_column, text, window, end_id)
    crc = cut.select(id_column, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return place(written(crc, "pieces"), [id_column, "start", "ids_crc32"], window)


def sequences(placed: DataFrame, cut: DataFrame, id_column: str = "doc_id", window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """One row for each window: its ids padded to the window, or to the exact length where that
    is a power of two, and how many of them are not padding. ``placed`` comes from ``pack`` and
    ``cut`` from ``pieces`` of the same documents, whose identifiers are unique."""
    keyed = placed.select(id_column, "start", "sequence_id", "offset")
    rows = cut.join(keyed, [id_column, "start"])

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(b"".join(pdf.sort_values("offset")["ids"]), dtype="<u4")
        width = len(ids) if len(ids) & (len(ids) - 1) == 0 else window
        full = np.full(width, pad_id, dtype="<u4")
        full[:len(ids)] = ids
        return pd.DataFrame({"sequence_id": [key[0]], "ids": [full.tobytes()], "n_tokens": [len(ids)]})

    return rows.groupBy("sequence_id").applyInPandas(run, "sequence_id bigint, ids binary, n_tokens bigint")
