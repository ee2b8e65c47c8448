"""Vectors as short codes: parts of a vector by their nearest codebook entries, by ball k-means.

An entry's ball holds the parts assigned to it. Other entries matter to a ball only if half their
distance is within its radius; these are its neighbours, nearest first. A part no farther from its
entry than half the way to the nearest neighbour lies in the stable core and is not compared at
all; a part in a ring beyond is compared with just the neighbours whose half way it reaches. A
ball whose entry and neighbours all stayed where they were is left alone for the round.

Components are whole numbers, so distances are exact and every pruning test errs to the safe side:
the codes are those of comparing every part with every entry.

Rows stay where they are: a round reads a table of vectors and codes and writes the next, and sums
its balls by partial aggregation. The codebooks, their sums and radii are all that reaches the driver,
a number for each entry and component. The table of the round before is dropped when the next is whole.

Null vectors and vectors that hold null or non-finite numbers are left out. Shorter vectors, and
lengths that the parts do not divide, are filled up with zeros. Fewer kept rows than entries make
smaller codebooks. Repeated rows count as often as they occur, also among the first entries; null
identifiers come after all others there. Products with the scale count up to 2**27 in size. An
empty table gives an empty table. Extra columns are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.vectors import lists, matrix, whole_numbers
from shelfcast.session import forget, written

LIMIT = 1 << 27
SAFE = 1 + 1e-9  # pruning distances are this much longer, for what floats lose


@dataclass
class Balls:
    """The entries of one part position, and what is known of their balls."""

    centres: np.ndarray           # entries x components
    radius: np.ndarray            # of each ball around its entry, or more
    near: list[list[int]]         # neighbours of each entry, nearest first
    apart: np.ndarray             # squared distances between entries
    settled: np.ndarray           # balls no part can leave or join

    @classmethod
    def first(cls, centres: np.ndarray) -> Balls:
        """All parts in the first ball, of unknown size."""
        return cls.around(centres, np.full(len(centres), np.inf), np.ones(len(centres), dtype=bool))

    @classmethod
    def around(cls, centres: np.ndarray, radius: np.ndarray, moved: np.ndarray) -> Balls:
        apart = ((centres[:, None] - centres[None]) ** 2).sum(axis=2)
        near, settled = [], np.zeros(len(centres), dtype=bool)
        for i in range(len(centres)):
            order = [int(j) for j in np.lexsort((np.arange(len(centres)), apart[i])) if j != i]
            near.append([j for j in order if np.sqrt(float(apart[i, j])) <= 2 * radius[i] * SAFE])
            settled[i] = not moved[i] and not any(moved[j] for j in near[i])
        return cls(centres, radius, near, apart, settled)

    def assign(self, parts: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The nearest entry of every part, ties to the lower one; ``own`` are the entries before."""
        new = own.copy()
        for i, centre in enumerate(self.centres):
            if self.settled[i] or not self.near[i]:
                continue
            rows = np.flatnonzero(own == i)
            home = ((parts[rows] - centre) ** 2).sum(axis=1)
            reach = 4.0 * home * SAFE
            best, at = home.copy(), np.full(len(rows), i)
            inside = np.arange(len(rows))
            for j in self.near[i]:
                inside = inside[reach[inside] >= self.apart[i, j]]  # rings get narrower
                if not len(inside):
                    break
                away = ((parts[rows[inside]] - self.centres[j]) ** 2).sum(axis=1)
                closer = (away < best[inside]) | ((away == best[inside]) & (j < at[inside]))
                best[inside[closer]], at[inside[closer]] = away[closer], j
            new[rows] = at
        return new

    def updated(self, counts: list[int], sums: list[list[int]], farthest: list[int]) -> Balls:
        """The entries moved to the floored means of their parts; unused ones stay."""
        centres = self.centres.copy()
        for i, n in enumerate(counts):
            if n:
                centres[i] = [s // n for s in sums[i]]
        shift = np.sqrt(((centres - self.centres) ** 2).sum(axis=1).astype(np.float64))
        return Balls.around(centres, (np.sqrt(np.array(farthest, dtype=np.float64)) + shift) * SAFE, shift > 0)


def _assigned(rows: DataFrame, balls: list[Balls]) -> DataFrame:
    """The rows with the codes of this round, by the codes of the round before."""
    parts = len(balls)

    def run(batches):
        for batch in batches:
            x = matrix(batch.column("x")).reshape(batch.num_rows, parts, -1)
            own = np.frombuffer(b"".join(batch.column("codes").to_pylist()), dtype=np.uint8).reshape(-1, parts)
            codes = np.stack([b.assign(x[:, p], own[:, p]) for p, b in enumerate(balls)], axis=1).astype(np.uint8)
            flat = pa.Array.from_buffers(pa.binary(parts), len(codes), [None, pa.py_buffer(np.ascontiguousarray(codes))])
            yield batch.set_column(batch.schema.get_field_index("codes"), "codes", flat.cast(pa.binary()))

    return rows.mapInArrow(run, rows.schema)


def _summed(rows: DataFrame, balls: list[Balls]) -> DataFrame:
    """(part, entry, place, total, n, far): sums of the parts of every ball, how many there are, and
    the largest squared distance from the entry."""
    parts = len(balls)

    def run(batches):
        totals: dict[tuple[int, int], list] = {}
        for batch in batches:
            x = matrix(batch.column("x")).reshape(batch.num_rows, parts, -1)
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), dtype=np.uint8).reshape(-1, parts)
            for p, ball in enumerate(balls):
                far = ((x[:, p] - ball.centres[codes[:, p]]) ** 2).sum(axis=1)
                order = np.argsort(codes[:, p], kind="stable")
                used, starts = np.unique(codes[order, p], return_index=True)
                sums = np.add.reduceat(x[order, p], starts, axis=0)
                most, n = np.maximum.reduceat(far[order], starts), np.diff([*starts, len(order)])
                for k, entry in enumerate(used.tolist()):
                    held = totals.setdefault((p, entry), [np.zeros(x.shape[2], dtype=np.int64), 0, 0])
                    held[0] += sums[k]
                    held[1] += int(n[k])
                    held[2] = max(held[2], int(most[k]))
        found = [(p, e, at, int(t), n, far) for (p, e), (total, n, far) in totals.items() for at, t in enumerate(total)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * 6)], names=["part", "entry", "place", "total", "n", "far"])

    partial = rows.mapInArrow(run, "part bigint, entry bigint, place bigint, total bigint, n bigint, far bigint")
    return partial.groupBy("part", "entry", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.max("far").alias("far"))


def codebooks(rows: DataFrame, width: int, parts: int, entries: int, rounds: int) -> tuple[DataFrame, list[Balls]]:
    """The rows with their last codes, and the codebooks: (id, label, x) in, ``codes`` added."""
    first = rows.orderBy(F.asc_nulls_last("id"), "x").limit(entries).select("x").collect()
    start = np.array([r["x"] for r in first], dtype=np.int64).reshape(len(first), parts, width // parts)
    balls = [Balls.first(start[:, p]) for p in range(parts)]
    state = rows.withColumn("codes", F.lit(bytes(parts)))
    for _ in range(rounds):
        before, state = state, written(_assigned(state, balls), "codes")
        forget(before)
        counts = [[0] * len(first) for _ in balls]
        farthest = [[0] * len(first) for _ in balls]
        sums = [[[0] * (width // parts) for _ in first] for _ in balls]
        for r in _summed(state, balls).collect():  # entries x components
            sums[r["part"]][r["entry"]][r["place"]] = int(r["total"])
            counts[r["part"]][r["entry"]], farthest[r["part"]][r["entry"]] = int(r["n"]), r["far"]
        balls = [b.updated(n, s, f) for b, n, s, f in zip(balls, counts, sums, farthest)]
    return _assigned(state, balls), balls


def compress(
    df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", group: str = "label", parts: int = 8, entries: int = 16,
    rounds: int = 6, scale: float = 4096.0,
) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, label, codes, error) of every kept row, and the codebook of every part position.

    ``codes`` has a byte for each part; ``error`` is the squared distance of the vector from its
    entries. ``entries`` is 256 at most.
    """
    rows, width = whole_numbers(df, vector, scale, 0, LIMIT, parts, {id_column: "id", group: "label"})
    if not width:  # no rows, or none with components
        empty = rows.select("id", "label", F.lit(bytes(parts)).alias("codes"), F.lit(0).cast("bigint").alias("error"))
        return empty, [np.zeros((min(entries, rows.count()), 0), dtype=np.int64)] * parts
    coded, balls = codebooks(rows, width, parts, entries, rounds)
    books = [b.centres for b in balls]

    def run(batches):
        for batch in batches:
            x = matrix(batch.column("x")).reshape(batch.num_rows, parts, -1)
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), dtype=np.uint8).reshape(-1, parts)
            error = sum(((x[:, p] - book[codes[:, p]]) ** 2).sum(axis=1) for p, book in enumerate(books))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "label", "codes")), pa.array(error, pa.int64())], names=["id", "label", "codes", "error"])

    schema = coded.select("id", "label", "codes", F.lit(0).cast("bigint").alias("error")).schema
    return written(coded.mapInArrow(run, schema), "coded"), books


def decoded(coded: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """The rows with ``x``, the whole numbers that their codes stand for."""
    def run(batches):
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), dtype=np.uint8).reshape(-1, len(books))
            x = np.concatenate([book[codes[:, p]] for p, book in enumerate(books)], axis=1)
            yield batch.append_column("x", lists(x))

    return coded.mapInArrow(run, coded.withColumn("x", F.array(F.lit(0).cast("bigint"))).schema)


def with_group_error(coded: DataFrame) -> DataFrame:
    """The rows with ``label_error``: the error of all rows of their label, nulls together. The sums
    are a table of one row per label, whose known size decides how it is joined."""
    totals = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "label_errors")
    return coded.join(totals, coded["label"].eqNullSafe(totals["of"])).drop("of")


def digest(books: list[np.ndarray]) -> str:
    """sha256 of all entries' numbers by part, entry and place."""
    return hashlib.sha256(",".join(str(v) for book in books for v in book.reshape(-1).tolist()).encode()).hexdigest()
