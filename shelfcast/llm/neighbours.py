"""Nearest neighbours by cosine, with stable projections and kd-trees.

Unit vectors are projected on a few random directions (2-stable: a squared projected distance is
the squared distance times a chi-square variable). The upper splits of a kd-tree over the
projections, fitted on a bounded sample, deal all vectors into cells; in a task, a kd-tree of its
own orders the vectors of a cell part. A query's candidates come in order of projected distance
and are verified exactly, until the chance that a vector as near as the worst kept one has a
larger projected distance is at most ``1 - sure``. Each query searches its own cell first; the
distance found there tells which other cells the same test still admits.

Equal vectors are indexed once with their smallest ids, as many as can be needed, so a vector
with any number of copies costs no more than one; equal queries are searched once.

Vectors that are null, zero, of another length than most, or hold null or non-finite components
take no part. Rows with equal ids are different rows: each is a query and a candidate of its own, and
a query leaves out only its own row; a null id takes no part.
Ties go to the smaller id. Fewer candidates than asked for are all returned. An empty table gives
an empty table. Other columns play no part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import written

DIRECTIONS = 8
SURE = 0.985
SAMPLE = 8192  # vectors that place the cells
PART = 8192  # vectors in one part of a cell, about
MOST_CELLS = 4096
LEAF = 128


def chi_square_above(x: float, degrees: int) -> float:
    """Chance that a chi-square variable with an even number of degrees exceeds x."""
    term = total = 1.0
    for k in range(1, degrees // 2):
        term *= x / 2 / k
        total += term
    return math.exp(-x / 2) * total


def chi_square_limit(chance: float, degrees: int) -> float:
    """The value exceeded with that chance."""
    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_above(middle, degrees) > chance else (low, middle)
    return high


@dataclass(frozen=True)
class Cells:
    """Directions, and the box of every cell in the projected space."""

    directions: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def project(self, vectors: np.ndarray) -> np.ndarray:
        return unit(vectors) @ self.directions

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of every point to every box."""
        out = np.empty((len(points), len(self.low)))
        for k, p in enumerate(points):
            gap = np.maximum(np.maximum(self.low - p, p - self.high), 0)
            out[k] = (gap * gap).sum(axis=1)
        return out

    def of(self, points: np.ndarray) -> np.ndarray:
        # Boxes share only their faces; a point on one goes to the first.
        return np.concatenate([self.distances(points[a:a + 256]).argmin(axis=1) for a in range(0, len(points), 256)] or [np.zeros(0, np.int64)])


def unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that very large or small components neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors))


def cosines(vectors: np.ndarray, norms: np.ndarray, query: np.ndarray, norm: float) -> np.ndarray:
    """Cosines in double precision on the vectors as given, from their lengths."""
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        found = np.einsum("ij,j->i", vectors, query) / (norms * norm)
    odd = ~(np.isfinite(found) & (norms > 0) & (norm > 0))
    if odd.any():  # too large or small to be squared
        found[odd] = unit(vectors[odd]) @ unit(query[None])[0]
    return found


def split(points: np.ndarray, parts: int) -> list[np.ndarray]:
    """Indices of the leaves of a kd-tree that halves the widest side until there are ``parts``."""
    leaves = [np.arange(len(points))]
    while len(leaves) < parts:
        made = []
        for leaf in leaves:
            spread = points[leaf]
            side = int((spread.max(axis=0) - spread.min(axis=0)).argmax()) if len(leaf) else 0
            order = leaf[np.argsort(spread[:, side], kind="stable")]
            made += [order[:len(order) // 2], order[len(order) // 2:]]
        leaves = made
    return leaves


def place_cells(sample: np.ndarray, cells: int, directions: np.ndarray) -> Cells:
    """Boxes that cover all space, halved at sample medians of the widest side."""
    points = unit(sample) @ directions if len(sample) else np.zeros((0, directions.shape[1]))
    boxes = [(np.arange(len(points)), np.full(directions.shape[1], -np.inf), np.full(directions.shape[1], np.inf))]
    while len(boxes) < cells:
        made = []
        for leaf, low, high in boxes:
            spread = points[leaf]
            width = spread.max(axis=0) - spread.min(axis=0) if len(leaf) else np.zeros(1)
            if width.max() <= 0:
                made.append((leaf, low, high))
                continue
            side = int(width.argmax())
            cut = float(np.median(spread[:, side]))
            if cut >= spread[:, side].max():
                cut = float(np.unique(spread[:, side])[-2:].mean())
            left, right = high.copy(), low.copy()
            left[side], right[side] = cut, cut
            below = spread[:, side] <= cut
            made += [(leaf[below], low, left), (leaf[~below], right, high)]
        if len(made) == len(boxes):
            break
        boxes = made
    return Cells(directions, np.array([b[1] for b in boxes]), np.array([b[2] for b in boxes]))


class Tree:
    """The vectors of a part of a cell under a kd-tree of their projections."""

    def __init__(self, vectors: np.ndarray, ids: list[np.ndarray], cells: Cells):
        points = cells.project(vectors)
        leaves = [leaf for leaf in split(points, 1 << max(0, math.ceil(math.log2(max(1, len(points) / LEAF))))) if len(leaf)]
        self.low = np.array([points[leaf].min(axis=0) for leaf in leaves])
        self.high = np.array([points[leaf].max(axis=0) for leaf in leaves])
        # Vectors lie leaf by leaf, so a leaf is a slice.
        order = np.concatenate(leaves)
        self.vectors, self.ids = vectors[order], [ids[k] for k in order]
        self.raw = [v.tobytes() for v in self.vectors]
        self.norms, self.bounds = lengths(self.vectors), np.concatenate([[0], np.cumsum([len(leaf) for leaf in leaves])]).tolist()

    def search(self, query: np.ndarray, point: np.ndarray, count: int, limit: float, worst: float) -> list[tuple[float, int, bool]]:
        """The best (negative cosine, id, equal to the query) of this part. ``worst``: a squared distance
        known to hold ``count`` vectors elsewhere."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        apart = (gap * gap).sum(axis=1)
        norm, raw = float(lengths(query[None])[0]), query.tobytes()
        best: list[tuple[float, int, bool]] = []
        order = np.argsort(apart, kind="stable")
        for k, far in zip(order.tolist(), apart[order].tolist()):
            if far > limit * worst:
                break
            a, b = self.bounds[k], self.bounds[k + 1]
            found = cosines(self.vectors[a:b], self.norms[a:b], query, norm)
            near = np.flatnonzero(found >= 1 - worst / 2 - 1e-9)
            if len(near) > count:  # ties beyond the last are kept
                near = near[found[near] >= np.partition(found[near], len(near) - count)[len(near) - count]]
            if len(near):
                best += [(-float(found[x]), int(i), self.raw[a + x] == raw) for x in near for i in self.ids[a + x]]
                best = sorted(best)[:count]
                if len(best) == count:
                    worst = min(worst, max(2 + 2 * best[-1][0], 0.0))
        return best


def valid(table: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, v) of the vectors that take part, v being their components as 64-bit numbers."""
    number = F.col(vector).cast("array<double>")
    whole = table.select(F.col(id_column).cast("bigint").alias("id"), number.alias("c")).where(
        F.col("id").isNotNull() & F.col("c").isNotNull() & (F.size("c") > 0) & F.forall(
            "c", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("c", lambda x: x != 0))
    usual = whole.groupBy(F.size("c").alias("size")).count().orderBy(F.desc("count"), "size").first()

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype("<f8") + 0.0
            rows = flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], names=["id", "v"])

    return whole.where(F.size("c") == (usual["size"] if usual else 0)).mapInArrow(run, "id bigint, v binary")


def matrix(column) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 1))
    return np.frombuffer(b"".join(column), dtype="<f8").reshape(len(column), -1)


def best_of(rows: DataFrame, by: list[str], count: int, name: str = "rank") -> DataFrame:
    window = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return rows.withColumn(name, F.row_number().over(window)).where(F.col(name) <= count)


def search(
    table: DataFrame, queries: Column, count: int = 5, id_column: str = "vec_id", vector: str = "embedding",
    directions: int = DIRECTIONS, sure: float = SURE, sample: int = SAMPLE, part: int = PART,
) -> DataFrame:
    """(query_id, rank, id, score): the ``count`` nearest other vectors found of every row that
    the condition ``queries`` on the table's columns names, against all rows."""
    if directions % 2:
        raise ValueError("directions must be even")
    all_rows = written(valid(table, id_column, vector), "vectors")
    asked = valid(table.where(queries), id_column, vector).withColumnsRenamed({"id": "query_id", "v": "q"})
    # Of equal vectors only the smallest ids can be among the nearest; one may be the query's own.
    ranked = all_rows.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("n") <= count + 1)
    distinct = written(ranked.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "distinct")
    total = distinct.count()
    taken = matrix(distinct.orderBy(F.xxhash64("v"), "v").limit(sample).select("v").toPandas()["v"])
    width = taken.shape[1] if total else 1
    axes = np.random.default_rng(20240229).standard_normal((width, directions))
    cells = place_cells(taken, min(MOST_CELLS, 1 << max(0, math.ceil(math.log2(max(1, total / part))))), axes)
    limit = chi_square_limit(1 - sure, directions)

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                found = cells.of(cells.project(matrix(batch.column(0).to_pylist())))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), *batch.columns], names=["cell", *batch.schema.names])

    indexed = distinct.mapInArrow(assign, "cell bigint, v binary, ids array<bigint>")
    # A cell much fuller than the sample foretold is dealt into parts.
    parts = indexed.groupBy("cell").agg(F.ceil(F.count("*") / part).cast("bigint").alias("parts"))
    parts = written(parts, "parts")
    index = written(indexed.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts"))).drop("parts"), "index")
    wanted = asked.select("q").distinct()

    def look(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple[bytes, float, int, bool]] = []
        if len(left) and len(right):
            tree = Tree(matrix(left["v"]), list(left["ids"]), cells)
            vectors = matrix(right["q"])
            for q, query, point, worst in zip(right["q"], vectors, cells.project(vectors), right["worst"]):
                rows += [(q, -s, i, same) for s, i, same in tree.search(query, point, count + 1, limit, worst)]
        return pd.DataFrame(rows, columns=["q", "score", "id", "same"]).astype({"score": "float64", "id": "int64", "same": "bool"})

    def visit(visits: DataFrame) -> DataFrame:
        dealt = visits.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).drop("parts")
        return index.groupBy("cell", "part").cogroup(dealt.groupBy("cell", "part")).applyInPandas(look, "q binary, score double, id bigint, same boolean")

    at_home = wanted.mapInArrow(assign, "cell bigint, q binary").withColumn("worst", F.lit(4.5))
    first = written(best_of(visit(at_home), ["q"], count + 1), "first").drop("rank")
    reached = first.groupBy("q").agg(F.when(F.count("*") > count, F.greatest(2 - 2 * F.min("score"), F.lit(0.0))).otherwise(4.5).alias("worst"))

    def admit(batches):
        for batch in batches:
            if batch.num_rows:
                points, worst = cells.project(matrix(batch.column(0).to_pylist())), batch.column(1).to_numpy()
                apart = cells.distances(points)
                row, cell = np.nonzero(apart <= limit * worst[:, None])
                other = cell != cells.of(points)[row]
                row = pa.array(row[other])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[other], pa.int64()), batch.column(0).take(row), batch.column(1).take(row)], names=["cell", "q", "worst"])

    open_queries = wanted.join(reached, "q", "left").select("q", F.coalesce("worst", F.lit(4.5)).alias("worst"))
    rest = visit(open_queries.mapInArrow(admit, "cell bigint, q binary, worst double"))
    found = best_of(first.unionByName(rest), ["q"], count + 1).drop("rank")
    # Of the rows with a query's id and vector one is the query's own. Equal rows have equal answers.
    rows = asked.groupBy("query_id", "q").agg(F.count("*").alias("rows")).join(found, "q")
    alike = F.row_number().over(Window.partitionBy("query_id", "q", "id", "same").orderBy("score"))
    others = rows.withColumn("alike", alike).where(~(F.col("same") & (F.col("id") == F.col("query_id")) & (F.col("alike") == 1)))
    nearest = best_of(others, ["query_id", "q"], count).withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "rows")))
    return nearest.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
