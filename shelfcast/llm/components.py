"""Connected components of a graph of links, by alternating star steps over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import forget, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of a link with the smallest node it can reach.

    A step links all larger neighbours of a node, then all smaller ones, to its smallest
    neighbour. Smallest neighbours come from partial aggregates, so a node with any number of
    links is no group in memory. Steps go on until the links are stars, which takes a number of
    steps logarithmic in the size of a component; each result is written, so a lost executor
    does not undo the steps before. Links to oneself, repeated links and nulls are left out.
    """
    edges = written(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
            F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        before, edges = edges, written(small.where("u != v").distinct(), "links")
        forget(before)
        new = _state(edges)
        if new == state:
            break
        state = new
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _state(edges: DataFrame) -> tuple:
    """Number of links and a sum that changes when they do."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
