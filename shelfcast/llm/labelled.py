"""Bounded samples of labelled documents, on which models are fitted."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, most_chars: int, allowed: Column | None = None,
    id_column: str = "doc_id", text: str = "text", most_total: int | None = None,
) -> pd.DataFrame:
    """At most ``rows`` labelled documents, the same ones on every run: columns text, label.

    Ids are chosen by hash from the labels that ``allowed`` admits; a document labelled twice
    counts as 1 if any label says so. Texts longer than ``most_chars`` are not chosen, so that
    the sample is bounded in bytes too. Texts need no shuffle: the chosen ids are few by
    construction and go to all tasks. With ``most_total`` documents are taken, in the order of the
    hash, until their texts have so many characters.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull())
    if allowed is not None:
        known = known.where(allowed)
    chosen = known.groupBy(id_column).agg(F.max(label).cast("int").alias("label")).orderBy(
        F.xxhash64(id_column), id_column).limit(rows)
    found = docs.select(F.col(id_column), F.col(text).cast("string").alias("text")).where(
        F.col("text").isNotNull() & (F.length("text") <= most_chars)).join(F.broadcast(chosen), id_column)
    once = found.groupBy(id_column).agg(F.min("text").alias("text"), F.first("label").alias("label"))
    if most_total is not None:
        before = Window.orderBy(F.xxhash64(id_column), id_column)  # at most ``rows`` rows
        once = once.withColumn("__upto", F.sum(F.length("text")).over(before)).where(F.col("__upto") <= most_total)
    return once.orderBy(id_column).select("text", "label").toPandas()
