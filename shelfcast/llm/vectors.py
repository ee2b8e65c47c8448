"""Vectors as whole numbers, for operators whose results are exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import written


def matrix(column: pa.Array, kind=np.int64) -> np.ndarray:
    """The rows of a list column whose lists have one length."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return values.reshape(len(column), len(values) // len(column) if len(column) else 0)


def lists(rows: np.ndarray) -> pa.Array:
    """A list column from a matrix."""
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(rows).reshape(-1)))


def whole_numbers(
    df: DataFrame, vector: str, scale: float, shift: int, limit: int, multiple: int = 1, keep: dict[str, str] | None = None,
) -> tuple[DataFrame, int]:
    """(the columns that ``keep`` names anew, ``x``) of every row whose vector is not null and holds
    no null or non-finite number, and the length of x.

    x is floor(scale * component) + shift, counted in 64 bits; products beyond ``limit`` count as
    the limit. Vectors shorter than the longest are filled up with zero components, and all are to
    a multiple of ``multiple``. The rows are written to the shared folder once.
    """
    keep = keep or {}
    source = df.select(*(F.col(f"`{old}`").alias(new) for old, new in keep.items()), F.col(f"`{vector}`").cast("array<double>").alias("x"))
    kept = source.schema.fields[:-1]

    def run(batches):
        for batch in batches:
            column = batch.column(len(kept))
            lengths = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # nulls are NaN
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            bad = np.diff(np.concatenate([[0], np.cumsum(~np.isfinite(values))])[ends]) > 0
            good = np.flatnonzero(~bad & ~column.is_null().to_numpy(zero_copy_only=False))
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(np.clip(np.nan_to_num(values * scale, nan=0.0), -limit, limit)).astype(np.int64) + shift
            made = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(x)).take(pa.array(good))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).take(pa.array(good)) for k in range(len(kept))] + [made], names=[f.name for f in kept] + ["x"])

    schema = T.StructType([*kept, T.StructField("x", T.ArrayType(T.LongType()))])
    rows = written(source.mapInArrow(run, schema), "whole_numbers")
    short, long = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    width = -(-(long or 0) // multiple) * multiple
    if short is not None and short < width:
        rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(shift).cast("bigint"), F.lit(width) - F.size("x"))))
    return rows, width
