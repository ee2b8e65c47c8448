"""Exact order statistics without sorting, or holding, a whole column in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelfcast.session import forget, written

PIECE_ROWS = 1 << 18           # distinct values counted through in one task, about
LEAST_NORMAL = 2.0 ** -1022    # doubles below it have no leading one


def long_form(df: DataFrame, columns: list[str], ids: list[str] | None = None, kind: str = "double") -> DataFrame:
    """(ids..., column, value) rows of the non-null values."""
    ids = ids or []
    narrow = df.select(*ids, *[F.col(c).cast(kind).alias(c) for c in columns])
    return narrow.unpivot(ids, columns, "column", "value").where(F.col("value").isNotNull())


def quantile_name(probability: float) -> str:
    return "q" + f"{probability * 100:g}".replace(".", "_")


def with_ordered_bits(df: DataFrame, value: str = "value", name: str = "bits") -> DataFrame:
    """Adds a whole number of 64 bits that grows with the double: exponent and fraction as its own
    bits have them, mirrored for negative numbers. NaN, as in Spark's order, is above all others.
    One step a projection, so that no step is computed again inside the next."""
    size, infinite = F.col("_size"), F.lit(float("inf"))
    normal = (size >= F.lit(LEAST_NORMAL)) & (size < infinite)
    scaled = F.col("_scaled")  # exact, and a logarithm is at most one step off
    fraction = F.when(scaled < 1.0, scaled * 2).when(scaled >= 2.0, scaled / 2).otherwise(scaled) - 1.0
    exponent = F.col("_guess") + F.when(scaled < 1.0, -1).when(scaled >= 2.0, 1).otherwise(0)
    bits = F.when(size == infinite, F.lit(2047 << 52)).when(
        normal, (exponent + 1023) * F.lit(1 << 52) + (fraction * F.lit(2.0 ** 52)).cast("bigint")
    ).otherwise((size * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("bigint"))
    steps = df.withColumn("_size", F.abs(F.col(value)))
    steps = steps.withColumn("_guess", F.least(F.floor(F.log2(F.when(normal, size).otherwise(1.0))), F.lit(1023)))
    steps = steps.withColumn("_scaled", size / F.pow(F.lit(2.0), F.col("_guess")))
    steps = steps.withColumn("_bits", F.when(F.isnan(value), F.lit((1 << 63) - 1)).otherwise(bits))
    return steps.withColumn(name, F.when(F.col(value) < 0, -F.col("_bits")).otherwise(F.col("_bits"))).drop("_size", "_guess", "_scaled", "_bits")


def value_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, rows, bits): the distinct non-null values and how often each occurs, written
    once for everything that reads them. Copies fold before the shuffle."""
    counted = long_form(df, columns).groupBy("column", "value").agg(F.count("*").alias("rows"))
    return written(with_ordered_bits(counted), "values")


def quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """One row per column with ``q25``, ``q50``, ...: linear interpolation, nulls skipped."""
    return quantiles_of(value_table(df, columns), probabilities)


def quantiles_of(values: DataFrame, probabilities: list[float]) -> DataFrame:
    """``quantiles`` of a ``value_table``.

    Radix selection: four passes over 16 bits each of the value's ordered bits. A pass counts the
    rows by their next digit, for all columns and wanted positions at once, among the rows that
    share the digits found so far; the digit in which a position falls is then known, and how many
    rows lie below. The digits of a position are at most 65,536 counts however the values lie, and
    the fourth digit is the value itself. Between passes only the positions, two for each column
    and probability, come to the driver.
    """
    spark = values.sparkSession
    position = F.col("p") * (F.col("n") - 1)
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probabilities)])
    asked = values.groupBy("column").agg(F.sum("rows").alias("n")).select("column", "n", F.inline(wanted)).select(
        "column", "i", F.inline(F.array(*[F.struct(F.lit(k).alias("side"), at(position).alias("rank")) for k, at in enumerate((F.floor, F.ceil))])),
        (position - F.floor(position)).alias("part"), F.lit(0).cast("bigint").alias("prefix"), F.lit(0.0).alias("value"))
    for shift in (48, 32, 16, 0):
        found = spark.createDataFrame(asked.collect(), asked.schema)
        higher = F.shiftright("bits", shift + 16) if shift < 48 else F.lit(0).cast("bigint")
        digits = values.select("column", higher.alias("prefix"), F.shiftright("bits", shift).alias("digit"), "value", "rows")
        # One row per column and position on the small side.
        counted = digits.join(F.broadcast(found.select("column", "prefix").distinct()), ["column", "prefix"]).groupBy(
            "column", "prefix", "digit").agg(F.sum("rows").alias("rows"), F.min("value").alias("least"))
        upto = W.partitionBy("column", "prefix").orderBy("digit").rowsBetween(W.unboundedPreceding, W.currentRow)
        seen = counted.withColumn("upto", F.sum("rows").over(upto)).withColumn("below", F.col("upto") - F.col("rows"))
        inside = (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("below"))
        asked = seen.join(F.broadcast(found), ["column", "prefix"]).where(inside).select(
            "column", "i", "side", (F.col("rank") - F.col("below")).alias("rank"), "part", F.col("digit").alias("prefix"),
            F.col("least").alias("value"))
    low, high = F.max(F.when(F.col("side") == 0, F.col("value"))), F.max(F.when(F.col("side") == 1, F.col("value")))
    picked = asked.groupBy("column", "i").agg(F.when(low == high, low).otherwise(low + (high - low) * F.max("part")).alias("q"))
    return picked.groupBy("column").agg(
        *[F.max(F.when(F.col("i") == i, F.col("q"))).alias(quantile_name(p)) for i, p in enumerate(probabilities)])


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value) with the most frequent non-null value as text; the smallest on ties."""
    # One scan for all columns. Each keeps its own type beside the text, so that ties fall to the
    # smallest value and not to the smallest text.
    kinds = dict(df.dtypes)
    cases = F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.when(F.lit(c == other), F.col(other)).cast(kinds[other]).alias(f"v_{k}")
                                              for k, other in enumerate(columns)]) for c in columns
    ])
    values = [f"v_{k}" for k in range(len(columns))]
    long = df.select(F.inline(cases)).where(reduce(lambda a, b: a | b, [F.col(v).isNotNull() for v in values]))
    counted = long.groupBy("column", *values).agg(F.count("*").alias("rows"))
    text = F.coalesce(*[F.col(v).cast("string") for v in values])
    return counted.groupBy("column").agg(F.min_by(text, F.struct(-F.col("rows"), *values)).alias("value"))


def running_counts(counts: DataFrame, by: list[str], weights: list[str], piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``counts`` has one row per (by, value) and count columns ``weights``; ``by`` has a bounded
    number of groups, such as named columns and calendar years.

    Adds, per weight w, ``seen_w`` (rows at or below the value) and ``all_w`` (rows in the
    group), and ``next_value`` (the next larger value of the group, null at the end).

    The rows are written once, cut into ranges of (by, value) of about ``piece_rows`` rows, so the
    number of pieces follows the data. Totals of the pieces, one row each, give every piece what
    lies before it; inside the pieces running counts go in parallel.
    """
    held = written(counts, "counts")
    pieces = max(1, -(-held.count() // piece_rows))
    ranged = held.repartitionByRange(pieces, *by, "value").withColumn("_piece", F.spark_partition_id())
    cut = written(ranged, "ranges")
    forget(held)
    sums = cut.groupBy(*by, "_piece").agg(F.min("value").alias("_first"), *[F.sum(w).alias(f"_in_{w}") for w in weights])
    along = W.partitionBy(*by).orderBy("_piece")  # one row for each piece
    before = along.rowsBetween(W.unboundedPreceding, -1)
    shifts = sums.select(
        *by, "_piece",
        F.lead("_first").over(along).alias("_next_first"),
        *[F.coalesce(F.sum(f"_in_{w}").over(before), F.lit(0)).alias(f"_before_{w}") for w in weights],
        *[F.sum(f"_in_{w}").over(W.partitionBy(*by)).alias(f"all_{w}") for w in weights],
    )
    inside = W.partitionBy(*by, "_piece").orderBy("value")
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        cut.join(shifts, [*by, "_piece"])
        .withColumns({
            **{f"seen_{w}": F.col(f"_before_{w}") + F.sum(w).over(upto) for w in weights},
            "next_value": F.coalesce(F.lead("value").over(inside), F.col("_next_first")),
        })
        .drop("_piece", "_next_first", *[f"_before_{w}" for w in weights])
    )
