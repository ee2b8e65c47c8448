"""Distribution drift between a reference and a current table.

Numeric columns: two-sample Kolmogorov-Smirnov and Wasserstein distance from running counts
per distinct value. Categorical columns: Jensen-Shannon distance, population stability index
and chi-square from value shares. Everything is counted per value before it is compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.quantiles import running_counts
from shelfcast.session import written

NUMERIC_THRESHOLD = 0.1       # Wasserstein distance in reference deviations
CATEGORICAL_THRESHOLD = 0.1   # Jensen-Shannon distance
SHARE_THRESHOLD = 0.3         # share of drifted columns that calls for retraining
SERVICE_SHARE_THRESHOLD = 0.15
CRITICAL_SHARE = 0.5
LEAST_SHARE = 0.0001          # floor of a share inside the stability index
LEAST_DEVIATION = 0.001


def value_counts(df: DataFrame, numeric: list[str], categorical: list[str], ids: list[str] | None = None) -> DataFrame:
    """(ids..., column, number, text, rows) of the non-null values of all columns, in one scan.

    Numeric columns are counted by ``number``, the others by ``text``. Counts of parts of a table
    add up to those of the whole, so they can be kept and added to as rows arrive.
    """
    ids = ids or []
    cases = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("number"), F.lit(None).cast("string").alias("text")) for c in numeric]
    cases += [F.struct(F.lit(c).alias("column"), F.lit(None).cast("double").alias("number"), F.col(c).cast("string").alias("text")) for c in categorical]
    long = df.select(*ids, F.inline(F.array(*cases))).where(F.col("number").isNotNull() | F.col("text").isNotNull())
    return long.groupBy(*ids, "column", "number", "text").agg(F.count("*").alias("rows"))


def _side_counts(reference: DataFrame, current: DataFrame, value: str, period: str | None) -> tuple[DataFrame, list[str]]:
    """(by..., value, r, c) from counts of both sides: rows of each value in the reference and in
    the current table.

    With ``period`` the current table is compared period by period; the reference counts,
    one row per distinct value, are repeated for each period of the calendar.
    """
    ref = reference.where(F.col(value).isNotNull()).select("column", F.col(value).alias("value"), F.col("rows").alias("r"))
    cur = current.where(F.col(value).isNotNull())
    by = ["column"]
    if period:
        by = ["column", period]
        periods = current.agg(F.collect_set(period)).scalar()
        ref = ref.withColumn(period, F.explode(periods))
    both = ref.select(*by, "value", "r", F.lit(0).cast("bigint").alias("c")).unionByName(
        cur.select(*by, F.col(value).alias("value"), F.lit(0).cast("bigint").alias("r"), F.col("rows").alias("c")))
    return both.groupBy(*by, "value").agg(F.sum("r").alias("r"), F.sum("c").alias("c")), by


def numeric_drift(reference: DataFrame, current: DataFrame, columns: list[str], period: str | None = None) -> DataFrame:
    """(column, ks, w1, w1_norm, reference_rows, current_rows); distances are null without current rows."""
    ids = [period] if period else None
    return numeric_drift_of_counts(value_counts(reference, columns, []), value_counts(current, columns, [], ids), period)


def numeric_drift_of_counts(reference: DataFrame, current: DataFrame, period: str | None = None) -> DataFrame:
    """``numeric_drift`` from the ``value_counts`` of both sides."""
    counts, by = _side_counts(reference, current, "number", period)
    seen = running_counts(counts, by, ["r", "c"])
    apart = F.abs(F.try_divide(F.col("seen_r"), F.col("all_r")) - F.try_divide(F.col("seen_c"), F.col("all_c")))
    distances = seen.groupBy(*by).agg(
        F.max(apart).alias("ks"),
        F.sum(apart * (F.col("next_value") - F.col("value"))).alias("w1"),
        F.max("all_r").alias("reference_rows"),
        F.max("all_c").alias("current_rows"),
    )
    numbers = reference.where(F.col("number").isNotNull())
    means = numbers.groupBy("column").agg((F.sum(F.col("number") * F.col("rows")) / F.sum("rows")).alias("_mean"))
    away = F.col("number") - F.col("_mean")
    # One row per named column.
    deviation = numbers.join(F.broadcast(means), "column").groupBy("column").agg(
        F.sqrt(F.sum(away * away * F.col("rows")) / F.sum("rows")).alias("_std"))
    compared = F.col("ks").isNotNull()
    return distances.join(deviation, "column", "left").select(
        *by, "ks",
        F.when(compared, F.coalesce("w1", F.lit(0.0))).alias("w1"),
        F.when(compared, F.coalesce("w1", F.lit(0.0)) / F.greatest(F.col("_std"), F.lit(LEAST_DEVIATION))).alias("w1_norm"),
        "reference_rows", "current_rows",
    )


def categorical_drift(
    reference: DataFrame, current: DataFrame, columns: list[str], period: str | None = None
) -> DataFrame:
    """(column, js, psi, chi2, reference_rows, current_rows)."""
    ids = [period] if period else None
    return categorical_drift_of_counts(value_counts(reference, [], columns), value_counts(current, [], columns, ids), period)


def categorical_drift_of_counts(reference: DataFrame, current: DataFrame, period: str | None = None) -> DataFrame:
    """``categorical_drift`` from the ``value_counts`` of both sides."""
    counts, by = _side_counts(reference, current, "text", period)
    totals = counts.groupBy(*by).agg(F.sum("r").alias("reference_rows"), F.sum("c").alias("current_rows"))
    p, q = F.col("_p"), F.col("_q")
    middle = (p + q) / 2
    floor_p, floor_q = F.greatest(p, F.lit(LEAST_SHARE)), F.greatest(q, F.lit(LEAST_SHARE))

    def relative(share: Column) -> Column:
        return F.when(share > 0, share * F.ln(share / middle)).otherwise(F.when(share.isNotNull(), 0.0))

    expected = p * F.col("current_rows")
    shares = counts.join(totals, by).withColumns({
        "_p": F.try_divide(F.col("r"), F.col("reference_rows")),
        "_q": F.try_divide(F.col("c"), F.col("current_rows")),
    })
    return shares.groupBy(*by, "reference_rows", "current_rows").agg(
        F.sqrt(F.greatest(F.sum(relative(p) + relative(q)) / 2, F.lit(0.0))).alias("js_raw"),
        F.sum((floor_q - floor_p) * F.ln(floor_q / floor_p)).alias("psi_raw"),
        F.sum(F.when(p > 0, (F.col("c") - expected) * (F.col("c") - expected) / F.nullif(expected, F.lit(0.0)))).alias("chi2"),
    ).select(
        *by,
        F.when((F.col("reference_rows") > 0) & (F.col("current_rows") > 0), F.col("js_raw")).alias("js"),
        F.when((F.col("reference_rows") > 0) & (F.col("current_rows") > 0), F.col("psi_raw")).alias("psi"),
        "chi2", "reference_rows", "current_rows",
    )


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    numeric: list[str],
    categorical: list[str],
    period: str | None = None,
    numeric_threshold: float = NUMERIC_THRESHOLD,
    categorical_threshold: float = CATEGORICAL_THRESHOLD,
) -> DataFrame:
    """(period,) column, kind, score, threshold, drifted, current_rows: one row per compared column.
    Each table is read once, for a table of its value counts."""
    ids = [period] if period else []
    sides = [written(value_counts(side, numeric, categorical, by), "value-counts") for side, by in ((reference, []), (current, ids))]
    return drift_report_of_counts(*sides, bool(numeric), bool(categorical), period, numeric_threshold, categorical_threshold)


def drift_report_of_counts(
    reference: DataFrame, current: DataFrame, numeric: bool = True, categorical: bool = True, period: str | None = None,
    numeric_threshold: float = NUMERIC_THRESHOLD, categorical_threshold: float = CATEGORICAL_THRESHOLD,
) -> DataFrame:
    """``drift_report`` from the ``value_counts`` of both sides."""
    ids = [period] if period else []
    parts = []
    if numeric:
        parts.append(numeric_drift_of_counts(reference, current, period).select(
            *ids, "column", F.lit("numeric").alias("kind"), F.col("w1_norm").alias("score"),
            F.lit(numeric_threshold).alias("threshold"), "current_rows"))
    if categorical:
        parts.append(categorical_drift_of_counts(reference, current, period).select(
            *ids, "column", F.lit("categorical").alias("kind"), F.col("js").alias("score"),
            F.lit(categorical_threshold).alias("threshold"), "current_rows"))
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("drifted", F.coalesce(F.col("score") >= F.col("threshold"), F.lit(False)))


def drift_summary(report: DataFrame, threshold: float = SHARE_THRESHOLD, period: str | None = None) -> DataFrame:
    """status, drift_share (4 places), drifted_columns_count, requires_retraining; a current
    table without rows is ``skipped``."""
    share = F.avg(F.col("drifted").cast("int"))
    empty = F.coalesce(F.max("current_rows"), F.lit(0)) == 0
    groups = report.groupBy(period) if period else report.groupBy()
    return groups.agg(
        F.when(empty, "skipped").otherwise("success").alias("status"),
        F.round(F.when(empty, 0.0).otherwise(share), 4).alias("drift_share"),
        F.when(empty, 0).otherwise(F.sum(F.col("drifted").cast("int"))).cast("bigint").alias("drifted_columns_count"),
        F.when(empty, False).otherwise(share > threshold).alias("requires_retraining"),
    )


def with_level(summary: DataFrame, warning: float = SHARE_THRESHOLD, critical: float = CRITICAL_SHARE) -> DataFrame:
    share = F.col("drift_share")
    return summary.withColumn(
        "level", F.when(share >= critical, "critical").when(share >= warning, "warning").otherwise("ok")
    )


def unit_hash(*keys: str) -> Column:
    """A repeatable number in [0, 1) from the first eight hex digits of the MD5 of the keys."""
    digits = F.substring(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys])), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / 4294967296.0


def perturb(df: DataFrame, column: str = "CompetitionDistance", keys: tuple[str, ...] = ("Store",),
            low: float = 1.1, high: float = 1.5) -> DataFrame:
    """Scale a column by a repeatable factor in [low, high); nulls count as 0. Makes a drifted table to test with."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(0.0)) * (low + (high - low) * unit_hash(*keys)))
