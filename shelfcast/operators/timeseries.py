"""Lags, rolling statistics and latest rows of each store's series.

Lags count rows, not days, and frames are complete only when every value in them is known,
as in a shifted or rolled data frame.

A store's series has one row per day, so its window is bounded by the calendar. A finer or
hotter series goes through ``over_slices``, which cuts each series into pieces of time that
run as separate tasks and gives each piece the few earlier rows it needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.window import WindowSpec

from shelfcast.functions.dates import with_date_parts
from shelfcast.schemas import LAG_COLUMNS

LAGS = (1, 7, 30)
LOG_LAGS = (1, 2, 3, 7, 14, 30)


def series(by: tuple[str, ...] = ("Store",), order: str = "Date") -> WindowSpec:
    return W.partitionBy(*by).orderBy(order)


def lag_columns(value: str, lags: tuple[int, ...], window: WindowSpec, prefix: str) -> dict[str, Column]:
    return {f"{prefix}{k}": F.lag(value, k).over(window) for k in lags}


def rolling(function: Callable, value: str, n: int, window: WindowSpec, exclude_current: bool = False) -> Column:
    """``function`` over the last ``n`` rows, null until ``n`` known values are in the frame."""
    frame = window.rowsBetween(-n, -1) if exclude_current else window.rowsBetween(1 - n, 0)
    return F.when(F.count(value).over(frame) == n, function(value).over(frame))


def with_production_lags(
    df: DataFrame,
    by: tuple[str, ...] = ("Store",),
    lags: tuple[int, ...] = LAGS,
    means: tuple[int, ...] = (7,),
    exclude_current: bool = False,
) -> DataFrame:
    """``sales_lag_k`` and ``sales_roll_mean_n``. The rolling mean includes the row's own
    sales unless ``exclude_current``. All columns share one window: one shuffle, one sort."""
    window = series(by)
    return df.withColumns({
        **lag_columns("Sales", lags, window, "sales_lag_"),
        **{f"sales_roll_mean_{n}": rolling(F.avg, "Sales", n, window, exclude_current) for n in means},
    })


def with_log_lags(df: DataFrame, by: tuple[str, ...] = ("Store",)) -> DataFrame:
    """Lags, rolling means and rolling sample deviation of log sales over open days only."""
    open_days = df.where(F.col("Open") == 1).withColumn("LogSales", F.log1p("Sales"))
    window = series(by)
    return open_days.withColumns({
        **lag_columns("LogSales", LOG_LAGS, window, "lag_"),
        "rolling_mean_3": rolling(F.avg, "LogSales", 3, window),
        "rolling_mean_7": rolling(F.avg, "LogSales", 7, window),
        "rolling_std_7": rolling(F.stddev_samp, "LogSales", 7, window),
    })


def over_slices(
    df: DataFrame,
    add_columns: Callable[[DataFrame, tuple[str, ...]], DataFrame],
    depth: int,
    by: tuple[str, ...] = ("Store",),
    order: str = "Date",
    piece: Column | None = None,
) -> DataFrame:
    """Run ``add_columns(df, by)`` over pieces of each series instead of whole series.

    ``add_columns`` may look back at most ``depth`` rows. ``piece`` is an integer that never
    falls along ``order`` (default: the year). Every piece borrows the last ``depth`` rows
    before it, from as many earlier pieces as that takes, so results equal the whole window.
    """
    piece = F.year(order) if piece is None else piece
    rows = df.withColumn("_piece", piece.cast("bigint"))

    # Pieces are few per series. Piece s lends rows to t while fewer than depth rows lie between.
    sizes = rows.groupBy(*by, "_piece").agg(F.count("*").alias("_n"))
    along = W.partitionBy(*by).orderBy("_piece")
    sizes = sizes.withColumn("_upto", F.sum("_n").over(along.rowsBetween(W.unboundedPreceding, W.currentRow)))
    later = F.collect_list(F.struct(F.col("_piece").alias("t"), (F.col("_upto") - F.col("_n")).alias("before")))
    lends = sizes.select(
        *by, "_piece",
        F.transform(
            F.filter(later.over(along.rowsBetween(1, depth)), lambda t: t["before"] - F.col("_upto") < depth),
            lambda t: t["t"],
        ).alias("_to"),
    ).where(F.size("_to") > 0)

    from_end = F.row_number().over(W.partitionBy(*by, "_piece").orderBy(F.desc(order)))
    tails = rows.withColumn("_back", from_end).where(F.col("_back") <= depth).drop("_back")
    lent = (
        tails.join(lends, [*by, "_piece"])
        .withColumn("_piece", F.explode("_to")).drop("_to")
        .withColumn("_lent", F.lit(True))
    )
    both = rows.withColumn("_lent", F.lit(False)).unionByName(lent)
    return add_columns(both, (*by, "_piece")).where(~F.col("_lent")).drop("_lent", "_piece")


def feature_table(
    merged: DataFrame,
    split_column: str | None = "split",
    subset: list[str] | None = None,
    exclude_current: bool = False,
    piece: Column | None = None,
) -> DataFrame:
    """Production features: lags inside each split, date parts, rows with any null dropped.

    ``split_column=None`` takes lags over the whole series. ``subset`` limits the null check
    to some columns; by default optional columns count too, so a store without continuous
    promotion loses all its rows. ``piece`` cuts the series as in ``over_slices``.
    """
    by = (split_column, "Store") if split_column else ("Store",)

    def lags(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        return with_production_lags(df, keys, exclude_current=exclude_current)

    out = lags(merged, by) if piece is None else over_slices(merged, lags, max(LAGS), by, piece=piece)
    return with_date_parts(out).na.drop("any", subset=subset)


def latest_per_store(df: DataFrame, columns: list[str] | None = None, by: str = "Store", order: str = "Date") -> DataFrame:
    """Last known values per store, by partial aggregation: a hot store is folded before the shuffle.

    All values come from one row. Of rows with the same last date it is the one with the largest
    values, compared in the order of ``columns``.
    """
    columns = columns or LAG_COLUMNS
    return df.groupBy(by).agg(F.max(F.struct(order, *columns)).alias("_last")).select(by, "_last.*")


def recent_rows(df: DataFrame, by: str = "Store", order: str = "Date") -> DataFrame:
    """The rows from the day on at which the first series ends, among them the latest of every series. Finding
    that day folds plain numbers; wide rows are sorted to be folded, so it pays to leave out most of them first."""
    ends = df.groupBy(by).agg(F.max(order).alias("last"))
    return df.where((F.col(order) >= ends.agg(F.min("last")).scalar()) | F.col(order).isNull())


def with_latest_lags(requests: DataFrame, latest: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Requests with their store's last lags; an unknown store gets 0.0 and ``has_history`` false."""
    columns = columns or LAG_COLUMNS
    known = latest.select("Store", *columns, F.lit(True).alias("has_history"))
    joined = requests.join(known, "Store", "left")
    return joined.withColumns({
        **{c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns},
        "has_history": F.coalesce("has_history", F.lit(False)),
    })


def with_cyclical(df: DataFrame, periods: dict[str, int] | None = None) -> DataFrame:
    """Sine and cosine of calendar columns, so that December is next to January."""
    periods = periods or {"DayOfWeek": 7, "Month": 12, "WeekOfYear": 52}
    turn = {c: F.col(c) * (2 * 3.141592653589793 / n) for c, n in periods.items()}
    return df.withColumns({f"{c}_{name}": f(x) for c, x in turn.items() for name, f in (("sin", F.sin), ("cos", F.cos))})
