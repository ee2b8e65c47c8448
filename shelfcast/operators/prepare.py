"""Join, fills, filters, splits and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from shelfcast.functions.dates import parse_date
from shelfcast.operators.quantiles import modes, quantiles

TEST_FRACTION = "3333"  # first four hex digits below this: 20 % of all keys


def join_store(facts: DataFrame, store: DataFrame) -> DataFrame:
    """Every fact row with its store columns, nulls where the store is unknown.

    No broadcast hint: the planner broadcasts the store table while its size allows, and
    beyond that sorts and merges, where AQE splits a hot store.
    """
    return facts.join(store, "Store", "left")


def fill_constants(df: DataFrame, values: dict) -> DataFrame:
    return df.na.fill(values)


def fill_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls of each column replaced by that column's exact median (mean of the middle two)."""
    # One row of all medians, read by one subquery.
    found = quantiles(df, columns, [0.5]).agg(F.struct(*[F.max(F.when(F.col("column") == c, F.col("q50"))).alias(c) for c in columns])).scalar()
    return df.withColumn("_medians", found).withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col("_medians")[c]) for c in columns}).drop("_medians")


def fill_modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls replaced by the most frequent value, the smallest on ties."""
    types = dict(df.dtypes)
    # One row of all modes, read by one subquery.
    found = modes(df, columns).agg(F.struct(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns])).scalar()
    return df.withColumn("_modes", found).withColumns(
        {c: F.coalesce(F.col(c), F.col("_modes")[c].cast(types[c])) for c in columns}).drop("_modes")


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=subset)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def shared_columns(left: DataFrame, right: DataFrame, without: tuple[str, ...] = ("Sales",)) -> list[str]:
    """Columns both tables have, in the left table's order."""
    return [c for c in left.columns if c in right.columns and c not in without]


def first_of_each_name(df: DataFrame) -> DataFrame:
    """Drop later columns that repeat a name."""
    names = [f"_{i}" for i in range(len(df.columns))]
    first = {name: i for i, name in reversed(list(enumerate(df.columns)))}
    return df.toDF(*names).select(*[F.col(f"_{i}").alias(name) for name, i in sorted(first.items(), key=lambda x: x[1])])


def hash_prefix(*columns: str) -> Column:
    """Four hex digits of the MD5 of the keys joined by ``|``: the same on every engine and run."""
    return F.substring(F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns])), 1, 4)


def with_split(df: DataFrame, keys: tuple[str, ...] = ("Store", "Date"), cut: str = TEST_FRACTION) -> DataFrame:
    """Repeatable 80/20 split by key, without moving a row."""
    return df.withColumn("split", F.when(hash_prefix(*keys) < cut, "test").otherwise("train"))


def year_split(df: DataFrame, test_year: int | None = None, date: str = "Date") -> DataFrame:
    """Years before ``test_year`` train, that year tests, later rows are left out. Without a
    year the last one of the data tests, so no row is left out."""
    year = F.year(date)
    last = df.agg(F.max(year)).scalar() if test_year is None else F.lit(test_year)
    return df.where(year <= last).withColumn("split", F.when(year < last, "train").otherwise("test"))


def date_split(df: DataFrame, fraction: float = 0.9, date: str = "Date") -> DataFrame:
    """Oldest ``fraction`` of the rows train, the rest test, cut between two days.

    Rows are first counted per day, so the running count is over calendar days only.
    """
    days = df.groupBy(date).agg(F.count("*").alias("rows"))
    running = W.orderBy(date).rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(F.lit(1))
    days = days.withColumns({"seen": F.sum("rows").over(running), "total": F.sum("rows").over(whole)})
    cut = days.where(F.col("seen") >= F.floor(F.col("total") * F.lit(fraction))).agg(F.min(date)).scalar()
    return df.withColumn("split", F.when(F.col(date) <= cut, "train").otherwise("test"))


def sample_rows(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all if there are fewer), picked by a seeded hash of their key.

    Rows are counted per hash prefix first. Only those up to the prefix that holds the n-th
    row are ranked, so no task sorts much more than the sample.
    """
    hashed = df.withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])))
    prefix = F.substring("_h", 1, 4)
    counts = hashed.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("rows"))
    running = W.orderBy("prefix").rowsBetween(W.unboundedPreceding, W.currentRow)
    counts = counts.withColumn("seen", F.sum("rows").over(running))
    cut = counts.where(F.col("seen") >= n).agg(F.coalesce(F.min("prefix"), F.lit("ffff"))).scalar()
    return hashed.where(prefix <= cut).orderBy("_h", *keys).limit(n).drop("_h")


def union_log(*logs: DataFrame) -> DataFrame:
    """All rows by column name; a column one log lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)


def outside_allowed(df: DataFrame, allowed: dict[str, tuple]) -> DataFrame:
    """(column, value, rows) for each value outside its column's allowed set; nulls are ignored."""
    columns = [c for c in allowed if c in df.columns]
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    bad = reduce(
        lambda a, b: a | b,
        [(F.col("column") == c) & ~F.col("value").isin([str(v) for v in allowed[c]]) for c in columns],
    )
    return long.where(F.col("value").isNotNull() & bad).groupBy("column", "value").agg(F.count("*").alias("rows"))


def request_checks(first_year: int = 2013, last_year: int = 2026) -> dict[str, Column]:
    """Condition under which a forecast request is refused, by reason. A missing field fails."""
    def outside(name: str, low: float, high: float) -> Column:
        return ~F.coalesce(F.col(name).between(low, high), F.lit(False))

    date = parse_date("Date")
    return {
        "store must be positive": ~F.coalesce(F.col("store") > 0, F.lit(False)),
        "DayOfWeek must be 1 to 7": outside("DayOfWeek", 1, 7),
        "Date must be yyyy-MM-dd": date.isNull(),
        f"Date must be between {first_year} and {last_year}":
            date.isNotNull() & ~F.year(date).between(first_year, last_year),
        "open must be 0 or 1": outside("open", 0, 1),
        "Promo must be 0 or 1": outside("Promo", 0, 1),
        "SchoolHoliday must be 0 or 1": outside("SchoolHoliday", 0, 1),
        "StateHoliday is missing": F.col("StateHoliday").isNull(),
        "StoreType is missing": F.col("StoreType").isNull(),
        "Assortment is missing": F.col("Assortment").isNull(),
        "CompetitionDistance is missing": F.col("CompetitionDistance").isNull(),
    }


def range_checks(first_year: int = 2013, last_year: int = 2026) -> dict[str, Column]:
    """As ``request_checks`` for requests over several days."""
    def outside(name: str, low: float, high: float) -> Column:
        return ~F.coalesce(F.col(name).between(low, high), F.lit(False))

    date = parse_date("start_date")
    return {
        "store must be positive": ~F.coalesce(F.col("store") > 0, F.lit(False)),
        "start_date must be yyyy-MM-dd": date.isNull(),
        f"start_date must be between {first_year} and {last_year}":
            date.isNotNull() & ~F.year(date).between(first_year, last_year),
        "days must be 1 to 30": outside("days", 1, 30),
        "open_status must be 0 or 1": outside("open_status", 0, 1),
        "promo_active must be 0 or 1": outside("promo_active", 0, 1),
    }


def reasons(checks: dict[str, Column]) -> Column:
    """The reasons for which a row fails."""
    return F.array_compact(F.array(*[F.when(failed, F.lit(reason)) for reason, failed in checks.items()]))


def with_reasons(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Each row with the reasons it fails; an empty list marks a valid row."""
    return df.withColumn("reasons", reasons(checks))


def quarantine(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, refused rows with reasons)."""
    checked = with_reasons(df, checks)
    return checked.where(F.size("reasons") == 0).drop("reasons"), checked.where(F.size("reasons") > 0)
