"""Batch, recursive and what-if forecasts for all requests at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelfcast.functions.business import percent
from shelfcast.functions.dates import horizon_dates, iso_weekday, with_date_parts
from shelfcast.operators.timeseries import LAGS, with_latest_lags
from shelfcast.session import cut_lineage

MAX_DAYS = 30
STEPS_PER_CUT = 10
HELD = max(LAGS)  # days of sales that the lags of the next day need

# Range request defaults.
RANGE_DEFAULTS = {"days": 7, "open_status": 1, "promo_active": 0, "store_type": "a", "assortment": "a",
                  "competition_distance": 1270.0}


def check_days(days: int) -> int:
    if not 1 <= days <= MAX_DAYS:
        raise ValueError(f"days must be 1 to {MAX_DAYS}, not {days}")
    return days


def rename_request(requests: DataFrame) -> DataFrame:
    """Service field names to table column names."""
    return requests.withColumnsRenamed({"store": "Store", "open": "Open"})


def predict(features: DataFrame, model, output: str = "prediction") -> DataFrame:
    """Date parts, fitted preprocessing and model, back on the sales scale. ``model`` is any
    fitted transformer that writes the log prediction to ``prediction``."""
    scored = model.transform(with_date_parts(features))
    return scored.withColumn("log_prediction", F.col("prediction")).withColumn(output, F.expm1("log_prediction"))


def forecast(requests: DataFrame, latest: DataFrame, model) -> DataFrame:
    """One prediction per request: rename, last known lags, preprocess, score, two decimals."""
    known = with_latest_lags(rename_request(requests), latest)
    scored = predict(known.withColumn("Date", F.to_date("Date")), model)
    return scored.withColumn("prediction", F.round("prediction", 2))


def recursive_linear(
    requests: DataFrame, days: int, score: Callable[[Column, Column], Column], start: str = "start_date"
) -> DataFrame:
    """Forecast ``days`` consecutive days per row, each prediction being the next day's lag.

    ``score(lag, date)`` is the log prediction as an expression. The recursion is a fold over
    the dates inside each row: no shuffle, and the plan does not grow with the horizon.
    Returns (request columns, Date, prediction).
    """
    check_days(days)
    start_state = F.struct(F.col("sales_lag_1").cast("double").alias("lag"), F.array().cast("array<double>").alias("path"))

    def step(state: Column, date: Column) -> Column:
        sales = F.expm1(score(state["lag"], date)).cast("double")
        return F.struct(sales.alias("lag"), F.concat(state["path"], F.array(sales)).cast("array<double>").alias("path"))

    dates = horizon_dates(F.col(start), days)
    path = F.aggregate(dates, start_state, step, lambda state: state["path"])
    days_ahead = F.arrays_zip(dates.alias("Date"), path.alias("prediction"))
    return requests.withColumn("_day", F.explode(days_ahead)).select(
        *requests.columns, F.col("_day")["Date"].alias("Date"), F.col("_day")["prediction"].alias("prediction")
    )


def newest_sales(sales: DataFrame, held: int = HELD) -> DataFrame:
    """(Store, last_date, ring): the newest ``held`` sales of every store in order of their days, 0.0
    before the first. Any store folds to so many values before the shuffle's sort is over."""
    newest = W.partitionBy("Store").orderBy(F.desc("Date"))
    kept = sales.select("Store", "Date", F.col("Sales").cast("double").alias("Sales")).withColumn("_back", F.row_number().over(newest))
    rings = kept.where(F.col("_back") <= held).groupBy("Store").agg(
        F.max("Date").alias("last_date"), F.array_sort(F.collect_list(F.struct("Date", "Sales"))).alias("_days"))
    ring = F.transform("_days", lambda d: d["Sales"])
    return rings.select("Store", "last_date", F.concat(F.array_repeat(F.lit(0.0), held - F.size("_days")), ring).alias("ring"))


def lags_of(ring: Column, lags: tuple[int, ...] = LAGS, mean: int = 7, held: int = HELD) -> dict[str, Column]:
    """The lags of the day after the last one in ``ring``, and the mean of the last days before it."""
    last = sum((ring[held - k] for k in range(mean, 1, -1)), F.lit(0.0)) + ring[held - 1]
    return {**{f"sales_lag_{k}": ring[held - k] for k in lags}, f"sales_roll_mean_{mean}": last / mean}


def recursive_lags(
    requests: DataFrame, days: int, score: Callable[[dict[str, Column], Column], Column], start: str = "start_date", held: int = HELD,
) -> DataFrame:
    """As ``recursive_linear``, with all lags following the predictions.

    The state of the fold is the row's ``ring`` of the newest sales: a day's prediction goes in at
    its end and the oldest value falls out, so lag 7, lag 30 and the rolling mean move along with
    lag 1. ``score(lags, date)`` is the log prediction as an expression.
    """
    check_days(days)
    start_state = F.struct(F.col("ring").alias("ring"), F.array().cast("array<double>").alias("path"))

    def step(state: Column, date: Column) -> Column:
        sales = F.array(F.expm1(score(lags_of(state["ring"], held=held), date)).cast("double"))
        return F.struct(
            F.concat(F.slice(state["ring"], 2, held - 1), sales).cast("array<double>").alias("ring"),
            F.concat(state["path"], sales).cast("array<double>").alias("path"))

    dates = horizon_dates(F.col(start), days)
    path = F.aggregate(dates, start_state, step, lambda state: state["path"])
    kept = [c for c in requests.columns if c != "ring"]
    return requests.withColumn("_day", F.explode(F.arrays_zip(dates.alias("Date"), path.alias("prediction")))).select(
        *kept, F.col("_day")["Date"].alias("Date"), F.col("_day")["prediction"].alias("prediction"))


def recursive_model(requests: DataFrame, days: int, model, start: str = "start_date") -> DataFrame:
    """As ``recursive_linear`` for any fitted model, one scoring projection per day over all rows.

    Only ``sales_lag_1`` follows the predictions; the other lags stay as they are. Holidays
    are off. The plan grows with the horizon, so it is cut every few days.
    """
    check_days(days)
    keep = requests.columns
    state = requests.withColumns({
        "sales_lag_1": F.col("sales_lag_1").cast("double"),
        "StateHoliday": F.lit("0"),
        "SchoolHoliday": F.lit(0),
        "_path": F.array().cast("array<double>"),
    })
    columns = state.columns
    for day in range(days):
        date = F.date_add(start, day)
        scored = predict(state.withColumns({"Date": date, "DayOfWeek": iso_weekday(date)}), model)
        state = scored.withColumns({
            "sales_lag_1": F.col("prediction"),
            "_path": F.array_append("_path", F.col("prediction")),
        }).select(*columns)
        if (day + 1) % STEPS_PER_CUT == 0 and day + 1 < days:
            state = cut_lineage(state)
    kept = [c for c in keep if c not in ("sales_lag_1", "StateHoliday", "SchoolHoliday")]
    return state.select(*kept, F.posexplode("_path").alias("_day", "prediction")).select(
        *kept, F.date_add(start, F.col("_day")).alias("Date"), "prediction"
    )


def totals(path: DataFrame, by: list[str]) -> DataFrame:
    """Total and mean per day of a forecast path."""
    return path.groupBy(*by).agg(
        F.sum("prediction").alias("total_estimated_sales"),
        F.avg("prediction").alias("mean_daily_sales"),
        F.count("*").alias("days"),
    )


def range_result(path: DataFrame, by: str = "Store", start: str = "start_date") -> DataFrame:
    """One row per request with its daily forecasts as an array of at most 30 structs."""
    day = F.struct(F.date_format("Date", "yyyy-MM-dd").alias("date"), F.round("prediction", 2).alias("prediction"))
    return path.groupBy(F.col(by).alias("store_id"), F.col(start).alias("start_date")).agg(
        F.max("Date").alias("end_date"),
        F.sort_array(F.collect_list(day)).alias("daily_forecasts"),
        F.round(F.sum("prediction"), 2).alias("total_estimated_sales"),
    )


def scenarios(requests: DataFrame, column: str = "Promo", values: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Each request once per value of the scenario column."""
    others = [c for c in requests.columns if c != column]
    return requests.select(*others, F.explode(F.array(*[F.lit(v) for v in values])).alias(column))


def compare_days(path: DataFrame, column: str = "Promo", by: tuple[str, ...] = ("Store", "Date")) -> DataFrame:
    """Base and scenario prediction of the same day side by side, by one grouping instead of a join."""
    return path.groupBy(*by).agg(
        F.max(F.when(F.col(column) == 0, F.col("prediction"))).alias("base"),
        F.max(F.when(F.col(column) == 1, F.col("prediction"))).alias("promo"),
    )


def uplift(days: DataFrame, by: tuple[str, ...] = ("Store",)) -> DataFrame:
    """Totals of both scenarios, their difference, and the difference in percent of the base
    (0 where the base is not positive)."""
    sums = days.groupBy(*by).agg(F.sum("base").alias("base_total"), F.sum("promo").alias("promo_total"))
    difference = F.col("promo_total") - F.col("base_total")
    return sums.withColumns({"uplift": difference, "uplift_percent": percent(difference, F.col("base_total"))})


def attribution(df: DataFrame, weights: dict[str, float], means: dict[str, float] | None = None, top: int = 5) -> DataFrame:
    """Largest contributions ``weight * (value - mean)`` of a linear score, by magnitude.

    These are the exact Shapley values of a linear model with independent features.
    """
    means = means or {}
    parts = F.array(*[
        F.struct(F.lit(name).alias("feature"), ((F.col(name) - means.get(name, 0.0)) * weight).alias("contribution"))
        for name, weight in weights.items()
    ])
    ordered = F.array_sort(parts, lambda a, b: F.when(F.abs(a["contribution"]) > F.abs(b["contribution"]), -1)
                           .when(F.abs(a["contribution"]) < F.abs(b["contribution"]), 1)
                           .when(a["feature"] < b["feature"], -1).when(a["feature"] > b["feature"], 1).otherwise(0))
    return df.withColumn("explanation", F.slice(ordered, 1, top))
