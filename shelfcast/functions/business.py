"""Row-wise business columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEEKS_PER_MONTH = 4.345
CUSTOMER_EPSILON = 1e-5

# Labels shown to users and the codes the tables store.
STORE_TYPE_LABELS = {
    "Small Convenience Store": "a",
    "Large Shopping Center": "b",
    "Standard Supermarket": "c",
    "Extra-Large Hypermarket": "d",
}
ASSORTMENT_LABELS = {
    "Basic (Essential Items Only)": "a",
    "Extended (Wide Selection)": "b",
    "Extra (Premium + Niche Items)": "c",
}
HOLIDAY_LABELS = {
    "No Holiday": "0",
    "Public Holiday": "a",
    "Easter Holiday": "b",
    "Christmas": "c",
}


def label_to_code(label: Column | str, labels: dict[str, str]) -> Column:
    """Code of a label; null for a label the map does not know."""
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), F.col(label) if isinstance(label, str) else label)


def code_to_label(code: Column | str, labels: dict[str, str]) -> Column:
    return label_to_code(code, {value: key for key, value in labels.items()})


def km_to_metres(km: Column | str) -> Column:
    return ((F.col(km) if isinstance(km, str) else km) * 1000).cast("double")


def is_weekend(day_of_week: str = "DayOfWeek") -> Column:
    return F.when(F.col(day_of_week) >= 6, 1).otherwise(0)


def is_holiday(state_holiday: str = "StateHoliday") -> Column:
    """0 only for code ``0``; an unknown (null) holiday counts as one."""
    return F.when(F.col(state_holiday) == "0", 0).otherwise(1)


def competition_months(year: str = "Year", month: str = "Month") -> Column:
    """Months since the competitor opened: 0 if unknown or still to come."""
    since_year, since_month = F.col("CompetitionOpenSinceYear"), F.col("CompetitionOpenSinceMonth")
    months = (F.col(year) - since_year) * 12 + (F.col(month) - since_month)
    return F.when(since_year == 0, 0).otherwise(F.greatest(F.lit(0), months)).cast("int")


def promo_months(year: str = "Year", week: str = "WeekOfYear") -> Column:
    """Months since the store joined the continuous promotion, to one decimal."""
    since_year, since_week = F.col("Promo2SinceYear"), F.col("Promo2SinceWeek")
    months = (F.col(year) - since_year) * 12 + (F.col(week) - since_week) / WEEKS_PER_MONTH
    return F.when(since_year == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.bround(months, 1)))


def with_business_features(df: DataFrame) -> DataFrame:
    """Needs date parts and filled competition and promotion columns."""
    return df.withColumns({
        "CompetitionOpenMonths": competition_months(),
        "Promo2OpenMonths": promo_months(),
        "SalesPerCustomer": F.col("Sales") / (F.col("Customers") + CUSTOMER_EPSILON),
        "IsHoliday": is_holiday(),
        "Promo_Holiday_Interaction": F.col("Promo") * is_holiday(),
        "IsWeekend": is_weekend(),
    })


def to_log(sales: Column | str) -> Column:
    return F.log1p(sales)


def from_log(log_sales: Column | str) -> Column:
    return F.expm1(log_sales)


def percent(part: Column, whole: Column) -> Column:
    """Percentage, 0 where the whole is not positive."""
    return F.when(whole > 0, part / whole * 100).otherwise(0.0)
