"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_date(text: Column | str) -> Column:
    """``yyyy-MM-dd`` text to a date; null where the text is not a real day in that format."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date"))


def format_date(date: Column | str) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def iso_weekday(date: Column | str) -> Column:
    """Monday 1 to Sunday 7."""
    return (F.weekday(date) + 1).cast("int")


def quarter_label(date: Column | str) -> Column:
    return F.concat(F.lit("Q"), F.quarter(date).cast("string"))


def with_date_parts(df: DataFrame, date: str = "Date") -> DataFrame:
    return df.withColumns({
        "Day": F.dayofmonth(date).cast("int"),
        "Month": F.month(date).cast("int"),
        "Year": F.year(date).cast("int"),
        "WeekOfYear": F.weekofyear(date).cast("int"),
    })


def with_quarter(df: DataFrame, date: str = "Date") -> DataFrame:
    return df.withColumns({"Quarter": F.quarter(date).cast("int"), "QuarterLabel": quarter_label(date)})


def has_time_of_day(timestamp: Column | str) -> Column:
    """Aggregate: does any value carry an hour or a minute?"""
    return F.coalesce(F.bool_or((F.hour(timestamp) != 0) | (F.minute(timestamp) != 0)), F.lit(False))


def horizon_dates(start: Column, days: Column | int) -> Column:
    """Array of ``days`` consecutive dates from ``start``."""
    days = F.lit(days) if isinstance(days, int) else days
    return F.sequence(start, F.date_add(start, days - 1), F.expr("interval 1 day"))
