"""Table schemas, column groups and the declarative rule set."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SALES_SCHEMA = T.StructType([
    T.StructField("Store", T.LongType(), False),
    T.StructField("DayOfWeek", T.IntegerType(), False),
    T.StructField("Date", T.DateType(), False),
    T.StructField("Sales", T.LongType(), False),
    T.StructField("Customers", T.LongType(), False),
    T.StructField("Open", T.IntegerType(), False),
    T.StructField("Promo", T.IntegerType(), False),
    T.StructField("StateHoliday", T.StringType(), False),
    T.StructField("SchoolHoliday", T.IntegerType(), False),
])

STORE_SCHEMA = T.StructType([
    T.StructField("Store", T.LongType(), False),
    T.StructField("StoreType", T.StringType(), False),
    T.StructField("Assortment", T.StringType(), False),
    T.StructField("CompetitionDistance", T.DoubleType(), True),
    T.StructField("CompetitionOpenSinceMonth", T.DoubleType(), True),
    T.StructField("CompetitionOpenSinceYear", T.DoubleType(), True),
    T.StructField("Promo2", T.IntegerType(), False),
    T.StructField("Promo2SinceWeek", T.DoubleType(), True),
    T.StructField("Promo2SinceYear", T.DoubleType(), True),
    T.StructField("PromoInterval", T.StringType(), True),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

LINEITEM_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()),
    T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()),
    T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()),
    T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])

REQUEST_SCHEMA = T.StructType([
    T.StructField("store", T.LongType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("Date", T.StringType()),
    T.StructField("open", T.IntegerType()),
    T.StructField("Promo", T.IntegerType()),
    T.StructField("StateHoliday", T.StringType()),
    T.StructField("SchoolHoliday", T.IntegerType()),
    T.StructField("StoreType", T.StringType()),
    T.StructField("Assortment", T.StringType()),
    T.StructField("CompetitionDistance", T.DoubleType()),
])

LAG_COLUMNS = ["sales_lag_1", "sales_lag_7", "sales_lag_30", "sales_roll_mean_7"]

NUMERIC_FEATURES = [
    "DayOfWeek", "Open", "Promo", "SchoolHoliday", "CompetitionDistance",
    *LAG_COLUMNS, "Day", "Month", "Year", "WeekOfYear",
]
CATEGORICAL_FEATURES = ["StoreType", "Assortment", "StateHoliday"]

# Notebook variant: log-sales lags on open days.
LOG_FEATURES = [
    "Store", "DayOfWeek", "Promo", "StateHoliday", "SchoolHoliday", "StoreType", "Assortment",
    "CompetitionDistance", "CompetitionOpenMonths", "Promo2", "Promo2OpenMonths",
    "Year", "Month", "Day", "WeekOfYear",
    "lag_1", "lag_2", "lag_3", "lag_7", "lag_14", "lag_30",
    "rolling_mean_3", "rolling_mean_7", "rolling_std_7",
]
LEAKING_COLUMNS = ["HasSales", "SalesPerCustomer"]
PRUNED_FEATURES = ["lag_30", "lag_14", "Month"]


@dataclass(frozen=True)
class Rule:
    """What one column must satisfy. ``kind`` is integer, number, text or date."""

    kind: str
    nullable: bool = True
    minimum: float | None = None
    maximum: float | None = None
    allowed: tuple | None = None


# Column rules of the two input tables.
SALES_RULES = {
    "Store": Rule("integer", False, 1, 1115),
    "DayOfWeek": Rule("integer", False, 1, 7),
    "Date": Rule("date", False),
    "Sales": Rule("integer", False, 0, 50000),
    "Customers": Rule("integer", False, 0),
    "Open": Rule("integer", False, allowed=(0, 1)),
    "Promo": Rule("integer", False, allowed=(0, 1)),
    "StateHoliday": Rule("text", False, allowed=("0", "a", "b", "c")),
    "SchoolHoliday": Rule("integer", False, allowed=(0, 1)),
}
STORE_RULES = {
    "Store": Rule("integer", False),
    "StoreType": Rule("text", False, allowed=("a", "b", "c", "d")),
    "Assortment": Rule("text", False, allowed=("a", "b", "c")),
    "CompetitionDistance": Rule("number"),
    "CompetitionOpenSinceMonth": Rule("number"),
    "CompetitionOpenSinceYear": Rule("number"),
    "Promo2": Rule("integer", False, allowed=(0, 1)),
    "Promo2SinceWeek": Rule("number"),
    "Promo2SinceYear": Rule("number"),
    "PromoInterval": Rule("text"),
}


def merge_rules(*rule_sets: dict[str, Rule]) -> dict[str, Rule]:
    """One rule per column; where two sets name the same column the later set wins."""
    merged: dict[str, Rule] = {}
    for rules in rule_sets:
        merged.update(rules)
    return merged


def rules_from(described: dict[str, dict]) -> dict[str, Rule]:
    """Rules from a parsed description: dtype, nullable, min, max, allowed_values per column."""
    kinds = {"int64": "integer", "float64": "number", "object": "text", "datetime64[ns]": "date"}
    return {
        column: Rule(
            "date" if column == "Date" else kinds[d["dtype"]], d.get("nullable", True), d.get("min"), d.get("max"),
            tuple(d["allowed_values"]) if "allowed_values" in d else None,
        )
        for column, d in described.items()
    }


MERGED_RULES = merge_rules(SALES_RULES, STORE_RULES)
