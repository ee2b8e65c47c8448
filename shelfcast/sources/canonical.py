"""Store-day sales and the store dimension, derived from the order tables.

``sales`` groups line items by (Store, Date), so it holds at most one row per store and
calendar day however many line items a store has, and a window over one store never sees more
rows than there are days. Counting orders deals the line items by (Store, Date, order) first, so a
hot store is spread over all tasks; what is left of it is folded again before the second shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_from(lineitem: DataFrame) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    per_day = lineitem.groupBy(F.col("l_suppkey").cast("bigint").alias("Store"), day.alias("Date")).agg(
        F.sum(F.round("l_extendedprice").cast("bigint")).alias("amount"),
        F.countDistinct("l_orderkey").alias("orders"),
        F.max(F.when(F.col("l_discount") > 0.05, 1).otherwise(0)).alias("Promo"),
    )
    weekday = (F.weekday("Date") + 1).cast("int")
    closed = (weekday == 7) & (F.col("Store") % 2 == 0)
    month, dom = F.month("Date"), F.dayofmonth("Date")
    return per_day.select(
        "Store",
        "Date",
        weekday.alias("DayOfWeek"),
        F.when(closed, 0).otherwise(F.col("amount")).cast("bigint").alias("Sales"),
        F.when(closed, 0).otherwise(F.col("orders")).cast("bigint").alias("Customers"),
        F.when(closed, 0).otherwise(1).cast("int").alias("Open"),
        F.col("Promo").cast("int"),
        F.when((month == 12) & dom.isin(25, 26), "c")
        .when((month == 4) & (dom < 4), "b")
        .when((month == 1) & (dom == 1), "a")
        .otherwise("0")
        .alias("StateHoliday"),
        F.when(month.isin(7, 8), 1).otherwise(0).cast("int").alias("SchoolHoliday"),
    )


def store_from(supplier: DataFrame) -> DataFrame:
    key = F.col("s_suppkey")
    promo2 = key % 2 == 1
    no_competition = key % 10 == 7
    no_opening = no_competition | (key % 3 == 0)
    interval = (
        F.when(key % 3 == 0, "Jan,Apr,Jul,Oct").when(key % 3 == 1, "Feb,May,Aug,Nov").otherwise("Mar,Jun,Sept,Dec")
    )
    return supplier.select(
        key.cast("bigint").alias("Store"),
        F.substring(F.lit("abcd"), (F.col("s_nationkey") % 4 + 1).cast("int"), F.lit(1)).alias("StoreType"),
        F.substring(F.lit("abc"), (key % 3 + 1).cast("int"), F.lit(1)).alias("Assortment"),
        F.when(~no_competition, F.round(F.abs("s_acctbal")).cast("double")).alias("CompetitionDistance"),
        F.when(~no_opening, (key % 12 + 1).cast("double")).alias("CompetitionOpenSinceMonth"),
        F.when(~no_opening, (1990 + key % 8).cast("double")).alias("CompetitionOpenSinceYear"),
        (key % 2).cast("int").alias("Promo2"),
        F.when(promo2, (key % 50 + 1).cast("double")).alias("Promo2SinceWeek"),
        F.when(promo2, (1994 + key % 4).cast("double")).alias("Promo2SinceYear"),
        F.when(promo2, interval).alias("PromoInterval"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_from(table(spark, sf_dir, "lineitem"))


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_from(table(spark, sf_dir, "supplier"))


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfcast.operators.prepare import join_store

    return join_store(sales(spark, sf_dir), store(spark, sf_dir))
