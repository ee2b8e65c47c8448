"""Sinks and scans: what is written is read back in full."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.dates import with_date_parts
from shelfcast.operators.prepare import with_split
from shelfcast.plans.registry import SPLIT_SQL, day_text, query, sql
from shelfcast.schemas import SALES_SCHEMA, STORE_SCHEMA
from shelfcast.session import shared_folder
from shelfcast.sources import files
from shelfcast.sources.canonical import sales, store

_SALES_ROWS = "select Store, cast(Date as varchar) as Date, Sales, Customers, StateHoliday, SchoolHoliday from sales"


def _folder(spark, name):
    return f"{shared_folder(spark)}/tables/{name}-{uuid.uuid4().hex}"


def _slim(df):
    return df.select("Store", day_text().alias("Date"), "Sales", "Customers", "StateHoliday", "SchoolHoliday")


@query(sql(_SALES_ROWS))
def csv_sales(spark, sf_dir):
    """Facts through CSV with a declared schema: holiday codes stay text."""
    path = _folder(spark, "sales-csv")
    files.write_csv(sales(spark, sf_dir).select([f.name for f in SALES_SCHEMA.fields]), path)
    return _slim(files.read_csv(spark, path, SALES_SCHEMA))


_BROKEN = "case when Store % 7 = 0 and Store % 5 = 0 then 'both' when Store % 7 = 0 then 'sales' when Store % 5 = 0 then 'day' when Store % 11 = 0 then 'short' when Store % 13 = 0 then 'long' end"
_BROKEN_DAY = "case when kind in ('both', 'day') then '31.12.' || year(Date) else cast(Date as varchar) end"
_BROKEN_SALES = "case when kind in ('both', 'sales') then 'n/a' else cast(Sales as varchar) end"


_CSV_SCHEMA = T.StructType([
    T.StructField("Store", T.LongType()), T.StructField("Date", T.DateType()), T.StructField("Sales", T.LongType()),
    T.StructField("StateHoliday", T.StringType())])


def _broken_csv(spark, sf_dir):
    """Facts as lines without a header, with faults planted by arithmetic on the store."""
    path = _folder(spark, "broken-csv")
    kind = F.coalesce(F.expr(_BROKEN), F.lit(""))
    rows = sales(spark, sf_dir).withColumn("kind", kind)
    fields = [
        F.col("Store").cast("string"),
        F.when(F.col("kind").isin("both", "day"), F.concat(F.lit("31.12."), F.year("Date"))).otherwise(day_text()),
        F.when(F.col("kind").isin("both", "sales"), "n/a").otherwise(F.col("Sales").cast("string")),
        F.when(F.col("kind") != "short", F.col("StateHoliday")),
        F.when(F.col("kind") == "long", "more"),
    ]
    rows.select(F.concat_ws(",", *fields)).write.text(path)  # leaves out nulls: a field less, or one more
    return path


@query(sql(f"""select line, concat_ws('; ', case when kind in ('short', 'long') then 'not 4 fields' end, case when kind in ('both', 'day') then 'Date is no date' end,
 case when kind in ('both', 'sales') then 'Sales is no bigint' end) as reasons, count(*) as lines from (
 select kind, concat_ws(',', cast(Store as varchar), {_BROKEN_DAY}, {_BROKEN_SALES}, case when kind <> 'short' then StateHoliday end, case when kind = 'long' then 'more' end) as line
 from (select *, {_BROKEN} as kind from sales) where kind is not null) group by 1, 2"""))
def csv_quarantine(spark, sf_dir):
    """The lines of a CSV file that do not fit its schema, with the reasons."""
    _, bad = files.read_csv_checked(spark, _broken_csv(spark, sf_dir), _CSV_SCHEMA, header=False)
    return bad.select("line", F.array_join("reasons", "; ").alias("reasons")).groupBy("line", "reasons").agg(F.count("*").alias("lines"))


@query(sql(f"select Store, cast(Date as varchar) as Date, Sales, StateHoliday from (select *, {_BROKEN} as kind from sales) where kind is null"))
def csv_fitting(spark, sf_dir):
    """The lines of the same file that fit."""
    good, _ = files.read_csv_checked(spark, _broken_csv(spark, sf_dir), _CSV_SCHEMA, header=False)
    return good.withColumn("Date", day_text())


@query(sql("select Store, StoreType, Assortment, CompetitionDistance, Promo2SinceWeek, PromoInterval from store"))
def csv_store(spark, sf_dir):
    path = _folder(spark, "store-csv")
    files.write_csv(store(spark, sf_dir), path)
    return files.read_csv(spark, path, STORE_SCHEMA).select(
        "Store", "StoreType", "Assortment", "CompetitionDistance", "Promo2SinceWeek", "PromoInterval"
    )


@query(sql(f"select Store, cast(Date as varchar) as Date, Sales, split from (select *, {SPLIT_SQL} as split from sales)"))
def append_log(spark, sf_dir):
    """A log grown by two appends."""
    path = _folder(spark, "log")
    rows = with_split(sales(spark, sf_dir)).select("Store", "Date", "Sales", "split")
    for split in ("train", "test"):
        files.append_parquet(rows.where(F.col("split") == split), path)
    return files.read_log(spark, path, rows.schema).withColumn("Date", day_text())


@query(sql("select Store, cast(Date as varchar) as Date, Sales from sales where year(Date) = 1997"))
def partitioned_scan(spark, sf_dir):
    """One year of a table laid out by year: other years' files are not opened."""
    path = _folder(spark, "by-year")
    files.write_parquet(with_date_parts(sales(spark, sf_dir)), path, ["Year"])
    return spark.read.parquet(path).where("Year = 1997").select("Store", day_text().alias("Date"), "Sales")


@query(sql("select Store, cast(Date as varchar) as Date, Sales from sales"))
def missing_source(spark, sf_dir):
    """A log that does not exist yet adds no rows and fails nothing."""
    rows = sales(spark, sf_dir).select("Store", "Date", "Sales")
    absent = files.read_or_empty(spark, _folder(spark, "absent"), rows.schema)
    return rows.unionByName(absent).withColumn("Date", day_text())
