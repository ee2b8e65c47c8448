"""Join, fills, scalar columns, filters, splits and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions import business as B
from shelfcast.functions import dates as D
from shelfcast.functions import text as X
from shelfcast.operators import explore, prepare
from shelfcast.plans.registry import SPLIT_SQL, day_text, query, rounded, sql
from shelfcast.schemas import LEAKING_COLUMNS
from shelfcast.sources.canonical import merged, sales, store, table


@query(sql("""select Store, cast(Date as varchar) as Date, Sales, Customers, Promo, StoreType, Assortment,
 CompetitionDistance, CompetitionOpenSinceMonth, CompetitionOpenSinceYear, Promo2, Promo2SinceWeek, Promo2SinceYear, PromoInterval from merged"""))
def join_fact_store(spark, sf_dir):
    return merged(spark, sf_dir).select(
        "Store", day_text().alias("Date"), "Sales", "Customers", "Promo", "StoreType", "Assortment",
        "CompetitionDistance", "CompetitionOpenSinceMonth", "CompetitionOpenSinceYear",
        "Promo2", "Promo2SinceWeek", "Promo2SinceYear", "PromoInterval",
    )


@query(sql("""select 'before' as stage, count(*) as rows, 9 as columns from sales
 union all select 'after', count(*), 18 from merged"""))
def join_shape(spark, sf_dir):
    return explore.join_shape(sales(spark, sf_dir), merged(spark, sf_dir))


@query(sql("""select Store, cast(coalesce(CompetitionOpenSinceMonth,0) as int) as CompetitionOpenSinceMonth,
 cast(coalesce(CompetitionOpenSinceYear,0) as int) as CompetitionOpenSinceYear,
 cast(coalesce(Promo2SinceWeek,0) as int) as Promo2SinceWeek, cast(coalesce(Promo2SinceYear,0) as int) as Promo2SinceYear,
 coalesce(PromoInterval,'No Promo') as PromoInterval from store"""))
def fill_constant(spark, sf_dir):
    filled = prepare.fill_constants(store(spark, sf_dir), {
        "CompetitionOpenSinceMonth": 0, "CompetitionOpenSinceYear": 0,
        "Promo2SinceWeek": 0, "Promo2SinceYear": 0, "PromoInterval": "No Promo",
    })
    whole = ["CompetitionOpenSinceMonth", "CompetitionOpenSinceYear", "Promo2SinceWeek", "Promo2SinceYear"]
    return prepare.cast_columns(filled, {c: "int" for c in whole}).select("Store", *whole, "PromoInterval")


@query(sql("""select Store, round(coalesce(CompetitionDistance, (select quantile_cont(CompetitionDistance,0.5) from store)),6) as CompetitionDistance,
 round(coalesce(Promo2SinceWeek, (select quantile_cont(Promo2SinceWeek,0.5) from store)),6) as Promo2SinceWeek from store"""))
def fill_median(spark, sf_dir):
    filled = prepare.fill_medians(store(spark, sf_dir), ["CompetitionDistance", "Promo2SinceWeek"])
    return rounded(filled.select("Store", "CompetitionDistance", "Promo2SinceWeek"), "CompetitionDistance", "Promo2SinceWeek")


def _mode_sql(column: str) -> str:
    return f"(select {column} from store where {column} is not null group by 1 order by count(*) desc, 1 limit 1)"


@query(sql(f"""select Store, coalesce(CompetitionOpenSinceMonth, {_mode_sql('CompetitionOpenSinceMonth')}) as CompetitionOpenSinceMonth,
 coalesce(CompetitionOpenSinceYear, {_mode_sql('CompetitionOpenSinceYear')}) as CompetitionOpenSinceYear,
 coalesce(PromoInterval, {_mode_sql('PromoInterval')}) as PromoInterval from store"""))
def fill_mode(spark, sf_dir):
    columns = ["CompetitionOpenSinceMonth", "CompetitionOpenSinceYear", "PromoInterval"]
    return prepare.fill_modes(store(spark, sf_dir), columns).select("Store", *columns)


@query(sql("""select Store, cast(Date as varchar) as Date, cast(day(Date) as int) as Day, cast(month(Date) as int) as Month,
 cast(year(Date) as int) as Year, cast(week(Date) as int) as WeekOfYear, cast(quarter(Date) as int) as Quarter,
 concat('Q', quarter(Date)) as QuarterLabel, cast(isodow(Date) as int) as Weekday,
 cast(case when DayOfWeek >= 6 then 1 else 0 end as int) as IsWeekend, cast(Date + 7 as varchar) as NextWeek from sales"""))
def date_parts(spark, sf_dir):
    parts = D.with_quarter(D.with_date_parts(sales(spark, sf_dir).select("Store", "Date", "DayOfWeek")))
    return parts.select(
        "Store", day_text().alias("Date"), "Day", "Month", "Year", "WeekOfYear", "Quarter", "QuarterLabel",
        D.iso_weekday("Date").alias("Weekday"), B.is_weekend().alias("IsWeekend"),
        day_text(F.date_add("Date", 7)).alias("NextWeek"),
    )


def _filled(spark, sf_dir):
    """Facts and store columns as the feature steps expect them: no nulls, whole numbers."""
    whole = ["CompetitionOpenSinceMonth", "CompetitionOpenSinceYear", "Promo2SinceWeek", "Promo2SinceYear"]
    filled = prepare.fill_constants(merged(spark, sf_dir), {**{c: 0 for c in whole}, "PromoInterval": "No Promo"})
    return prepare.cast_columns(filled, {c: "int" for c in whole})


@query(sql("""select Store, cast(Date as varchar) as Date,
 cast(case when coalesce(CompetitionOpenSinceYear,0)=0 then 0 else greatest(0, (year(Date)-CompetitionOpenSinceYear)*12 + month(Date)-CompetitionOpenSinceMonth) end as int) as CompetitionOpenMonths,
 cast(case when coalesce(Promo2SinceYear,0)=0 then 0 else greatest(0.0, round((year(Date)-Promo2SinceYear)*12 + (week(Date)-Promo2SinceWeek)/4.345::double, 1)) end as double) as Promo2OpenMonths,
 round(Sales/(Customers+1e-5::double),4) as SalesPerCustomer,
 cast(case when StateHoliday='0' then 0 else 1 end as int) as IsHoliday,
 cast(Promo*case when StateHoliday='0' then 0 else 1 end as int) as Promo_Holiday_Interaction,
 cast(case when DayOfWeek>=6 then 1 else 0 end as int) as IsWeekend from merged"""))
def business_features(spark, sf_dir):
    out = B.with_business_features(D.with_date_parts(_filled(spark, sf_dir)))
    return rounded(out.select(
        "Store", day_text().alias("Date"), "CompetitionOpenMonths", "Promo2OpenMonths", "SalesPerCustomer",
        "IsHoliday", "Promo_Holiday_Interaction", "IsWeekend",
    ), "SalesPerCustomer", places=4)


@query(sql("""select Store, cast(Date as varchar) as Date, round(ln(1+Sales::double),6) as LogSales, round(exp(ln(1+Sales::double))-1,2) as BackSales,
 round(sqrt(Sales::double),6) as RootSales, cast(abs(Sales-50000) as bigint) as Distance from sales"""))
def log_transform(spark, sf_dir):
    return sales(spark, sf_dir).select(
        "Store", day_text().alias("Date"), F.round(B.to_log("Sales"), 6).alias("LogSales"),
        F.round(B.from_log(B.to_log("Sales")), 2).alias("BackSales"),
        F.round(F.sqrt("Sales"), 6).alias("RootSales"), F.abs(F.col("Sales") - 50000).cast("bigint").alias("Distance"),
    )


@query(sql("""select Store, case StoreType when 'a' then 'Small Convenience Store' when 'b' then 'Large Shopping Center'
 when 'c' then 'Standard Supermarket' else 'Extra-Large Hypermarket' end as StoreLabel,
 case Assortment when 'a' then 'Basic (Essential Items Only)' when 'b' then 'Extended (Wide Selection)' else 'Extra (Premium + Niche Items)' end as AssortmentLabel,
 StoreType as StoreCode, cast((CompetitionDistance/1000)*1000 as double) as Metres,
 '$' || printf('%,.2f', CompetitionDistance) as Money from store"""))
def label_maps(spark, sf_dir):
    labelled = store(spark, sf_dir).select(
        "Store", B.code_to_label("StoreType", B.STORE_TYPE_LABELS).alias("StoreLabel"),
        B.code_to_label("Assortment", B.ASSORTMENT_LABELS).alias("AssortmentLabel"), "CompetitionDistance",
    )
    return labelled.select(
        "Store", "StoreLabel", "AssortmentLabel", B.label_to_code("StoreLabel", B.STORE_TYPE_LABELS).alias("StoreCode"),
        B.km_to_metres(F.col("CompetitionDistance") / 1000).alias("Metres"),
        X.dollars(F.col("CompetitionDistance")).alias("Money"),
    )


@query(sql("""select Store, cast(Date as varchar) as Date, Sales from sales where Open = 1 and Sales > 0 and StateHoliday in ('0','a') and Store = (select max(Store) from sales)"""))
def filter_rows(spark, sf_dir):
    """Open, positive and in a set of holidays, for one store: the newest."""
    facts = sales(spark, sf_dir)
    newest = table(spark, sf_dir, "lineitem").agg(F.max("l_suppkey")).scalar()
    held = facts.where((F.col("Open") == 1) & (F.col("Sales") > 0) & F.col("StateHoliday").isin("0", "a"))
    return held.where(F.col("Store") == newest).select("Store", day_text().alias("Date"), "Sales")


@query(sql("select count(*) as rows, count(case when CompetitionDistance is not null and CompetitionOpenSinceMonth is not null and CompetitionOpenSinceYear is not null and Promo2SinceWeek is not null and Promo2SinceYear is not null and PromoInterval is not null then 1 end) as complete_rows from merged"))
def drop_null_rows(spark, sf_dir):
    held = merged(spark, sf_dir)
    complete = prepare.drop_null_rows(held).agg(F.count("*").alias("complete_rows"))
    return held.agg(F.count("*").alias("rows")).withColumn("complete_rows", complete.scalar())


@query(sql("select Store, cast(Date as varchar) as Date, Promo as PromoFlag, Open as IsOpen from sales where Date is not null"))
def project_rename(spark, sf_dir):
    held = B.with_business_features(D.with_date_parts(_filled(spark, sf_dir)))
    slim = prepare.drop_null_rows(held.drop(*LEAKING_COLUMNS), ["Date"])
    return slim.select("Store", day_text().alias("Date"), "Promo", "Open").withColumnsRenamed({"Promo": "PromoFlag", "Open": "IsOpen"})


@query(sql(f"select Store, cast(Date as varchar) as Date, {SPLIT_SQL} as split from sales"))
def split_hash(spark, sf_dir):
    return prepare.with_split(sales(spark, sf_dir)).select("Store", day_text().alias("Date"), "split")


@query(sql("select Store, cast(Date as varchar) as Date, case when year(Date) < (select max(year(Date)) from sales) then 'train' else 'test' end as split from sales"))
def split_year(spark, sf_dir):
    return prepare.year_split(sales(spark, sf_dir)).select("Store", day_text().alias("Date"), "split")


@query(sql("""select Store, cast(Date as varchar) as Date, case when Date <= (select min(Date) from running where seen >= floor(total*0.9::double)) then 'train' else 'test' end as split from sales""",
           running="select Date, sum(count(*)) over (order by Date) as seen, sum(count(*)) over () as total from sales group by Date"))
def split_date_quantile(spark, sf_dir):
    return prepare.date_split(sales(spark, sf_dir)).select("Store", day_text().alias("Date"), "split")


@query(sql("select Store, cast(Date as varchar) as Date, Sales from sales order by md5(concat('42|', Store, '|', cast(Date as varchar))) limit 1000"))
def topn_sample(spark, sf_dir):
    return prepare.sample_rows(sales(spark, sf_dir), 1000, ["Store", "Date"]).select("Store", day_text().alias("Date"), "Sales")


@query(sql(f"""select Store, Sales, Promo, null as Customers, cast(Date as varchar) as Date from sales where {SPLIT_SQL} = 'train'
 union all select Store, Sales, null, Customers, cast(Date as varchar) from sales where {SPLIT_SQL} = 'test'"""))
def union_log(spark, sf_dir):
    both = prepare.with_split(sales(spark, sf_dir))
    older = both.where("split = 'train'").select("Store", "Sales", "Promo", day_text().alias("Date"))
    newer = both.where("split = 'test'").select("Store", "Sales", "Customers", day_text().alias("Date"))
    return prepare.union_log(older, newer)


@query(sql("""select 'StateHoliday' as "column", StateHoliday as value, count(*) as rows from merged where StateHoliday not in ('0','a') group by 2
 union all select 'StoreType', StoreType, count(*) from merged where StoreType not in ('a','b') group by 2"""))
def set_difference(spark, sf_dir):
    return prepare.outside_allowed(merged(spark, sf_dir), {"StateHoliday": ("0", "a"), "StoreType": ("a", "b")})


@query(sql("""select cast(Date as varchar) as Date, Store, Customers, Promo from sales"""))
def shared_columns(spark, sf_dir):
    """Columns a log has in common with the facts, target left out, in the facts' order."""
    facts = sales(spark, sf_dir)
    log = facts.select("Promo", "Store", "Sales", "Customers", "Date", F.lit(1).alias("Extra"))
    return log.select(prepare.shared_columns(facts, log)).withColumn("Date", day_text())


@query(sql("select Store, cast(Date as varchar) as Date, Sales from sales order by Store, Date desc limit 20"))
def head_rows(spark, sf_dir):
    return sales(spark, sf_dir).orderBy("Store", F.desc("Date")).limit(20).select("Store", day_text().alias("Date"), "Sales")


_REQUEST_YEARS = (1993, 1997)


@query(sql("""select Store as store, Date, concat_ws('; ',
  case when not (store > 0) then 'store must be positive' end,
  case when not (year(cast(Date as date)) between 1993 and 1997) then 'Date must be between 1993 and 1997' end,
  case when StateHoliday is null then 'StateHoliday is missing' end,
  case when CompetitionDistance is null then 'CompetitionDistance is missing' end) as reasons
 from (select Store, cast(Date as varchar) as Date, StateHoliday, CompetitionDistance from merged)"""))
def quarantine(spark, sf_dir):
    """Every store-day as a forecast request, with the reasons for which it would be refused."""
    requests = merged(spark, sf_dir).select(
        F.col("Store").alias("store"), "DayOfWeek", day_text().alias("Date"), F.col("Open").alias("open"), "Promo",
        "StateHoliday", "SchoolHoliday", "StoreType", "Assortment", "CompetitionDistance",
    )
    checked = prepare.with_reasons(requests, prepare.request_checks(*_REQUEST_YEARS))
    return checked.select("store", "Date", F.array_join("reasons", "; ").alias("reasons"))


# Twelve of fourteen requests have a fault of their own, so that each reason occurs.
_FAULTS = {
    "store": ("bigint", "case k when 0 then -Store when 11 then 0 else Store end"),
    "DayOfWeek": ("int", "case k when 1 then 8 else DayOfWeek end"),
    "Date": ("string", "case k when 2 then '1996-13-45' when 3 then '1950-01-01' else day end"),
    "open": ("int", "case k when 4 then 2 when 11 then null else Open end"),
    "Promo": ("int", "case k when 5 then null else Promo end"),
    "SchoolHoliday": ("int", "case k when 6 then -1 else SchoolHoliday end"),
    "StateHoliday": ("string", "case when k <> 7 then StateHoliday end"),
    "StoreType": ("string", "case when k <> 8 then StoreType end"),
    "Assortment": ("string", "case when k <> 9 then Assortment end"),
    "CompetitionDistance": ("double", "case when k <> 10 then CompetitionDistance end"),
    "start_date": ("string", "case k when 2 then '1996-13-45' when 3 then '1950-01-01' else day end"),
    "days": ("int", "case k when 5 then null else 1 + day_number % 33 end"),
    "open_status": ("int", "case k when 4 then 2 when 11 then null else Open end"),
    "promo_active": ("int", "case k when 6 then -1 else Promo end"),
}
_REFUSED_SQL = {
    "store must be positive": "not coalesce(store > 0, false)",
    "DayOfWeek must be 1 to 7": "not coalesce(DayOfWeek between 1 and 7, false)",
    "Date must be yyyy-MM-dd": "try_cast(Date as date) is null",
    "Date must be between 1990 and 2000": "year(try_cast(Date as date)) not between 1990 and 2000",
    "open must be 0 or 1": "not coalesce(open between 0 and 1, false)",
    "Promo must be 0 or 1": "not coalesce(Promo between 0 and 1, false)",
    "SchoolHoliday must be 0 or 1": "not coalesce(SchoolHoliday between 0 and 1, false)",
    "StateHoliday is missing": "StateHoliday is null", "StoreType is missing": "StoreType is null",
    "Assortment is missing": "Assortment is null", "CompetitionDistance is missing": "CompetitionDistance is null",
}
_REFUSED_RANGE_SQL = {
    "store must be positive": "not coalesce(store > 0, false)",
    "start_date must be yyyy-MM-dd": "try_cast(start_date as date) is null",
    "start_date must be between 1990 and 2000": "year(try_cast(start_date as date)) not between 1990 and 2000",
    "days must be 1 to 30": "not coalesce(days between 1 and 30, false)",
    "open_status must be 0 or 1": "not coalesce(open_status between 0 and 1, false)",
    "promo_active must be 0 or 1": "not coalesce(promo_active between 0 and 1, false)",
}


def _refused_sql() -> str:
    checks = {"day": _REFUSED_SQL, "range": _REFUSED_RANGE_SQL}
    parts = [f"select '{kind}' as kind, '{reason}' as reason, count(*) as rows from requests where {failed}" for kind, of in checks.items() for reason, failed in of.items()]
    parts += [f"select '{kind}', 'accepted', count(*) from requests where not coalesce({' or '.join(f'({failed})' for failed in of.values())}, false)"
              for kind, of in checks.items()]
    return f"select * from ({' union all '.join(parts)}) where rows > 0"


@query(sql(_refused_sql(),
           numbered="select *, cast(Date as varchar) as day, dayofyear(Date) as day_number, (Store + dayofyear(Date)) % 14 as k from merged",
           requests=f"select {', '.join(f'{text} as {name}' for name, (_, text) in _FAULTS.items())} from numbered"))
def refused_requests(spark, sf_dir):
    """Requests for a day and for a range, faults of all kinds among them: rows refused for each reason
    and rows accepted. Both kinds are checked in one pass over the requests."""
    numbered = merged(spark, sf_dir).withColumns(
        {"day": day_text(), "day_number": F.dayofyear("Date"), "k": (F.col("Store") + F.dayofyear("Date")) % 14})
    requests = numbered.select(*[F.expr(text).cast(kind).alias(name) for name, (kind, text) in _FAULTS.items()])
    checks = {"day": prepare.request_checks(1990, 2000), "range": prepare.range_checks(1990, 2000)}
    found = [F.struct(F.lit(kind).alias("kind"), prepare.reasons(of).alias("reasons")) for kind, of in checks.items()]
    either = F.when(F.size("reasons") == 0, F.array(F.lit("accepted"))).otherwise(F.col("reasons"))
    return requests.select(F.inline(F.array(*found))).select("kind", F.explode(either).alias("reason")).groupBy("kind", "reason").agg(
        F.count("*").alias("rows"))
