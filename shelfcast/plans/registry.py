"""Named queries over the given tables and, where SQL can say it, the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""
    def register(function: Query) -> Query:
        if function.__name__ in QUERIES:
            raise ValueError(f"two queries named {function.__name__}")
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


# The tables of sources/canonical.py in DuckDB's SQL.
SALES_SQL = """
 select cast(l_suppkey as bigint) as Store, cast(l_shipdate as date) as Date,
  cast(isodow(cast(l_shipdate as date)) as int) as DayOfWeek,
  cast(case when isodow(cast(l_shipdate as date))=7 and l_suppkey%2=0 then 0
       else sum(cast(round(l_extendedprice) as bigint)) end as bigint) as Sales,
  cast(case when isodow(cast(l_shipdate as date))=7 and l_suppkey%2=0 then 0
       else count(distinct l_orderkey) end as bigint) as Customers,
  cast(case when isodow(cast(l_shipdate as date))=7 and l_suppkey%2=0 then 0 else 1 end as int) as Open,
  cast(max(case when l_discount>0.05 then 1 else 0 end) as int) as Promo,
  case when month(cast(l_shipdate as date))=12 and day(cast(l_shipdate as date)) in (25,26) then 'c'
       when month(cast(l_shipdate as date))=4 and day(cast(l_shipdate as date))<4 then 'b'
       when month(cast(l_shipdate as date))=1 and day(cast(l_shipdate as date))=1 then 'a' else '0' end as StateHoliday,
  cast(case when month(cast(l_shipdate as date)) in (7,8) then 1 else 0 end as int) as SchoolHoliday
 from lineitem group by l_suppkey, cast(l_shipdate as date)"""

STORE_SQL = """
 select cast(s_suppkey as bigint) as Store, substr('abcd',cast(s_nationkey%4+1 as int),1) as StoreType,
  substr('abc',cast(s_suppkey%3+1 as int),1) as Assortment,
  case when s_suppkey%10=7 then null else cast(round(abs(s_acctbal)) as double) end as CompetitionDistance,
  case when s_suppkey%10=7 or s_suppkey%3=0 then null else cast(s_suppkey%12+1 as double) end as CompetitionOpenSinceMonth,
  case when s_suppkey%10=7 or s_suppkey%3=0 then null else cast(1990+s_suppkey%8 as double) end as CompetitionOpenSinceYear,
  cast(s_suppkey%2 as int) as Promo2,
  case when s_suppkey%2=1 then cast(s_suppkey%50+1 as double) end as Promo2SinceWeek,
  case when s_suppkey%2=1 then cast(1994+s_suppkey%4 as double) end as Promo2SinceYear,
  case when s_suppkey%2=1 then case cast(s_suppkey%3 as int) when 0 then 'Jan,Apr,Jul,Oct'
       when 1 then 'Feb,May,Aug,Nov' else 'Mar,Jun,Sept,Dec' end end as PromoInterval
 from supplier"""

BASE = f"""with recursive sales as materialized ({SALES_SQL}),
store as materialized ({STORE_SQL}),
merged as (select sales.*, store.* exclude (Store) from sales left join store on sales.Store = store.Store)"""

SPLIT_SQL = "case when substr(md5(concat(cast(Store as varchar), '|', cast(Date as varchar))),1,4) < '3333' then 'test' else 'train' end"


ONCE = ("training", "moments", "weights", "model", "lagged", "weighed")  # steps that the SQL reads several times


def sql(body: str, **tables: str) -> str:
    """The canonical tables, further named subqueries in order, then the final SELECT."""
    more = "".join(f",\n{name} as {'materialized ' if name in ONCE else ''}({text})" for name, text in tables.items())
    return f"{BASE}{more}\n{body}"


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def day_text(column: Column | str = "Date") -> Column:
    """A date as ISO text, which every client prints alike."""
    return F.date_format(column, "yyyy-MM-dd")


def time_text(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
