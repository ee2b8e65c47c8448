"""Grouped means, counts, distributions, outliers, correlations and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions.dates import has_time_of_day, with_date_parts, with_quarter
from shelfcast.operators import explore, prepare, validate
from shelfcast.plans.registry import SPLIT_SQL, query, rounded, sql
from shelfcast.schemas import MERGED_RULES, rules_from
from shelfcast.sources.canonical import merged, sales, store, table


def _filled(spark, sf_dir):
    filled = prepare.fill_constants(merged(spark, sf_dir), {"Promo2SinceWeek": 0, "Promo2SinceYear": 0, "PromoInterval": "None"})
    return with_quarter(with_date_parts(filled))


_FILLED_SQL = """select * exclude (Promo2SinceWeek, Promo2SinceYear, PromoInterval), coalesce(Promo2SinceWeek,0) as Promo2SinceWeek,
 coalesce(Promo2SinceYear,0) as Promo2SinceYear, coalesce(PromoInterval,'None') as PromoInterval,
 cast(month(Date) as int) as Month, cast(year(Date) as int) as Year, concat('Q',quarter(Date)) as QuarterLabel from merged"""


def _mean_query(name: str, *keys: str) -> None:
    def run(spark, sf_dir):
        return rounded(explore.mean_sales(_filled(spark, sf_dir), *keys), "mean_sales")

    run.__name__ = name
    names = ", ".join(keys)
    query(sql(f"select {names}, round(avg(Sales),6) as mean_sales from filled group by {names}", filled=_FILLED_SQL))(run)


for _name, *_keys in [
    ("mean_by_month", "Month"), ("mean_by_storetype", "StoreType"), ("mean_by_promo", "Promo"),
    ("mean_by_stateholiday", "StateHoliday"), ("mean_by_dayofweek", "DayOfWeek"),
    ("mean_by_promo2week", "Promo2SinceWeek"), ("mean_by_promo2year", "Promo2SinceYear"),
    ("mean_by_promointerval", "PromoInterval"), ("mean_by_schoolholiday", "SchoolHoliday"),
    ("mean_by_quarter", "QuarterLabel"), ("mean_by_storetype_promo", "StoreType", "Promo"),
    ("mean_by_dow_promo", "DayOfWeek", "Promo"), ("mean_by_month_promo", "Month", "Promo"),
]:
    _mean_query(_name, *_keys)


@query(sql("select cast(year(Date) as int) as Year, cast(sum(Sales) as bigint) as total_sales from sales group by 1"))
def sum_by_year(spark, sf_dir):
    return explore.total_sales(with_date_parts(sales(spark, sf_dir)), "Year")


_COUNTED = ["DayOfWeek", "StateHoliday", "SchoolHoliday", "Promo", "Open"]


@query(sql(" union all ".join(f"select '{c}' as \"column\", cast({c} as varchar) as value, count(*) as rows from sales group by 2" for c in _COUNTED)))
def value_counts(spark, sf_dir):
    return explore.value_counts(sales(spark, sf_dir), _COUNTED).orderBy("column", F.desc("rows"))


_DESCRIBED = ["Sales", "Customers", "CompetitionDistance"]


@query(sql(" union all ".join(
    f"""select '{c}' as "column", count({c}) as n, round(avg({c}),4) as mean, round(stddev_samp({c}),4) as std, cast(min({c}) as double) as min,
 cast(max({c}) as double) as max, round(quantile_cont({c}::double,0.25),4) as q25, round(quantile_cont({c}::double,0.5),4) as q50, round(quantile_cont({c}::double,0.75),4) as q75 from merged"""
    for c in _DESCRIBED)))
def describe_sales(spark, sf_dir):
    return rounded(explore.describe(merged(spark, sf_dir), _DESCRIBED), "mean", "std", "q25", "q50", "q75", places=4)


_MERGED_COLUMNS = ["Store", "Date", "DayOfWeek", "Sales", "Customers", "Open", "Promo", "StateHoliday", "SchoolHoliday", "StoreType", "Assortment",
                   "CompetitionDistance", "CompetitionOpenSinceMonth", "CompetitionOpenSinceYear", "Promo2", "Promo2SinceWeek", "Promo2SinceYear", "PromoInterval"]


@query(sql(" union all ".join(f"select '{c}' as \"column\", count(*) - count({c}) as nulls from merged" for c in _MERGED_COLUMNS)))
def null_counts(spark, sf_dir):
    return explore.null_counts(merged(spark, sf_dir))


@query("""select cast(coalesce(sum(n-1),0) as bigint) as duplicates, cast(sum(n) as bigint) as rows from (select count(*) as n from lineitem
 group by all)""".replace("select count(*) as n from lineitem", "select *, count(*) as n from lineitem"))
def dup_count(spark, sf_dir):
    """Repeats among whole rows."""
    return explore.duplicate_rows(table(spark, sf_dir, "lineitem"))


def _fence_sql(columns, source, beyond):
    return " union all ".join(
        f"""select '{c}' as "column", round(any_value(q25),4) as q25, round(any_value(q75),4) as q75, round(any_value(q25-1.5*(q75-q25)),4) as lower,
 round(any_value(q75+1.5*(q75-q25)),4) as upper, count(case when {beyond.format(c=c)} then 1 end) as outliers, count(*) as n,
 round(count(case when {beyond.format(c=c)} then 1 end)/count(*)*100,6) as outlier_percent
 from {source}, (select quantile_cont({c}::double,0.25) as q25, quantile_cont({c}::double,0.75) as q75 from {source})""" for c in columns)


@query(sql(_fence_sql(["Sales", "Customers"], "sales", "{c} > q75+1.5*(q75-q25) or {c} < q25-1.5*(q75-q25)")))
def iqr_outliers(spark, sf_dir):
    out = explore.outliers(sales(spark, sf_dir), ["Sales", "Customers"])
    return rounded(rounded(out, "q25", "q75", "lower", "upper", places=4), "outlier_percent")


@query(sql(_fence_sql(["LogSales"], "active", "{c} > q75+1.5*(q75-q25)"),
           active="select ln(1+Sales::double) as LogSales from sales where Open=1 and Sales>0"))
def iqr_outliers_upper(spark, sf_dir):
    active = sales(spark, sf_dir).where("Open = 1 and Sales > 0").select(F.log1p("Sales").alias("LogSales"))
    out = explore.outliers(active, ["LogSales"], upper_only=True)
    return rounded(rounded(out, "q25", "q75", "lower", "upper", places=4), "outlier_percent")


@query(sql(" union all ".join(f"select '{c}' as \"column\", round(skewness({c}),4) as skew from sales" for c in ["Sales", "Customers"])))
def skew_sales(spark, sf_dir):
    return rounded(explore.skewness(sales(spark, sf_dir), ["Sales", "Customers"]), "skew", places=4)


_NUMERIC = ["Sales", "Customers", "DayOfWeek", "Open", "Promo", "SchoolHoliday", "CompetitionDistance", "CompetitionOpenSinceYear", "Promo2", "Promo2SinceWeek"]


def _corr_sql(a, b):
    return f"select '{a}' as a, '{b}' as b, corr({a}::double,{b}::double) as r from merged"


@query(sql("select a, b, case when isnan(r) then null else round(r,6) end as corr from pairs",
           pairs=" union all ".join(_corr_sql(a, b) for a in _NUMERIC for b in _NUMERIC if a != b)))
def corr_matrix(spark, sf_dir):
    return rounded(explore.correlations(merged(spark, sf_dir), _NUMERIC), "corr")


@query(sql("select a as \"column\", case when isnan(r) then null else round(r,6) end as corr from pairs",
           pairs=" union all ".join(_corr_sql(a, "Sales") for a in _NUMERIC if a != "Sales")))
def corr_with_sales(spark, sf_dir):
    return rounded(explore.correlation_with(merged(spark, sf_dir), "Sales", _NUMERIC), "corr")


@query(sql("select count(*) as rows, count(case when Sales=0 then 1 end) as zeros, round(count(case when Sales=0 then 1 end)/count(*)*100,2) as zero_percent from sales"))
def zero_share(spark, sf_dir):
    return explore.zero_share(sales(spark, sf_dir))


@query(sql("""select 'SalesPerCustomer' as "column", count(case when isinf(Sales/(Customers+1e-5::double)) then 1 end) as infinite from sales
 union all select 'SalesPerOpenDay', count(case when isinf(r) then 1 end) from (select case when Open = 0 and Sales = 0 then 'inf'::double else Sales/Open::double end as r from sales)"""))
def inf_count(spark, sf_dir):
    """Ratios guarded by an epsilon never run off; a division by a closed day would."""
    closed = (F.col("Open") == 0) & (F.col("Sales") == 0)
    ratios = sales(spark, sf_dir).select(
        (F.col("Sales") / (F.col("Customers") + 1e-5)).alias("SalesPerCustomer"),
        F.when(closed, F.lit(float("inf"))).otherwise(F.try_divide(F.col("Sales"), F.col("Open"))).alias("SalesPerOpenDay"),
    )
    return explore.infinite_counts(ratios, ["SalesPerCustomer", "SalesPerOpenDay"])


@query(sql(" union all ".join(f"""select '{c}' as "column", bin, round(lo+(hi-lo)/50*bin,4) as bin_start, round(lo+(hi-lo)/50*(bin+1),4) as bin_end, coalesce(n,0) as rows from
 (select min({c})::double as lo, max({c})::double as hi from sales where {w}), (select cast(range as int) as bin from range(50)) left join
 (select cast(least(floor((v-lo)/(hi-lo)*50),49) as int) as bin, count(*) as n from (select {c}::double as v from sales where {w}), (select min({c})::double as lo, max({c})::double as hi from sales where {w}) group by 1) using (bin)""" for c, w in [("Sales", "true"), ("Customers", "true")])))
def histogram50(spark, sf_dir):
    return rounded(explore.histogram(sales(spark, sf_dir), ["Sales", "Customers"]), "bin_start", "bin_end", places=4)


@query(sql("""select 'Sales' as "column", bin, round(lo+(hi-lo)/50*bin,4) as bin_start, round(lo+(hi-lo)/50*(bin+1),4) as bin_end, coalesce(n,0) as rows from
 (select min(Sales)::double as lo, max(Sales)::double as hi from sales where Sales>0), (select cast(range as int) as bin from range(50)) left join
 (select cast(least(floor((v-lo)/(hi-lo)*50),49) as int) as bin, count(*) as n from (select Sales::double as v from sales where Sales>0), (select min(Sales)::double as lo, max(Sales)::double as hi from sales where Sales>0) group by 1) using (bin)"""))
def histogram_positive(spark, sf_dir):
    return rounded(explore.histogram(sales(spark, sf_dir).where("Sales > 0"), ["Sales"]), "bin_start", "bin_end", places=4)


@query(sql(" union all ".join(f"""select '{c}' as "column", round(any_value(q25),4) as q25, round(any_value(q50),4) as q50, round(any_value(q75),4) as q75,
 min(case when {c} between q25-1.5*(q75-q25) and q75+1.5*(q75-q25) then {c} end)::double as whisker_low,
 max(case when {c} between q25-1.5*(q75-q25) and q75+1.5*(q75-q25) then {c} end)::double as whisker_high,
 count(case when {c} not between q25-1.5*(q75-q25) and q75+1.5*(q75-q25) then 1 end) as fliers
 from sales, (select quantile_cont({c}::double,0.25) as q25, quantile_cont({c}::double,0.5) as q50, quantile_cont({c}::double,0.75) as q75 from sales)""" for c in ["Sales", "Customers"])))
def boxplot_stats(spark, sf_dir):
    return rounded(explore.box_plot(sales(spark, sf_dir), ["Sales", "Customers"]), "q25", "q50", "q75", places=4)


@query("""select 'orders' as source, bool_or(hour(o_orderdate) <> 0 or minute(o_orderdate) <> 0) as has_time from orders
 union all select 'events', bool_or(hour(ts) <> 0 or minute(ts) <> 0) from events""")
def time_of_day(spark, sf_dir):
    def check(name, column):
        return table(spark, sf_dir, name).agg(F.lit(name).alias("source"), has_time_of_day(column).alias("has_time"))

    return check("orders", "o_orderdate").unionByName(check("events", "ts"))


@query("select cast(hour(ts) as int) as Hour, count(*) as rows from events group by 1")
def rows_by_hour(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.hour("ts").cast("int").alias("Hour")).agg(F.count("*").alias("rows"))


def _rule_sql() -> str:
    kinds = {"integer": {"Store": "bigint", "Sales": "bigint", "Customers": "bigint"}}
    parts = []
    for c, r in MERGED_RULES.items():
        actual = {"text": "string", "number": "double", "date": "date"}.get(r.kind) or kinds["integer"].get(c, "int")
        parts.append(f"select 'exists' as \"check\", '{c}' as \"column\", 'error' as severity, 'present' as observed, 'present' as expected, true as passed")
        parts.append(f"select 'type', '{c}', 'warning', '{actual}', '{r.kind}', true")
        if not r.nullable:
            parts.append(f"select 'not_null', '{c}', 'error', cast(count(*)-count({c}) as varchar), '0', count(*)=count({c}) from train")
        if r.minimum is not None:
            parts.append(f"select 'minimum', '{c}', 'error', cast(min({c}) as varchar), '{r.minimum}', min({c}) >= {r.minimum} from train")
        if r.maximum is not None:
            parts.append(f"select 'maximum', '{c}', 'error', cast(max({c}) as varchar), '{r.maximum}', max({c}) <= {r.maximum} from train")
        if r.allowed is not None:
            listed = ",".join(f"'{v}'" for v in r.allowed)
            expected = ",".join(str(v) for v in r.allowed)
            bad = f"count(case when cast({c} as varchar) not in ({listed}) then 1 end)"
            parts.append(f"select 'allowed', '{c}', 'error', cast({bad} as varchar), '{expected}', {bad} = 0 from train")
    parts.append("""select 'duplicates', '*', 'warning', cast(count(*) - (select count(*) from (select distinct * from train)) as varchar), '0',
 count(*) = (select count(*) from (select distinct * from train)) from train""")
    return " union all ".join(parts)


def _train(spark, sf_dir):
    return prepare.with_split(merged(spark, sf_dir)).where("split = 'train'").drop("split")


@query(sql(_rule_sql(), train=f"select * from merged where {SPLIT_SQL} = 'train'"))
def validation_report(spark, sf_dir):
    return validate.validate(_train(spark, sf_dir))


@query(sql("""select failed = 0 as valid, failed as errors, 0::bigint as warnings, case when failed = 0 then '' else 'Sales goes up to ' || high || '; at most 50000 is allowed.' end as messages
 from (select max(Sales) as high, cast(case when max(Sales) > 50000 then 1 else 0 end as bigint) as failed from train)""",
           train=f"select * from merged where {SPLIT_SQL} = 'train'"))
def validation_status(spark, sf_dir):
    return validate.status(validate.validate(_train(spark, sf_dir)))


_RULE_TEXT = {
    "Store": {"dtype": "int64", "nullable": False},
    "Sales": {"dtype": "int64", "nullable": False, "min": 0, "max": 50000},
    "Promo": {"dtype": "int64", "nullable": False, "allowed_values": [0, 1]},
    "DayOfWeek": {"dtype": "object"},
    "Weather": {"dtype": "object"},
}
_FAULTY_SQL = "select Store, case when Store % 7 = 0 then -Sales else Sales end as Sales, case when Store % 5 = 0 then 2 else Promo end as Promo, DayOfWeek, case when Store % 3 = 0 then null else Open end as Open from sales"


@query(sql("""select 'exists' as "check", c as "column", 'error' as severity, 'present' as observed, 'present' as expected, true as passed, null as message from (select unnest(['Store','Sales','Promo','DayOfWeek']) as c)
 union all select 'exists', 'Weather', 'error', 'missing', 'present', false, 'There is no column Weather.'
 union all select 'type', c, 'warning', k, 'integer', true, null from (select unnest(['Store','Sales','Promo']) as c, unnest(['bigint','bigint','int']) as k)
 union all select 'type', 'DayOfWeek', 'warning', 'int', 'text', false, 'DayOfWeek should be text but is int.'
 union all select 'not_null', c, 'error', '0', '0', true, null from (select unnest(['Store','Sales','Promo']) as c)
 union all select 'minimum', 'Sales', 'error', cast(min(Sales) as varchar), '0', min(Sales) >= 0, case when min(Sales) < 0 then 'Sales goes down to ' || min(Sales) || '; at least 0 is allowed.' end from faulty
 union all select 'maximum', 'Sales', 'error', cast(max(Sales) as varchar), '50000', max(Sales) <= 50000, case when max(Sales) > 50000 then 'Sales goes up to ' || max(Sales) || '; at most 50000 is allowed.' end from faulty
 union all select 'allowed', 'Promo', 'error', cast(count(case when Promo not in (0,1) then 1 end) as varchar), '0,1', false, 'Promo is none of 0,1 in ' || count(case when Promo not in (0,1) then 1 end) || ' rows.' from faulty
 union all select 'duplicates', '*', 'warning', cast(n as varchar), '0', n = 0, case when n > 0 then n || ' rows repeat an earlier row.' end from (select count(*) - (select count(*) from (select distinct * from faulty)) as n from faulty)""",
           faulty=_FAULTY_SQL))
def validation_described(spark, sf_dir):
    """Rules read from a description, over facts with faults planted by arithmetic."""
    facts = sales(spark, sf_dir)
    faulty = facts.select(
        "Store", F.when(F.col("Store") % 7 == 0, -F.col("Sales")).otherwise(F.col("Sales")).alias("Sales"),
        F.when(F.col("Store") % 5 == 0, 2).otherwise(F.col("Promo")).alias("Promo"), "DayOfWeek",
        F.when(F.col("Store") % 3 == 0, None).otherwise(F.col("Open")).alias("Open"),
    )
    return validate.with_messages(validate.validate(faulty, rules_from(_RULE_TEXT)))


@query(sql(f"select \"column\", value, count(*) as rows from (select 'Promo' as \"column\", cast(Promo as varchar) as value from ({_FAULTY_SQL})) where value not in ('0', '1') group by 1, 2"))
def offending_values(spark, sf_dir):
    """The values that break a rule, with their rows."""
    facts = sales(spark, sf_dir).withColumn("Promo", F.when(F.col("Store") % 5 == 0, 2).otherwise(F.col("Promo")))
    return validate.offenders(facts, rules_from(_RULE_TEXT))


@query(sql("select distinct PromoInterval as interval, trim(m) as month from store, unnest(string_split(PromoInterval, ',')) as t(m)"))
def promo_months(spark, sf_dir):
    """The months listed in each promotion interval."""
    return store(spark, sf_dir).select(
        F.col("PromoInterval").alias("interval"), F.explode(F.split("PromoInterval", ",")).alias("month")
    ).distinct()
