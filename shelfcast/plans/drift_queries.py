"""Distribution drift of the facts over time and of a perturbed store table."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import drift
from shelfcast.plans.registry import query, rounded, sql
from shelfcast.sources.canonical import merged, sales, store

NUMERIC = ["Customers", "DayOfWeek", "Open", "Promo", "CompetitionDistance"]
CATEGORICAL = ["StateHoliday", "SchoolHoliday", "StoreType"]
CUT = "1998-01-01"


def _numeric_sql(column: str, reference: str, current: str, by: str = "") -> str:
    """Both distances of one column from running counts over its distinct values."""
    return f"""select '{column}' as "column", max(abs(fr-fc)) as ks, coalesce(sum(abs(fr-fc)*(nv-v)),0) as w1, max(nr) as reference_rows, max(nc) as current_rows,
 (select stddev_pop({column}::double) from {reference}) as std from (
 select v, sum(r) over (order by v)/sum(r) over ()::double as fr, sum(c) over (order by v)/sum(c) over ()::double as fc, lead(v) over (order by v) as nv,
  cast(sum(r) over () as bigint) as nr, cast(sum(c) over () as bigint) as nc from (
  select v, sum(r) as r, sum(c) as c from (select {column}::double as v, 1 as r, 0 as c from {reference} union all select {column}::double, 0, 1 from {current}) where v is not null group by v))"""


def _numeric_output(source: str) -> str:
    return f"""select "column", round(ks,6) as ks, round(w1,4) as w1, round(w1/greatest(std,0.001),6) as w1_norm, reference_rows, current_rows from {source}"""


def _categorical_sql(column: str, reference: str, current: str) -> str:
    return f"""select '{column}' as "column", sqrt(greatest(sum(case when p>0 then p*ln(p/((p+q)/2)) else 0 end + case when q>0 then q*ln(q/((p+q)/2)) else 0 end)/2,0)) as js,
 sum((greatest(q,0.0001)-greatest(p,0.0001))*ln(greatest(q,0.0001)/greatest(p,0.0001))) as psi, sum(case when p>0 then (c-p*nc)*(c-p*nc)/(p*nc) end) as chi2,
 max(nr) as reference_rows, max(nc) as current_rows from (
 select value, r/(sum(r) over ())::double as p, c/(sum(c) over ())::double as q, c, cast(sum(r) over () as bigint) as nr, cast(sum(c) over () as bigint) as nc from (
  select value, sum(r) as r, sum(c) as c from (select cast({column} as varchar) as value, 1 as r, 0 as c from {reference} union all select cast({column} as varchar), 0, 1 from {current}) where value is not null group by value))"""


_SIDES = {
    "older": f"select * from merged where Date < date '{CUT}'",
    "newer": f"select * from merged where Date >= date '{CUT}'",
}
_NUMERIC_SQL = {**_SIDES, "numeric_shift": " union all ".join(f"({_numeric_sql(c, 'older', 'newer')})" for c in NUMERIC)}
ALL_SQL = {
    **_NUMERIC_SQL,
    "categorical_shift": " union all ".join(f"({_categorical_sql(c, 'older', 'newer')})" for c in CATEGORICAL),
    "report": """select "column", 'numeric' as kind, w1/greatest(std,0.001) as score, current_rows from numeric_shift
 union all select "column", 'categorical', js, current_rows from categorical_shift""",
}


def sides(spark, sf_dir):
    rows = merged(spark, sf_dir)
    return rows.where(F.col("Date") < F.lit(CUT).cast("date")), rows.where(F.col("Date") >= F.lit(CUT).cast("date"))


@query(sql(_numeric_output("numeric_shift"), **_NUMERIC_SQL))
def drift_numeric(spark, sf_dir):
    """Kolmogorov-Smirnov and Wasserstein distances of the numeric columns."""
    out = drift.numeric_drift(*sides(spark, sf_dir), NUMERIC)
    return rounded(rounded(out, "ks", "w1_norm"), "w1", places=4)


@query(sql("select \"column\", round(js,6) as js, round(psi,6) as psi, round(chi2,4) as chi2, reference_rows, current_rows from categorical_shift", **ALL_SQL))
def drift_categorical(spark, sf_dir):
    out = drift.categorical_drift(*sides(spark, sf_dir), CATEGORICAL)
    return rounded(rounded(out, "js", "psi"), "chi2", places=4)


@query(sql("select \"column\", kind, round(score,6) as score, 0.1::double as threshold, score >= 0.1 as drifted, current_rows from report", **ALL_SQL))
def drift_columns(spark, sf_dir):
    return rounded(drift.drift_report(*sides(spark, sf_dir), NUMERIC, CATEGORICAL), "score")


@query(sql("""select 'success' as status, round(avg(case when score >= 0.1 then 1.0 else 0.0 end),4) as drift_share, cast(sum(case when score >= 0.1 then 1 else 0 end) as bigint) as drifted_columns_count,
 avg(case when score >= 0.1 then 1.0 else 0.0 end) > 0.3 as requires_retraining from report""", **ALL_SQL))
def drift_summary(spark, sf_dir):
    return drift.drift_summary(drift.drift_report(*sides(spark, sf_dir), NUMERIC, CATEGORICAL))


_FACTOR = "(1.1::double + 0.4::double * (('0x' || substr(md5(cast(Store as varchar)),1,8))::bigint / 4294967296.0::double))"


@query(sql(f"select Store, round(coalesce(CompetitionDistance,0)*{_FACTOR},4) as CompetitionDistance from store"))
def perturbed_store(spark, sf_dir):
    out = drift.perturb(store(spark, sf_dir)).select("Store", "CompetitionDistance")
    return rounded(out, "CompetitionDistance", places=4)


@query(sql(_numeric_output("numeric_shift"),
           moved=f"select Store, coalesce(CompetitionDistance,0)*{_FACTOR} as CompetitionDistance from store",
           numeric_shift=_numeric_sql("CompetitionDistance", "store", "moved")))
def drift_perturbed(spark, sf_dir):
    """Distances between the store table and its perturbed copy."""
    stores = store(spark, sf_dir)
    out = drift.numeric_drift(stores, drift.perturb(stores), ["CompetitionDistance"])
    return rounded(rounded(out, "ks", "w1_norm"), "w1", places=4)


@query(sql("select 'skipped' as status, 0.0::double as drift_share, 0::bigint as drifted_columns_count, false as requires_retraining, (select count(*) from merged) as reference_rows"))
def drift_skipped(spark, sf_dir):
    """A log without rows is reported as skipped, not as stable."""
    rows = merged(spark, sf_dir)
    summary = drift.drift_summary(drift.drift_report(rows, rows.where(F.col("Date").isNull()), NUMERIC, CATEGORICAL))
    return summary.withColumn("reference_rows", rows.agg(F.count("*")).scalar())


TREND_NUMERIC = ["Customers", "Promo"]
_TREND_COLUMNS = ["StateHoliday", "SchoolHoliday", "Open"]
_YEARS = range(1997, 2006)


def _trend_sql() -> str:
    parts = []
    for year in _YEARS:
        current = f"(select * from sales where year(Date) = {year})"
        numeric = " union all ".join(f"(select {year} as Year, w1/greatest(std,0.001) as score, current_rows from ({_numeric_sql(c, 'early', current)}))" for c in TREND_NUMERIC)
        categorical = " union all ".join(f"(select {year} as Year, js as score, current_rows from ({_categorical_sql(c, 'early', current)}))" for c in _TREND_COLUMNS)
        parts += [numeric, categorical]
    return " union all ".join(parts)


@query(sql("""select *, case when drift_share >= 0.5 then 'critical' when drift_share >= 0.3 then 'warning' else 'ok' end as level from (
 select Year, 'success' as status, round(avg(case when score >= 0.1 then 1.0 else 0.0 end),4) as drift_share, cast(sum(case when score >= 0.1 then 1 else 0 end) as bigint) as drifted_columns_count,
 avg(case when score >= 0.1 then 1.0 else 0.0 end) > 0.15 as requires_retraining from trend where current_rows > 0 group by Year)""",
           early="select * from sales where Date < date '1997-01-01'", trend=_trend_sql()))
def drift_trend(spark, sf_dir):
    """Each later year against the years before 1997, with dashboard levels."""
    rows = sales(spark, sf_dir).withColumn("Year", F.year("Date"))
    early, later = rows.where("Year < 1997"), rows.where("Year >= 1997")
    report = drift.drift_report(early, later, TREND_NUMERIC, _TREND_COLUMNS, period="Year")
    return drift.with_level(drift.drift_summary(report, drift.SERVICE_SHARE_THRESHOLD, "Year"))
