"""Closed-form model: scores, gates, recursive and what-if forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions.text import signed_percent
from shelfcast.operators import baseline, forecast, metrics, prepare, timeseries
from shelfcast.plans.registry import SPLIT_SQL, day_text, query, rounded, sql
from shelfcast.session import written
from shelfcast.sources.canonical import sales

HORIZON = 7

# Rows, closed-form fit and predictions in SQL.
MODEL_SQL = {
    "training": f"""select *, ln(1+Sales::double) as label from (select *, {SPLIT_SQL} as split, lag(Sales) over (partition by Store order by Date) as sales_lag_1 from sales)
 where Open = 1 and sales_lag_1 is not null""",
    "moments": """select avg(label) as my, avg(sales_lag_1) as m1, avg(Promo) as m2, var_pop(sales_lag_1::double) as v1, var_pop(Promo::double) as v2,
 covar_pop(sales_lag_1::double, Promo::double) as c12, covar_pop(sales_lag_1::double, label) as c1, covar_pop(Promo::double, label) as c2 from training where split = 'train'""",
    "weights": "select my, m1, m2, (v2*c1-c12*c2)/(v1*v2-c12*c12) as b1, (v1*c2-c12*c1)/(v1*v2-c12*c12) as b2 from moments",
    "model": "select my-b1*m1-b2*m2 as b0, b1, b2 from weights",
    "scored": "select t.*, b0+b1*sales_lag_1+b2*Promo as log_prediction, exp(b0+b1*sales_lag_1+b2*Promo)-1 as prediction from training t, model",
}


def _training(spark, sf_dir):
    return baseline.training_rows(prepare.with_split(sales(spark, sf_dir)))


def _model(spark, sf_dir):
    return baseline.fit(_training(spark, sf_dir).where("split = 'train'"))


def _scored(spark, sf_dir):
    return baseline.with_prediction(_training(spark, sf_dir), _model(spark, sf_dir))


@query(sql("select round(b0,6) as intercept, round(b1,12) as lag_weight, round(b2,6) as promo_weight from model", **MODEL_SQL))
def linear_fit(spark, sf_dir):
    out = _model(spark, sf_dir)
    return rounded(rounded(out, "intercept", "promo_weight"), "lag_weight", places=12)


def _metric_sql(actual, predicted):
    return f"""round(sqrt(avg(({actual}-{predicted})*({actual}-{predicted}))),6) as rmse, round(avg(abs({actual}-{predicted})),6) as mae,
 round(1-sum(({actual}-{predicted})*({actual}-{predicted}))/(var_pop({actual})*count(*)),6) as r2, count(*) as n"""


@query(sql(f"""select 'log' as scale, split, {_metric_sql('label', 'log_prediction')} from scored group by split
 union all select 'sales', split, {_metric_sql('Sales::double', 'prediction')} from scored group by split""", **MODEL_SQL))
def eval_metrics(spark, sf_dir):
    """Scores per split on the log scale and on the sales scale."""
    scored = _scored(spark, sf_dir)
    pairs = scored.select("split", F.inline(F.array(
        F.struct(F.lit("log").alias("scale"), F.col("label").alias("actual"), F.col("log_prediction").alias("predicted")),
        F.struct(F.lit("sales").alias("scale"), F.col("Sales").cast("double").alias("actual"), F.col("prediction").alias("predicted")),
    )))
    return rounded(metrics.regression_metrics(pairs, "actual", "predicted", ["scale", "split"]), "rmse", "mae", "r2")


_MODELS_SQL = {
    **MODEL_SQL,
    "means": "select avg(label) as mean_label from training where split = 'train'",
    "rivals": """select split, label, 'linear' as model, log_prediction as p from scored union all select split, label, 'naive', ln(1+sales_lag_1::double) from training
 union all select split, label, 'mean', mean_label from training, means""",
    "scores": f"select model, split, {_metric_sql('label', 'p').replace('round(', '(').replace(',6)', ')')} from rivals group by model, split",
}


def _scores(spark, sf_dir):
    """Scores of three models: the linear fit, yesterday's sales, the training mean."""
    training = _training(spark, sf_dir)
    mean = training.where("split = 'train'").agg(F.avg("label")).scalar()
    scored = baseline.with_prediction(training, _model(spark, sf_dir))
    rivals = scored.select(
        "split", "label",
        F.inline(F.array(
            F.struct(F.lit("linear").alias("model"), F.col("log_prediction").alias("p")),
            F.struct(F.lit("naive").alias("model"), F.log1p("sales_lag_1").alias("p")),
            F.struct(F.lit("mean").alias("model"), mean.alias("p")),
        )),
    )
    return metrics.regression_metrics(rivals, "label", "p", ["model", "split"])


@query(sql("""select *, round((te-tr)/tr*100,4) as gap_percent, case when train_r2 < 0.85 then 'underfitting' when (te-tr)/tr > 0.20 then 'overfitting' else 'balanced' end as verdict
 from (select model, max(case when split='train' then rmse end) as tr, max(case when split='test' then rmse end) as te, round(max(case when split='train' then r2 end),6) as train_r2, round(max(case when split='test' then r2 end),6) as test_r2 from scores group by model)""".replace(
    "select *, round((te", "select model, round(tr,6) as train_rmse, round(te,6) as test_rmse, train_r2, test_r2, round(te-tr,6) as rmse_difference, round((te"), **_MODELS_SQL))
def overfit_gap(spark, sf_dir):
    out = metrics.generalisation(_scores(spark, sf_dir))
    return rounded(rounded(out, "train_rmse", "test_rmse", "train_r2", "test_r2", "rmse_difference"), "gap_percent", places=4)


@query(sql("select model, round(rmse,6) as rmse, round(mae,6) as mae, round(r2,6) as r2 from scores where split='test'", **_MODELS_SQL))
def model_rank(spark, sf_dir):
    scores = _scores(spark, sf_dir).where("split = 'test'")
    return rounded(metrics.rank_models(scores).select("model", "rmse", "mae", "r2"), "rmse", "mae", "r2")


@query(sql("select model, round(r2,6) as r2, r2 >= 0.6 as accepted from scores where split='test' order by scores.r2 desc, model limit 1", **_MODELS_SQL))
def model_choice(spark, sf_dir):
    return rounded(metrics.best_model(_scores(spark, sf_dir).where("split = 'test'")), "r2")


@query(sql("""select model, round(r2,6) as r2, case when r2 < 0.75 then 'None' when r2 > 0.8 then 'Production' else 'Staging' end as stage,
 case when r2 < 0.75 then printf('Not registered: r2 %.4f is under 0.75.', r2) when r2 > 0.8 then 'Registered for Production.' else 'Registered for Staging.' end as status
 from scores where split='test'""", **_MODELS_SQL))
def promotion_gate(spark, sf_dir):
    return rounded(metrics.promotion(_scores(spark, sf_dir).where("split = 'test'")), "r2")


@query(sql("select Store, cast(Date as varchar) as Date, round(Sales,2)::double as actual, round(prediction,2) as predicted from scored where split = 'test'", **MODEL_SQL))
def actual_vs_predicted(spark, sf_dir):
    out = _scored(spark, sf_dir).where("split = 'test'")
    return out.select("Store", day_text().alias("Date"), F.round(F.col("Sales").cast("double"), 2).alias("actual"),
                      F.round("prediction", 2).alias("predicted"))


def _requests(spark, sf_dir):
    """One open request per store from the day after its last one, with its last lags."""
    lagged = timeseries.with_production_lags(sales(spark, sf_dir))
    latest = timeseries.latest_per_store(lagged)
    return latest.select("Store", F.date_add("Date", 1).alias("start_date"), "sales_lag_1")


def _path(spark, sf_dir, days=HORIZON):
    model = baseline.as_struct(_model(spark, sf_dir))
    cases = forecast.scenarios(_requests(spark, sf_dir).withColumn("Promo", F.lit(0))).withColumn("_m", model)
    score = lambda lag, date: baseline.log_prediction(F.col("_m"), lag, F.col("Promo"))
    return forecast.recursive_linear(cases, days, score).drop("_m")


def path_sql(days: int = HORIZON) -> dict[str, str]:
    return {
        **MODEL_SQL,
        "lasts": "select Store, Date + 1 as start_date, l1 from (select Store, Date, lag(Sales) over (partition by Store order by Date) as l1 from sales) qualify row_number() over (partition by Store order by Date desc) = 1",
        "path": f"""select Store, start_date, Promo, 0 as step, start_date as Date, exp(b0+b1*l1+b2*Promo)-1 as prediction from lasts, model, (select 0 as Promo union all select 1)
 union all select Store, start_date, Promo, step+1, Date+1, exp(b0+b1*prediction+b2*Promo)-1 from path, model where step < {days - 1}""",
    }


PATH_SQL = path_sql()


@query(sql("select Store, Promo, cast(Date as varchar) as Date, round(prediction,2) as prediction from path", **PATH_SQL))
def forecast_linear_recursive(spark, sf_dir):
    return _path(spark, sf_dir).select("Store", "Promo", day_text().alias("Date"), F.round("prediction", 2).alias("prediction"))


@query(sql("select Store, Promo, round(sum(prediction),2) as total_estimated_sales, round(avg(prediction),2) as mean_daily_sales, count(*) as days from path group by 1, 2", **path_sql(30)))
def forecast_totals(spark, sf_dir):
    """Totals of the longest horizon."""
    out = forecast.totals(_path(spark, sf_dir, 30), ["Store", "Promo"])
    return rounded(out, "total_estimated_sales", "mean_daily_sales", places=2)


@query(sql("select Store as store_id, cast(start_date as varchar) as start_date, cast(max(Date) as varchar) as end_date, round(sum(prediction),2) as total_estimated_sales, count(*) as days, round(max(case when step = 0 then prediction end),2) as first_prediction from path where Promo = 0 group by 1, 2", **PATH_SQL))
def forecast_range(spark, sf_dir):
    """One row per store with its daily forecasts as an array."""
    out = forecast.range_result(_path(spark, sf_dir).where("Promo = 0"))
    return out.select(
        "store_id", day_text("start_date").alias("start_date"), day_text("end_date").alias("end_date"),
        "total_estimated_sales", F.size("daily_forecasts").cast("bigint").alias("days"),
        F.col("daily_forecasts")[0]["prediction"].alias("first_prediction"),
    )


@query(sql("""select Store, round(base,2) as base_total, round(promo,2) as promo_total, round(promo-base,2) as uplift, round(case when base > 0 then (promo-base)/base*100 else 0 end,6) as uplift_percent
 from (select Store, sum(case when Promo=0 then prediction end) as base, sum(case when Promo=1 then prediction end) as promo from path group by 1)""", **PATH_SQL))
def whatif_uplift(spark, sf_dir):
    out = forecast.uplift(forecast.compare_days(_path(spark, sf_dir)))
    return rounded(rounded(out, "base_total", "promo_total", "uplift", places=2), "uplift_percent")


@query(sql("""select Store, printf('%+.1f%%', round(case when base > 0 then (promo-base)/base*100 else 0 end,6)) as change from (
 select Store, sum(case when Promo=0 then prediction end) as base, sum(case when Promo=1 then prediction end) as promo from path group by 1)""", **PATH_SQL))
def whatif_texts(spark, sf_dir):
    """The promotion's effect on each store as it is shown: a percentage with its sign."""
    out = rounded(forecast.uplift(forecast.compare_days(_path(spark, sf_dir))), "uplift_percent")
    return out.select("Store", signed_percent(F.col("uplift_percent")).alias("change"))


@query(sql("select Store, cast(Date as varchar) as Date, round(max(case when Promo=0 then prediction end),2) as base, round(max(case when Promo=1 then prediction end),2) as promo from path group by 1, 2", **PATH_SQL))
def whatif_days(spark, sf_dir):
    out = forecast.compare_days(_path(spark, sf_dir))
    return rounded(out.select("Store", day_text().alias("Date"), "base", "promo"), "base", "promo", places=2)


_ALL_LAGS_SQL = {
    "lagged": f"""select *, ln(1+Sales::double) as label from (select *, {SPLIT_SQL} as split, lag(Sales, 1) over w as l1, lag(Sales, 7) over w as l7, lag(Sales, 30) over w as l30,
 avg(Sales) over (partition by Store order by Date rows between 7 preceding and 1 preceding) as m7 from sales window w as (partition by Store order by Date)) where split = 'train' and Open = 1 and l30 is not null""",
    **{f"fit{k}": f"""select my-b1*m1-b2*m2 as b0, b1, b2 from (select my, m1, m2, (v2*c1-c12*c2)/(v1*v2-c12*c12) as b1, (v1*c2-c12*c1)/(v1*v2-c12*c12) as b2 from (
 select avg(label) as my, avg({a}) as m1, avg({b}) as m2, var_pop({a}::double) as v1, var_pop({b}::double) as v2, covar_pop({a}::double, {b}::double) as c12,
 covar_pop({a}::double, label) as c1, covar_pop({b}::double, label) as c2 from lagged))""" for k, (a, b) in enumerate((("l1", "m7"), ("l7", "l30")))},
    "weighed": "select (f.b0+g.b0)/2 as b0, f.b1/2 as w1, f.b2/2 as wm, g.b1/2 as w7, g.b2/2 as w30 from fit0 f, fit1 g",
    "rings": """select Store, max(Date) + 1 as start_date, list_concat(list_resize([]::double[], (30-count(*))::bigint, 0.0::double), list(Sales::double order by Date)) as ring
 from (select * from sales qualify row_number() over (partition by Store order by Date desc) <= 30) group by Store""",
    "steps": """select Store, start_date, 0 as step, ring from rings
 union all select Store, start_date, step+1, list_append(ring[2:30], exp(b0+w1*ring[30]+w7*ring[24]+w30*ring[1]+wm*(ring[24]+ring[25]+ring[26]+ring[27]+ring[28]+ring[29]+ring[30])/7)-1) from steps, weighed where step < 14""",
}


@query(sql("select Store, cast(start_date + step::int - 1 as varchar) as Date, round(ring[30],2) as prediction from steps where step > 0", **_ALL_LAGS_SQL))
def forecast_all_lags(spark, sf_dir):
    """Fourteen days ahead for every store; lag 1, 7 and 30 and the rolling mean all move along."""
    facts = sales(spark, sf_dir)
    history = timeseries.with_production_lags(prepare.with_split(facts), exclude_current=True)
    learn = written(history.where((F.col("split") == "train") & (F.col("Open") == 1) & F.col("sales_lag_30").isNotNull())
                    .withColumn("label", F.log1p("Sales")), "lag-rows")
    pairs = [("sales_lag_1", "sales_roll_mean_7"), ("sales_lag_7", "sales_lag_30")]
    fits = [baseline.as_struct(baseline.fit(learn, first=a, second=b)) for a, b in pairs]
    requests = forecast.newest_sales(facts).withColumn("start_date", F.date_add("last_date", 1)).drop("last_date")

    def score(lags, date):
        scores = [baseline.log_prediction(F.col(f"_m{k}"), lags[a], lags[b]) for k, (a, b) in enumerate(pairs)]
        return (scores[0] + scores[1]) / 2

    path = forecast.recursive_lags(requests.withColumns({f"_m{k}": m for k, m in enumerate(fits)}), 14, score)
    return path.select("Store", day_text().alias("Date"), F.round("prediction", 2).alias("prediction"))


_WEIGHTS = ["DayOfWeek", "Promo", "SchoolHoliday", "Customers", "sales_lag_1", "sales_lag_7"]


@query()
def attribution_top5(spark, sf_dir):
    """Largest contributions to each store's latest linear score, weights fitted on training rows."""
    from shelfcast.operators import features, models

    rows = timeseries.with_production_lags(prepare.with_split(sales(spark, sf_dir))).na.drop(subset=["sales_lag_30"])
    rows = written(rows.select("Store", "Date", "split", "Sales", *_WEIGHTS), "lag-rows")  # read for the scales, the fit and the latest days
    train = rows.where("split = 'train'")
    fitted = features.fit(train, _WEIGHTS, [])
    model = models.estimator("LinearRegression").fit(fitted.model.transform(models.with_label(train)))
    weights = dict(zip(fitted.feature_names, model.coefficients.toArray().tolist()))
    latest = timeseries.latest_per_store(rows, _WEIGHTS)
    scored = forecast.attribution(fitted.model.transform(latest), weights)
    return scored.select("Store", F.posexplode("explanation").alias("place", "e")).select(
        "Store", "place", F.col("e.feature").alias("feature"), F.round("e.contribution", 6).alias("contribution")
    )
