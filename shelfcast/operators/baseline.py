"""Closed-form regression of log sales on yesterday's sales and the promotion flag.

The coefficients are moments of the training rows, so the fit is one aggregate that reads
the table once, whatever its size, and stays inside the query plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.timeseries import LAGS, with_production_lags


def training_rows(sales: DataFrame) -> DataFrame:
    """Open days with a known previous day, and their log sales. ``sales`` must carry ``split``."""
    lagged = with_production_lags(sales, lags=LAGS[:1], means=())
    return lagged.where((F.col("Open") == 1) & F.col("sales_lag_1").isNotNull()).withColumn("label", F.log1p("Sales"))


def fit(rows: DataFrame, label: str = "label", first: str = "sales_lag_1", second: str = "Promo") -> DataFrame:
    """One row (intercept, lag_weight, promo_weight) by least squares."""
    m = rows.agg(
        F.avg(label).alias("my"), F.avg(first).alias("m1"), F.avg(second).alias("m2"),
        F.var_pop(first).alias("v1"), F.var_pop(second).alias("v2"),
        F.covar_pop(first, second).alias("c12"),
        F.covar_pop(first, label).alias("c1"), F.covar_pop(second, label).alias("c2"),
    )
    det = F.nullif(F.col("v1") * F.col("v2") - F.col("c12") * F.col("c12"), F.lit(0.0))
    weights = m.select(
        "my", "m1", "m2",
        ((F.col("v2") * F.col("c1") - F.col("c12") * F.col("c2")) / det).alias("lag_weight"),
        ((F.col("v1") * F.col("c2") - F.col("c12") * F.col("c1")) / det).alias("promo_weight"),
    )
    intercept = F.col("my") - F.col("lag_weight") * F.col("m1") - F.col("promo_weight") * F.col("m2")
    return weights.select(intercept.alias("intercept"), "lag_weight", "promo_weight")


def as_struct(model: DataFrame) -> Column:
    """The one-row model as a value usable in any other query."""
    return model.select(F.struct("intercept", "lag_weight", "promo_weight").alias("m")).scalar()


def log_prediction(model: Column, lag: Column, promo: Column) -> Column:
    return model["intercept"] + model["lag_weight"] * lag + model["promo_weight"] * promo


def with_prediction(rows: DataFrame, model: DataFrame) -> DataFrame:
    log = log_prediction(F.col("_model"), F.col("sales_lag_1"), F.col("Promo"))
    scored = rows.withColumn("_model", as_struct(model)).withColumn("log_prediction", log)
    return scored.withColumn("prediction", F.expm1("log_prediction")).drop("_model")
