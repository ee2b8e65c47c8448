"""Spark ML regressors, searches, importances and selection."""

from __future__ import annotations

import random
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.metrics import regression_metrics
from shelfcast.operators.prepare import hash_prefix
from shelfcast.session import forget, with_checkpoints, written

LABEL = "label"
SEED = 42
ROWS_PER_TASK = 1 << 18  # rows that a learner holds, or reads again, in one task, about

# Parameter grids and single-model settings.
GRIDS = {
    "RandomForest": {"numTrees": [50, 100, 200], "maxDepth": [5, 10, 15]},
    "GradientBoosting": {"stepSize": [0.01, 0.05, 0.1], "maxDepth": [3, 5, 7]},
}
RANDOM_SPACE = {"maxIter": [100, 300], "stepSize": [0.05, 0.1], "maxDepth": [10, 15]}
SETTINGS = {
    "forest": {"numTrees": 50, "maxDepth": 15},
    "forest_default": {"numTrees": 100, "maxDepth": 10},
    "boosting": {"maxIter": 500, "stepSize": 0.05, "maxDepth": 5},
    "regularised": {"maxIter": 300, "stepSize": 0.1, "maxDepth": 10, "minInstancesPerNode": 50},
    "refined": {"maxIter": 500, "stepSize": 0.05, "maxDepth": 5, "minInstancesPerNode": 100,
                "subsamplingRate": 0.7, "featureSubsetStrategy": "0.7"},
    "final": {"maxIter": 1000, "stepSize": 0.02, "maxDepth": 4, "minInstancesPerNode": 200,
              "subsamplingRate": 0.6, "featureSubsetStrategy": "0.6"},
}


def estimator(family: str, **params):
    """LinearRegression, RandomForest or GradientBoosting on ``features`` and the log label."""
    common = {"labelCol": LABEL, "featuresCol": "features", "predictionCol": "prediction"}
    if family == "LinearRegression":
        return LinearRegression(**common, **params)
    if family == "RandomForest":
        return RandomForestRegressor(**common, **{"seed": SEED, **params})
    if family == "GradientBoosting":
        return GBTRegressor(**common, **{"seed": SEED, **params})
    raise ValueError(f"unknown model family {family}")


def with_label(df: DataFrame, target: str = "Sales") -> DataFrame:
    return df.withColumn(LABEL, F.log1p(target))


def with_fold(df: DataFrame, folds: int, keys: tuple[str, ...] = ("Store", "Date")) -> DataFrame:
    """Repeatable fold number per key."""
    number = F.conv(hash_prefix(*keys), 16, 10).cast("int")
    return df.withColumn("fold", F.pmod(number, F.lit(folds)).cast("int"))


def combinations_of(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def drawn_from(space: dict[str, list], draws: int, seed: int = SEED) -> list[dict]:
    """``draws`` different parameter sets, seeded."""
    everything = combinations_of(space)
    return random.Random(seed).sample(everything, min(draws, len(everything)))


def spread(train: DataFrame, rows: int = ROWS_PER_TASK) -> DataFrame:
    """The training rows in parts of about ``rows``. Compressed files hold many times the rows that
    fit a task once they are objects, so their sizes do not tell. A table of few rows stays as it is."""
    parts = -(-train.count() // rows)
    keys = [c for c in ("Store", "Date") if c in train.columns]
    return train.repartition(parts, *keys) if parts > _parts(train) else train


def _parts(table: DataFrame) -> int:
    return table.select("*").rdd.getNumPartitions()  # planned anew: a table keeps the parts of its first plan


@contextmanager
def parts_by_rows(table: DataFrame, rows: int = ROWS_PER_TASK) -> Iterator[bool]:
    """While this lasts, files are read in parts of at most about ``rows`` rows of ``table``: as ``spread``,
    without moving a row. Tells whether it does so: a table of few rows stays as it is, and one that lies in
    files of more rows, which may not be cut, or in no files is left to ``spread``."""
    spark, name = table.sparkSession, "spark.sql.files.maxPartitionBytes"
    count, before = table.count(), spark.conf.get(name)
    many = -(-count // rows) > _parts(table)
    if many:
        largest = table.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        many = largest <= rows
    if many:
        size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        spark.conf.set(name, str(max(1, size * rows // (2 * count))))
    try:
        yield many
    finally:
        if many:
            spark.conf.set(name, before)


def fit_parts(model, train: DataFrame):
    """Fit a tree learner, which holds its rows as objects, on parts of about ``ROWS_PER_TASK`` rows."""
    with parts_by_rows(train):
        return model.fit(spread(train))


class Validator(CrossValidator):
    """Cross-validation that reads its rows again for each pass. The original holds both sides of a fold in
    memory, beside what the learner holds of them."""

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        model, settings, evaluator = (self.getOrDefault(p) for p in (self.estimator, self.estimatorParamMaps, self.evaluator))
        sides = self._kFold(dataset)

        def score(case: tuple[int, int]) -> float:
            (train, held_out), setting = sides[case[0]], settings[case[1]]
            return evaluator.evaluate(model.fit(train, setting).transform(held_out, setting))

        cases = list(product(range(len(sides)), range(len(settings))))
        with ThreadPool(min(self.getParallelism(), len(settings))) as pool:
            found = pool.map(inheritable_thread_target(dataset.sparkSession)(score), cases, chunksize=1)
        means, deviations = self._gen_avg_and_std_metrics([found[k:k + len(settings)] for k in range(0, len(found), len(settings))])
        best = int((np.argmax if evaluator.isLargerBetter() else np.argmin)(means))
        return self._copyValues(CrossValidatorModel(model.fit(dataset, settings[best]), means, [], deviations))


def search(
    train: DataFrame, family: str, settings: list[dict], folds: int = 3, metric: str = "r2",
    parallelism: int = 4, keys: tuple[str, ...] = ("Store", "Date"), **fixed,
) -> CrossValidatorModel:
    """Cross-validate each parameter set and refit the best. Folds follow the row key, so a
    lost executor recomputes the same folds."""
    model = estimator(family, **fixed)
    unknown = {k for s in settings for k in s if not model.hasParam(k)}
    if unknown:
        raise ValueError(f"{family} has no setting {sorted(unknown)}")
    settings = [{model.getParam(k): v for k, v in s.items()} for s in settings]
    if family == "GradientBoosting":  # else the plan of a round holds all trees before it
        with_checkpoints(train.sparkSession)
    validator = Validator(
        estimator=model, estimatorParamMaps=settings, numFolds=folds, foldCol="fold", parallelism=parallelism,
        evaluator=RegressionEvaluator(labelCol=LABEL, predictionCol="prediction", metricName=metric),
    )
    if family == "LinearRegression":
        return validator.fit(with_fold(train, folds, keys).select("features", LABEL, "fold"))
    with parts_by_rows(train) as many:
        held = spread(train)
        rows = with_fold(held, folds, keys).select("features", LABEL, "fold")
        if many or held is not train:  # every learner has all cores busy, and side by side they would hold the rows several times
            validator.setParallelism(1)
        if held is train:
            return validator.fit(rows)
        table = written(rows, "folds", ROWS_PER_TASK)  # dealt out once for all fits
        with parts_by_rows(table):
            found = validator.fit(table)
        forget(table)
        return found


def search_scores(fitted: CrossValidatorModel, family: str) -> list[tuple[str, str, float]]:
    """(family, parameters, mean score) of each parameter set."""
    out = []
    for params, score in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics):
        text = ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda x: x[0].name))
        out.append((family, text, float(score)))
    return out


def fit_with_early_stop(
    train: DataFrame, validation: DataFrame, tolerance: float = 0.01, **params
):
    """Boosting that stops adding trees when the validation error no longer falls by ``tolerance``."""
    rows = train.withColumn("is_validation", F.lit(False)).unionByName(validation.withColumn("is_validation", F.lit(True)))
    return fit_parts(estimator("GradientBoosting", validationIndicatorCol="is_validation", validationTol=tolerance, **params), rows)


def full_scorer(preprocessor: PipelineModel, model) -> PipelineModel:
    """Preprocessing and model as one transformer that can be saved."""
    return PipelineModel([*preprocessor.stages, model])


def log_and_sales_metrics(scored: DataFrame, by: list[str] | None = None, open_days: str | None = None) -> DataFrame:
    """Scores on the log scale and, after the inverse transform, on the sales scale, in one pass.

    With ``open_days`` (a 0/1 column) each is also given for open days alone: closed days are
    easy and flatter the overall score.
    """
    actual, predicted = F.col(LABEL), F.col("prediction")
    pairs = [("log", actual, predicted), ("sales", F.expm1(actual), F.expm1(predicted))]
    cases = [F.struct(F.lit(scale).alias("scale"), a.alias("actual"), p.alias("predicted")) for scale, a, p in pairs]
    held = F.array(*cases)
    if open_days:
        only = F.array(*[c.withField("scale", F.concat(c["scale"], F.lit("_open_days"))) for c in cases])
        held = F.when(F.col(open_days) == 1, F.concat(held, only)).otherwise(held)
    by = by or []
    return regression_metrics(scored.select(*by, F.inline(held)), "actual", "predicted", [*by, "scale"])


def importances(spark, model, names: list[str], top: int = 15) -> DataFrame:
    """(feature, importance) of a tree model, largest first. One entry per model input."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(top)


def blend(df: DataFrame, weights: dict[str, float], output: str = "prediction") -> DataFrame:
    """Weighted sum of prediction columns."""
    total = sum((F.col(c) * w for c, w in weights.items()), F.lit(0.0))
    return df.withColumn(output, total)
