"""Impute, scale and one-hot columns with statistics that match the usual definitions.

Fitting collects one number per numeric column and the category lists, both bounded by the
schema. The fitted result is an ordinary ``PipelineModel`` of SQL projections, so it scores
inside code generation, in batches or streams, and can be saved and loaded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.text import quoted
from shelfcast.operators.explore import per_column
from shelfcast.operators.quantiles import modes, quantiles
from shelfcast.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from shelfcast.session import forget, written


@dataclass(frozen=True)
class Fitted:
    medians: dict[str, float]
    means: dict[str, float]
    deviations: dict[str, float]
    modes: dict[str, str]
    categories: dict[str, list[str]]
    model: PipelineModel

    @property
    def feature_names(self) -> list[str]:
        names = [f"scaled_{c}" for c in self.medians]
        return names + [f"{c}_{v}" for c, values in self.categories.items() for v in values]


def medians_of(train: DataFrame, numeric: list[str]) -> DataFrame:
    return quantiles(train, numeric, [0.5]).select("column", F.col("q50").alias("median"))


def scales_of(train: DataFrame, medians: dict[str, float]) -> DataFrame:
    """(column, mean, deviation) after imputation; population deviation."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()}
    return per_column(train, {c: {"mean": F.avg(x), "deviation": F.stddev_pop(x)} for c, x in filled.items()})


def encoders(train: DataFrame, common: dict[str, str]) -> tuple[dict[str, list[str]], list]:
    """Sorted categories of each column after imputation, and the stages that turn the columns
    ``text_<column>`` into sparse vectors ``onehot_<column>``. Any number of categories fits: a row
    holds one entry for each column. An unknown category later has none."""
    if not common:
        return {}, []
    filled = train.select([F.coalesce(F.col(c).cast("string"), F.lit(v)).alias(f"text_{c}") for c, v in common.items()])
    texts, slots = [f"text_{c}" for c in common], [f"slot_{c}" for c in common]
    # The order does not ask how often a category occurs: each combination is counted once, and copies fold before.
    indexer = StringIndexer(inputCols=texts, outputCols=slots, stringOrderType="alphabetAsc", handleInvalid="keep").fit(filled.distinct())
    encoder = OneHotEncoder(inputCols=slots, outputCols=[f"onehot_{c}" for c in common], dropLast=True, handleInvalid="error")
    # The slot of unknown categories is the last and is dropped.
    return {c: list(labels) for c, labels in zip(common, indexer.labelsArray)}, [indexer, encoder.fit(indexer.transform(filled))]


def projection(medians, means, deviations, common) -> str:
    """The fitted transform as a SELECT over ``__THIS__``."""
    parts = ["*"]
    for c, median in medians.items():
        scale = deviations[c] or 1.0  # a constant column becomes 0
        parts.append(f"(coalesce(CAST(`{c}` AS DOUBLE), {median!r}D) - {means[c]!r}D) / {scale!r}D AS `scaled_{c}`")
    parts += [f"coalesce(CAST(`{c}` AS STRING), {quoted(v)}) AS `text_{c}`" for c, v in common.items()]
    return f"SELECT {', '.join(parts)} FROM __THIS__"


def _numeric_statistics(train: DataFrame, numeric: list[str]) -> tuple[dict, dict, dict]:
    if not numeric:
        return {}, {}, {}
    medians = {r["column"]: float(r["median"]) for r in medians_of(train, numeric).collect()}
    missing = [c for c in numeric if c not in medians]
    if missing:
        raise ValueError(f"no known value in {missing}")
    medians = {c: medians[c] for c in numeric}
    scales = {r["column"]: r for r in scales_of(train, medians).collect()}
    means = {c: float(scales[c]["mean"]) for c in numeric}
    deviations = {c: float(scales[c]["deviation"]) for c in numeric}
    return medians, means, deviations


def fit(
    train: DataFrame,
    numeric: list[str] | None = None,
    categorical: list[str] | None = None,
    vector: str = "features",
) -> Fitted:
    """Statistics of the training rows only. An unknown category later becomes all zeros."""
    numeric = NUMERIC_FEATURES if numeric is None else numeric
    categorical = CATEGORICAL_FEATURES if categorical is None else categorical
    # Several passes over a few columns: write those instead of rebuilding the features each time.
    held = written(train.select(*dict.fromkeys([*numeric, *categorical])), "fit-columns")
    medians, means, deviations = _numeric_statistics(held, numeric)
    common = {r["column"]: r["value"] for r in modes(held, categorical).collect()} if categorical else {}
    categories, stages = encoders(held, {c: common[c] for c in categorical})
    forget(held)
    names = [f"scaled_{c}" for c in numeric] + [f"onehot_{c}" for c in categories]
    model = PipelineModel([
        SQLTransformer(statement=projection(medians, means, deviations, common)), *stages,
        VectorAssembler(inputCols=names, outputCol=vector),
    ])
    return Fitted(medians, means, deviations, common, categories, model)


def shared_categories(train: Fitted, test: Fitted) -> dict[str, list[str]]:
    """Categories both splits have, for encodings fitted per split and then aligned."""
    return {c: [v for v in values if v in test.categories.get(c, [])] for c, values in train.categories.items()}


def common_categories(rows: DataFrame, columns: list[str], split: str = "split") -> DataFrame:
    """(feature): one-hot slots whose category occurs in both splits, as distinct sets joined."""
    long = rows.select(split, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot([split], columns, "column", "value")
    held = long.where(F.col("value").isNotNull()).distinct()
    sides = [held.where(F.col(split) == s).select("column", "value") for s in ("train", "test")]
    return sides[0].join(sides[1], ["column", "value"]).select(F.concat_ws("_", "column", "value").alias("feature"))


def active_categories(df: DataFrame, fitted: Fitted, ids: list[str]) -> DataFrame:
    """(ids..., feature): the one-hot slots that are 1."""
    columns = list(fitted.categories)
    held = df
    for stage in fitted.model.stages[:2]:  # filled texts, then their slots
        held = stage.transform(held)
    cases = F.array(*[
        F.struct(F.concat(F.lit(f"{c}_"), F.col(f"text_{c}")).alias("feature"), (F.col(f"slot_{c}") < len(fitted.categories[c])).alias("known"))
        for c in columns
    ])
    return held.select(*ids, F.inline(cases)).where("known").drop("known")
