"""Tree learners on supervised tables: boosted regressors, importances, search and comparison."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlane.operators import cleaning, folds, metrics
from wattlane.operators.params import attach
from wattlane.panel import Panel
from wattlane.session import materialize

# Default parameters of the two boosted sets, under the learner's own names.
BOOSTED_A = {"maxIter": 100, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8, "minInstancesPerNode": 1,
             "featureSubsetStrategy": "0.8", "seed": 42}
BOOSTED_B = {"maxIter": 100, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8, "minInstancesPerNode": 20,
             "featureSubsetStrategy": "0.8", "seed": 42}


def boosted_a(target: str, **overrides) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol=target, **{**BOOSTED_A, **overrides})


def boosted_b(target: str, **overrides) -> GBTRegressor:
    """Second set; give ``validationIndicatorCol`` to stop early on later rows."""
    return GBTRegressor(featuresCol="features", labelCol=target, **{**BOOSTED_B, **overrides})


def forest(target: str, **overrides) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features", labelCol=target, **{"numTrees": 100, "seed": 42, **overrides}
    )


def linear(target: str, **overrides) -> LinearRegression:
    return LinearRegression(featuresCol="features", labelCol=target, **{"regParam": 0.0, **overrides})


# Extension point: a name and a function (target, **parameters) -> estimator.
LEARNERS: dict[str, Callable] = {
    "boosted_a": boosted_a, "boosted_b": boosted_b, "forest": forest, "linear": linear,
}


def register(name: str, builder: Callable) -> None:
    LEARNERS[name] = builder


def fit(train: DataFrame, features: Sequence[str], estimator) -> PipelineModel:
    """Fit on the rows that have every feature."""
    names = cleaning.drop_target_columns(features)
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[assembler, estimator]).fit(train.dropna(subset=list(names)))


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Every row with its prediction; NULL where a feature is missing."""
    complete = F.lit(True)
    for name in model.stages[0].getInputCols():
        complete = complete & F.col(name).isNotNull()
    scored = model.transform(rows).drop("features")
    return scored.withColumn("prediction", F.when(complete, F.col("prediction")))


def importances(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """One row per feature, largest first; as long as the feature list."""
    spark = SparkSession.active()
    vector = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(cleaning.drop_target_columns(features), vector)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def forest_importances(df: DataFrame, target: str, features: Sequence[str], trees: int = 100) -> DataFrame:
    """Importances from a random forest on mean-filled, scaled features."""
    names = cleaning.drop_target_columns(features)
    filled = cleaning.impute(df.dropna(subset=[target]), names)
    assembler = VectorAssembler(inputCols=list(names), outputCol="raw")
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True)
    model = Pipeline(stages=[assembler, scaler, forest(target, numTrees=trees)]).fit(filled)
    return importances(model, names)


def top_features(table: DataFrame, k: int = 10) -> DataFrame:
    return table.orderBy(F.desc("importance"), "feature").limit(k)


def split_metrics(model: PipelineModel, rows: DataFrame, target: str, by: str = "split") -> DataFrame:
    """Metrics of a fitted model on each side of a split."""
    return metrics.regression_metrics(predict(model, rows), [by], target, "prediction")


def compare(
    train: DataFrame, test: DataFrame, features: Sequence[str], target: str, models: Mapping[str, object]
) -> DataFrame:
    """Fit several estimators on the same rows; one row of test metrics per model."""
    scored = None
    for name, estimator in models.items():
        one = metrics.regression_metrics(
            predict(fit(train, features, estimator), test), (), target, "prediction"
        ).select(F.lit(name).alias("model"), *metrics.METRICS)
        scored = one if scored is None else scored.unionByName(one)
    return scored


def random_grid(ranges: Mapping[str, Sequence], trials: int, seed: int = 42) -> list[dict]:
    """``trials`` parameter sets: a two-number tuple is a range to draw from, ``("log", low, high)`` one whose
    logarithm is drawn evenly, a list is a choice."""
    draw = random.Random(seed)

    def one(values: Sequence):
        if isinstance(values, tuple) and values[0] == "log":
            return math.exp(draw.uniform(math.log(values[1]), math.log(values[2])))
        if isinstance(values, tuple):
            low, high = values
            whole = isinstance(low, int) and isinstance(high, int)
            return draw.randint(low, high) if whole else draw.uniform(low, high)
        return draw.choice(list(values))

    return [{name: one(values) for name, values in ranges.items()} for _ in range(trials)]


def mark_later(rows: DataFrame, panel: Panel, share: float = 0.2, name: str = "_later") -> DataFrame:
    """Flag the later ``share`` of each series' own rows (``pos`` runs without gaps inside a series)."""
    ends = rows.groupBy(*panel.keys).agg(F.min(panel.pos).alias("_first"), F.max(panel.pos).alias("_last"))
    begins = F.col("_first") + F.ceil((F.col("_last") - F.col("_first") + 1) * (1 - share))
    return attach(rows, ends, panel.keys).withColumn(name, F.col(panel.pos) >= begins).drop("_first", "_last")


def search_folds(
    rows: DataFrame, panel: Panel, features: Sequence[str], target: str, builder: Callable,
    grid: Sequence[Mapping], splits: int = 3, keep: float = 0.5, at_once: int = 4,
) -> DataFrame:
    """Score parameter sets on time-ordered folds, halving the field after each fold.

    Fold k is tested by models of earlier rows only.  Sets that are still in the race are fitted as ``at_once``
    concurrent jobs; after a fold the better ``keep`` of them by mean MAE go on (ties to the earlier trial), the last
    fold decides.  One row per set: ``trial``, ``params``, ``folds`` (scored), ``mae`` (mean of these) and ``best``.
    ``rows`` carry ``pos`` without gaps inside a series; they are written once and reread by every fit.
    """
    starts = rows.groupBy(*panel.keys).agg(F.min(panel.pos).alias("_first"))
    dense = attach(rows, starts, panel.keys).withColumn(panel.pos, F.col(panel.pos) - F.col("_first")).drop("_first")
    marked = materialize(folds.assign_time_series_split(dense, panel, splits), "folds")
    scores: dict[int, list[float]] = {i: [] for i in range(len(grid))}
    racing = list(scores)

    def mean(trial: int) -> float:
        return sum(scores[trial]) / len(scores[trial])

    for k in range(splits):
        train = marked.filter(F.col("fold").isNull() | (F.col("fold") < k))
        test = marked.filter(F.col("fold") == k)

        def score(trial: int) -> float:
            model = fit(train, features, builder(target, **grid[trial]))
            found = metrics.regression_metrics(predict(model, test), (), target, "prediction").first()["mae"]
            return math.inf if found is None else found

        with ThreadPoolExecutor(at_once) as pool:
            for trial, mae in zip(racing, pool.map(score, racing)):
                scores[trial].append(mae)
        racing.sort(key=lambda trial: (mean(trial), trial))
        if k < splits - 1:
            racing = racing[: max(1, math.ceil(len(racing) * keep))]
    table = [(i, str(dict(grid[i])), len(scores[i]), mean(i), bool(racing) and i == racing[0]) for i in scores]
    return rows.sparkSession.createDataFrame(table, "trial int, params string, folds int, mae double, best boolean")


def search(
    rows: DataFrame, panel: Panel, features: Sequence[str], target: str, builder: Callable,
    grid: Sequence[Mapping], holdout: float = 0.2,
) -> DataFrame:
    """MAE of each parameter set on the later ``holdout`` share of every series, best first.

    The rows are used once per parameter set, so they are cached for the search.
    """
    ends = rows.groupBy(*panel.keys).agg(F.max(panel.pos).alias("_last"))
    late = F.col(panel.pos) > F.col("_last") * (1 - holdout)
    marked = attach(rows, ends, panel.keys).withColumn("_late", late).drop("_last").persist()
    try:
        tried = []
        for i, params in enumerate(grid):
            model = fit(marked.filter(~F.col("_late")), features, builder(target, **params))
            score = metrics.regression_metrics(predict(model, marked.filter("_late")), (), target, "prediction")
            tried.append((i, str(dict(params)), score.first()["mae"]))
    finally:
        marked.unpersist()
    table = rows.sparkSession.createDataFrame(tried, "trial int, params string, mae double")
    return table.orderBy("mae", "trial")


def cross_validate(
    rows: DataFrame, features: Sequence[str], target: str, estimator, splits: int = 3, fold: str = "fold"
) -> DataFrame:
    """Metrics per time-series split; ``rows`` carry the fold in which they are tested (NULL: none)."""
    scored = None
    for k in range(splits):
        train = rows.filter(F.col(fold).isNull() | (F.col(fold) < k))
        test = rows.filter(F.col(fold) == k)
        one = metrics.regression_metrics(
            predict(fit(train, features, estimator), test), (), target, "prediction"
        ).select(F.lit(k).alias(fold), *metrics.METRICS)
        scored = one if scored is None else scored.unionByName(one)
    return scored

