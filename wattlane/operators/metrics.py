"""Forecast quality: metrics per group, fold summaries and model choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wattlane.operators.params import attach, finite
from wattlane.panel import Panel

# Hours of the day that count as peak in each metric family.
PEAK_ROWS_OF_DAY = (6, 7, 8, 9, 18, 19, 20, 21)
PEAK_HOURS_DOMAIN = (8, 9, 17, 18, 19)
METRICS = ("mae", "mse", "rmse", "mape", "r2")
# Weights of accuracy, fit and stability in the composite score.
ACCURACY_WEIGHT, FIT_WEIGHT, STABILITY_WEIGHT = 0.4, 0.3, 0.3


def r_squared(actual: Column, predicted: Column) -> Column:
    """1 - SSE/SST; a constant actual gives 1 if the forecast is perfect and 0 if not; NULL below
    two rows."""
    error = actual - predicted
    sse = F.sum(error * error)
    sst = F.var_pop(actual) * F.count(actual)
    constant = F.max(actual) == F.min(actual)
    return (
        F.when(F.count(error) < 2, F.lit(None).cast("double"))
        .when(constant, F.when(sse == 0, 1.0).otherwise(0.0))
        .otherwise(1 - sse / F.nullif(sst, F.lit(0.0)))
    )


def mape(actual: Column, predicted: Column) -> Column:
    """Mean absolute percentage error; undefined (NULL) as soon as one actual is zero."""
    ratio = F.abs((actual - predicted) / F.nullif(actual, F.lit(0.0)))
    return F.when(F.count_if(actual == 0) == 0, F.avg(ratio) * 100)


def metric_columns(actual: str = "actual", predicted: str = "prediction") -> list[Column]:
    y, p = F.col(actual), F.col(predicted)
    error = y - p
    mse = F.avg(error * error)
    return [
        F.avg(F.abs(error)).alias("mae"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        mape(y, p).alias("mape"),
        r_squared(y, p).alias("r2"),
    ]


def regression_metrics(
    df: DataFrame, by: Sequence[str] = (), actual: str = "actual", predicted: str = "prediction"
) -> DataFrame:
    return df.groupBy(*by).agg(*metric_columns(actual, predicted))


def energy_metrics(
    df: DataFrame, panel: Panel, by: Sequence[str] = (), actual: str = "actual", predicted: str = "prediction"
) -> DataFrame:
    """Peak-row MAE, load-factor error and peak-demand error.

    Peak rows are counted from the first row of a group (``pos % 24``); below 24 rows there is no
    peak figure (0).
    """
    y, p = F.col(actual), F.col(predicted)
    peak = (F.col(panel.pos) % 24).isin(*PEAK_ROWS_OF_DAY)

    def load_factor(c: Column) -> Column:
        return F.when(F.max(c) > 0, F.avg(c) / F.nullif(F.max(c), F.lit(0.0))).otherwise(F.lit(0.0))

    return df.groupBy(*by).agg(
        F.avg(F.when(peak, F.abs(y - p))).alias("peak_hour_mae"),
        F.abs(load_factor(y) - load_factor(p)).alias("load_factor_error"),
        F.abs(F.max(y) - F.max(p)).alias("max_demand_error"),
    )


def domain_metrics(
    df: DataFrame, panel: Panel, by: Sequence[str] = (), actual: str = "actual", predicted: str = "prediction"
) -> DataFrame:
    y, p = F.col(actual), F.col(predicted)
    ratio = F.abs(y - p) / F.nullif(y, F.lit(0.0))
    peak = F.hour(panel.ts).isin(*PEAK_HOURS_DOMAIN)
    peak_defined = F.count_if(peak & (y == 0)) == 0
    return df.groupBy(*by).agg(
        mape(y, p).alias("mape"),
        F.max(F.abs(y - p)).alias("max_error"),
        F.abs(F.max(y) - F.max(p)).alias("peak_demand_error"),
        F.when(peak_defined, 1 - F.avg(F.when(peak, ratio))).alias("peak_hour_accuracy"),
    )


def performance(
    df: DataFrame, by: Sequence[str] = (), actual: str = "actual", predicted: str = "prediction",
    error_sign: int = 1,
) -> DataFrame:
    """Monitored figures; ``error_sign`` = 1 means actual minus forecast, -1 the opposite."""
    y, p = F.col(actual), F.col(predicted)
    error = y - p
    return df.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        r_squared(y, p).alias("r2_score"),
        (F.avg(error) * error_sign).alias("mean_error"),
    )


def fold_metrics(forecasts: DataFrame, by: Sequence[str], predicted: str = "naive") -> DataFrame:
    return regression_metrics(forecasts, [*by, "fold"], "actual", predicted)


def fold_summary(folds: DataFrame, by: Sequence[str] = ("model",), names: Sequence[str] = METRICS) -> DataFrame:
    """Mean, population deviation, minimum and maximum of each metric over the folds of a group;
    infinite and missing values are left out."""
    exprs = [F.count(F.lit(1)).cast("long").alias("folds")]
    for m in names:
        v = finite(F.col(m))
        exprs += [
            F.avg(v).alias(f"{m}_mean"),
            F.stddev_pop(v).alias(f"{m}_std"),
            F.min(v).alias(f"{m}_min"),
            F.max(v).alias(f"{m}_max"),
        ]
    return folds.groupBy(*by).agg(*exprs)


def best_by_error(summary: DataFrame, model: str = "model", error: str = "mae_mean", order: str | None = None) -> DataFrame:
    """Model with the lowest finite error; ``order`` (default: the name) decides ties."""
    score = finite(F.col(error))
    tie = F.col(order or model)
    return summary.filter(score.isNotNull()).agg(
        F.min_by(model, F.struct(score, tie)).alias("best_model"), F.min(score).alias("best_error")
    )


def composite_score(mae: Column, r2: Column, spread: Column) -> Column:
    """Weighted accuracy, fit and stability, each mapped to at most 1; infinite figures score 0."""
    accuracy = F.coalesce(1 / (1 + finite(mae)), F.lit(0.0))
    fit = F.greatest(F.lit(0.0), F.coalesce(finite(r2), F.lit(0.0)))
    stability = F.coalesce(1 / (1 + finite(spread)), F.lit(0.0))
    return ACCURACY_WEIGHT * accuracy + FIT_WEIGHT * fit + STABILITY_WEIGHT * stability


def best_by_composite(summary: DataFrame, model: str = "model") -> DataFrame:
    """All models with their composite score and the winner flagged."""
    scored = summary.select(
        model, composite_score(F.col("mae_mean"), F.col("r2_mean"), F.col("mae_std")).alias("score")
    )
    top = scored.agg(F.min_by(F.col(model), F.struct(-F.col("score"), F.col(model))).alias("_best"))
    return attach(scored, top).select(model, "score", (F.col(model) == F.col("_best")).alias("is_best"))


def evaluation_overview(folds: DataFrame, model: str = "model") -> DataFrame:
    """Models evaluated, best model, its MAE, and the mean of the models' MAEs."""
    per_model = folds.groupBy(model).agg(F.avg(finite(F.col("mae"))).alias("_mae"))
    return per_model.agg(
        F.count(F.lit(1)).alias("models"),
        F.min_by(model, F.when(F.col("_mae").isNotNull(), F.struct("_mae", model))).alias("best_model"),
        F.min("_mae").alias("best_mae"),
        F.avg("_mae").alias("average_mae"),
    )


def validation_timeline(folds: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    return folds.select(*by, "fold", "mae")


def validation_detail(folds: DataFrame, tests: DataFrame, model: str = "model") -> DataFrame:
    """Mean metrics per model next to one row per test flag; ``tests`` holds a map of flags."""
    means = fold_summary(folds, [model]).select(
        model, "folds", *[F.col(f"{m}_mean") for m in ("mae", "rmse", "mape", "r2")]
    )
    flags = tests.select(model, F.explode("tests").alias("test", "passed"))
    return means.join(flags, model, "left")


def model_comparison(summary: DataFrame, model: str = "model") -> DataFrame:
    """Models that have a usable MAE, lowest first by rank."""
    valid = summary.filter(finite(F.col("mae_mean")) > 0)
    return valid.select(model, "folds", "mae_mean", "rmse_mean", "mape_mean", "r2_mean")
