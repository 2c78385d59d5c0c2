"""Preparation, training, evaluation and monitoring flows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wattlane.functions.time import parse_time
from wattlane.operators import (
    alerts, autoregression, boosted, cleaning, drift, features, folds, joins, kpi, metrics, ordering, supervised,
)
from wattlane.panel import Panel
from wattlane.session import materialize

TARGET = "total_load_actual"
ONE_SERIES = Panel(keys=())


def _values(df: DataFrame, panel: Panel) -> list[str]:
    return [c for c in cleaning.column_roles(df).numeric if c not in (panel.pos, *panel.keys)]


def prepare_energy(
    raw: DataFrame, panel: Panel = ONE_SERIES, target: str = TARGET, lags: Sequence[int] = (1, 24, 168),
    time_column: str | None = None,
) -> DataFrame:
    """Parse time, fill with means, drop target outliers, add lags over the surviving rows."""
    parsed = _parsed(raw, panel, time_column)
    filled = cleaning.impute(parsed, _values(parsed, panel))
    kept = cleaning.drop_outliers(filled, [target])
    if panel.pos in kept.columns:
        numbered = ordering.reposition(kept, panel)
    else:
        numbered = ordering.with_positions(kept, panel)
    return features.add_lags(numbered, panel, [target], lags)


def prepare_weather(raw: DataFrame, panel: Panel = ONE_SERIES, time_column: str | None = None) -> DataFrame:
    parsed = _parsed(raw, panel, time_column)
    return cleaning.impute(parsed, _values(parsed, panel))


def _parsed(raw: DataFrame, panel: Panel, time_column: str | None) -> DataFrame:
    if time_column is None:
        return raw
    return raw.withColumn(time_column, parse_time(F.col(time_column), strict=True)).withColumnRenamed(
        time_column, panel.ts
    )


def prepare(
    merged: DataFrame, panel: Panel, outlier_columns: Sequence[str] = (TARGET, "price_actual"),
    normalize: bool = False, normalize_columns: Sequence[str] = (TARGET,), method: str = "standard",
) -> DataFrame:
    """Fill, drop outliers of several columns in turn, optionally scale."""
    filled = cleaning.impute(merged, _values(merged, panel))
    kept = cleaning.drop_outliers(filled, outlier_columns)
    return cleaning.normalize(kept, normalize_columns, method)[0] if normalize else kept


def prepare_both(
    energy: DataFrame, weather: DataFrame, panel: Panel = ONE_SERIES, fanout: bool = False,
    weather_columns: Sequence[str] = ("temp", "humidity", "wind_speed"),
) -> DataFrame:
    """Prepared energy with prepared weather.

    The default grain is one row per hour: weather is averaged over cities first.  ``fanout`` joins
    every city's row instead.
    """
    left = prepare_energy(energy, panel)
    right = prepare_weather(weather, panel)
    if fanout:
        return left.join(right, panel.ts, "inner")
    return left.join(joins.hourly_means(right, panel.ts, weather_columns), panel.ts, "inner")


def evaluate_models(
    df: DataFrame, panel: Panel, target: str, window: int, horizon: int, orders: Mapping[str, tuple[int, int]]
) -> DataFrame:
    """Fold metrics of the naive forecast and of autoregressions, one row per model, series and fold."""
    base = folds.walk_forward(df, panel, target, window, horizon)
    scored = metrics.fold_metrics(base, panel.keys).withColumn("model", F.lit("naive"))
    for name, (p, d) in orders.items():
        ahead = autoregression.walk_forward(df, panel, target, p, d, window, horizon)
        one = metrics.fold_metrics(ahead, panel.keys, "prediction").withColumn("model", F.lit(name))
        scored = scored.unionByName(one)
    return scored


def validate_models(
    df: DataFrame, panel: Panel, target: str, window: int = 168, horizon: int = 24,
    orders: Mapping[str, tuple[int, int]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(fold metrics, composite scores with the winner)."""
    scored = evaluate_models(df, panel, target, window, horizon, orders or {})
    return scored, metrics.best_by_composite(metrics.fold_summary(scored))


def monitoring_metrics(
    reference: DataFrame, current: DataFrame, pairs: DataFrame, columns: Sequence[str],
    actual: str = "actual", predicted: str = "prediction",
) -> DataFrame:
    """Quality, drift and performance of a batch as a long metric table."""
    quality = drift.quality_score(drift.missing_shares(current))
    shift = drift.drift_score(drift.mean_shift(reference, current, columns)).select(
        F.col("drift_detected").cast("double").alias("drift_detected"), "drift_score"
    )
    perf = metrics.performance(pairs, (), actual, predicted)
    return (
        kpi.long_metrics(quality, "data_quality")
        .unionByName(kpi.long_metrics(shift, "data_drift"))
        .unionByName(kpi.long_metrics(perf, ""))
    )


def monitoring_cycle(
    reference: DataFrame, current: DataFrame, pairs: DataFrame, columns: Sequence[str], rules: DataFrame,
    run_ts: Column, actual: str = "actual", predicted: str = "prediction",
) -> DataFrame:
    """Alerts of one monitoring run."""
    table = monitoring_metrics(reference, current, pairs, columns, actual, predicted)
    return alerts.evaluate(table.withColumn("run_ts", run_ts), rules)


def train_and_compare(
    df: DataFrame, panel: Panel, target: str, models: Mapping[str, object], fraction: float = 0.8,
    lags: Sequence[int] = features.BOOSTED_LAGS, windows: Sequence[int] = features.BOOSTED_WINDOWS,
) -> DataFrame:
    """Make features, fit every estimator on the training rows, score on the test rows, flag the best.

    The feature table is written once: learners pass over it many times.
    """
    rows, names, _ = supervised.supervised_split(df, panel, target, fraction, lags, windows)
    saved = materialize(rows, "features")
    scored = boosted.compare(
        saved.filter("split = 'train'"), saved.filter("split = 'test'"), names, target, models
    )
    best = metrics.best_by_error(scored, error="mae").select("best_model").scalar()
    return scored.withColumn("is_best", F.col("model") == best)
