"""Joins between tables of measurements, forecasts and rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wattlane.functions.time import parse_time


def merge_on_time(left: DataFrame, right: DataFrame, right_time: str = "dt_iso", left_time: str = "time") -> DataFrame:
    """Inner join on equal times; several right rows per time multiply the left row."""
    return left.join(right.withColumnRenamed(right_time, left_time), left_time, "inner")


def merge_on_utc(left: DataFrame, right: DataFrame, left_time: str = "time", right_time: str = "dt_iso") -> DataFrame:
    """Inner join of text times that may carry different offsets; both columns are kept."""
    a = left.withColumn(left_time, parse_time(F.col(left_time)))
    b = right.withColumn(right_time, parse_time(F.col(right_time)))
    return a.join(b, a[left_time] == b[right_time], "inner")


def hourly_means(df: DataFrame, ts: str, columns: Sequence[str]) -> DataFrame:
    """Mean over all rows (cities) of an hour."""
    return df.groupBy(F.date_trunc("hour", ts).alias(ts)).agg(*[F.avg(c).alias(c) for c in columns])


def enrich_hourly(left: DataFrame, right: DataFrame, ts: str, columns: Sequence[str]) -> DataFrame:
    """Left join with the hourly means, which keeps one row per hour."""
    return left.join(hourly_means(right, ts, columns), ts, "left")


def align_forecasts(
    actuals: DataFrame, forecasts: DataFrame, on: Sequence[str], actual: str = "actual",
    prediction: str = "prediction",
) -> DataFrame:
    """Pairs of actual and forecast by key, never by row order."""
    return actuals.select(*on, actual).join(forecasts.select(*on, prediction), list(on), "inner")


def side_by_side(forecasts: DataFrame, on: Sequence[str], models: Sequence[str], model: str = "model",
                 prediction: str = "prediction") -> DataFrame:
    """One column ``<model>_prediction`` per model."""
    cells = [
        F.first(F.when(F.col(model) == m, F.col(prediction)), ignorenulls=True).alias(f"{m}_prediction")
        for m in models
    ]
    return forecasts.groupBy(*on).agg(*cells)
