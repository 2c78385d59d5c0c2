"""Forecast tables: naive, demo, batch, ensemble, bands, model bookkeeping and scoring requests.

A forecast table is long: series keys, ``origin_ts``, ``ts``, ``step``, ``prediction`` and, with
several models, ``model``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattlane.operators.calendar import forecast_calendar, last_values
from wattlane.operators.params import attach, finite
from wattlane.panel import Panel


def naive(df: DataFrame, panel: Panel, target: str, horizon: int = 24) -> DataFrame:
    """Repeat each series' last value."""
    last = last_values(df, panel, target)
    return forecast_calendar(last, panel, horizon).withColumnRenamed("last_value", "prediction")


def next_step(df: DataFrame, panel: Panel, target: str) -> DataFrame:
    return naive(df, panel, target, 1)


# Fixed values of the demo forecast: ramp over a day and size of the daily wave.
DAILY_RAMP = 1000.0
DAILY_WAVE = 2000.0


def seasonal_ramp(df: DataFrame, panel: Panel, target: str, horizon: int = 24) -> DataFrame:
    """Mean of the last 24 rows, plus a linear ramp, plus a daily sine wave."""
    last = last_values(df, panel, target, tail=24)
    steps = forecast_calendar(last, panel, horizon)
    top = horizon / 24 * DAILY_RAMP
    ramp = F.lit(0.0) if horizon == 1 else (F.col("step") - 1) * F.lit(top / (horizon - 1))
    wave = DAILY_WAVE * F.sin(2 * F.pi() * F.hour(panel.ts) / 24)
    return steps.select(
        *panel.keys, "origin_ts", panel.ts, "step", (F.col("tail_mean") + ramp + wave).alias("prediction")
    )


def chunk_origins(df: DataFrame, panel: Panel, target: str, batch: int = 24) -> DataFrame:
    """Last row of every full chunk of ``batch`` rows, the one that reaches the end included."""
    chunk = F.floor(F.col(panel.pos) / F.lit(batch))
    return df.filter(F.col(panel.pos) % batch == batch - 1).select(
        *panel.keys, chunk.alias("chunk"), panel.ts, F.col(target).alias("last_value"))


def batch_naive(df: DataFrame, panel: Panel, target: str, batch: int = 24, horizon: int = 24) -> DataFrame:
    """Naive forecast after every chunk."""
    origins = chunk_origins(df, panel, target, batch)
    return forecast_calendar(origins, panel, horizon).withColumnRenamed("last_value", "prediction")


def ensemble(forecasts: DataFrame, on: Sequence[str], weights: Mapping[str, float] | None = None) -> DataFrame:
    """Weighted mean over models; weights are normalised, equal when not given."""
    if weights is None:
        weight: Column = F.lit(1.0)
    else:
        pairs = [v for m, w in weights.items() for v in (F.lit(m), F.lit(float(w)))]
        weight = F.try_element_at(F.create_map(*pairs), F.col("model"))
    known = forecasts.withColumn("_w", weight).filter(F.col("_w").isNotNull())
    return known.groupBy(*on).agg(
        (F.sum(F.col("_w") * F.col("prediction")) / F.nullif(F.sum("_w"), F.lit(0.0))).alias("prediction")
    )


# Normal quantile of the band and the share of the forecast's deviation it uses.
BAND_Z = 1.96
BAND_SHARE = 0.1


def with_band(forecasts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Band of +-1.96 times a tenth of the forecast's own deviation.

    A group is one forecast (at most 168 steps).
    """
    spread = F.stddev_pop("prediction").over(Window.partitionBy(*by)) * BAND_SHARE
    return forecasts.withColumn("_s", spread).select(
        *forecasts.columns,
        (F.col("prediction") - BAND_Z * F.col("_s")).alias("lower_bound"),
        (F.col("prediction") + BAND_Z * F.col("_s")).alias("upper_bound"),
    )


def forecast_stats(forecasts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return forecasts.groupBy(*by).agg(
        F.avg("prediction").alias("mean_prediction"),
        F.min("prediction").alias("min_prediction"),
        F.max("prediction").alias("max_prediction"),
    )


def stage_models(runs: DataFrame, model: str = "model", error: str = "mae") -> DataFrame:
    """Metadata rows of model runs with ``stage``: production for the latest version of the model
    with the lowest error, staging for the rest."""
    version = F.row_number().over(Window.partitionBy(model).orderBy("run_ts", "run_id"))
    numbered = runs.withColumn("version", version)
    score = finite(F.col(error))
    best = numbered.filter(score.isNotNull()).agg(
        F.min_by("run_id", F.struct(score, F.col(model), F.col("run_id"))).alias("_best")
    )
    return attach(numbered, best).select(
        *numbered.columns,
        F.when(F.col("run_id") == F.col("_best"), "production").otherwise("staging").alias("stage"),
    )


def score_requests(requests: DataFrame, history: DataFrame, panel: Panel, target: str, model: str = "naive") -> DataFrame:
    """Forecast for requests ``(request_id, <series keys>, hours_ahead)`` with timestamps, band and
    metadata.  Requests outside 1..168 hours are returned with an error text."""
    last = history.groupBy(*panel.keys).agg(
        F.max(panel.ts).alias("origin_ts"),
        F.max_by(target, panel.pos).alias("prediction"),
        F.count(F.lit(1)).alias("data_points_used"),
    )
    ok = F.col("hours_ahead").between(1, 168)
    matched = requests.join(last, list(panel.keys), "left").withColumn(
        "error",
        F.when(~ok, "hours_ahead must be between 1 and 168").when(F.col("origin_ts").isNull(), "unknown series"),
    )
    good = matched.filter(F.col("error").isNull()).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.col("hours_ahead")))
    )
    timed = good.withColumn(panel.ts, F.col("origin_ts") + F.make_dt_interval(hours=F.col("step")))
    banded = with_band(timed, ["request_id"]).withColumn("model_used", F.lit(model))
    rejected = matched.filter(F.col("error").isNotNull())
    return banded.unionByName(rejected, allowMissingColumns=True)
