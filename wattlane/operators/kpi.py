"""Business figures of a forecast and the long table they are kept in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattlane.functions.energy import row_sum, safe_ratio
from wattlane.panel import Panel

# Peak hours and prices of the business figures.
PEAK_HOURS = (17, 18, 19, 20)
PRICE = 0.12
UNDER_PENALTY = 1.5
OVER_PENALTY = 0.3
# Weights of bias, consistency and coverage in the reliability score, nominal coverage.
BIAS_WEIGHT, CONSISTENCY_WEIGHT, COVERAGE_WEIGHT = 0.4, 0.4, 0.2
NOMINAL_COVERAGE = 95
TRACKED_RENEWABLES = ("generation_solar", "generation_wind_onshore", "generation_hydro_water_reservoir")


def peak_demand(
    df: DataFrame, panel: Panel, by: Sequence[str] = (), actual: str = "actual",
    predicted: str = "prediction", hours: Sequence[int] = PEAK_HOURS, clock: bool = True,
) -> DataFrame:
    """Errors in the peak hours; without a clock, rows 3-5 of every six count as peak."""
    y, p = F.col(actual), F.col(predicted)
    peak = F.hour(panel.ts).isin(*hours) if clock else F.col(panel.pos) % 6 >= 3
    ratio = F.abs((y - p) / F.nullif(y, F.lit(0.0)))
    rows = F.count_if(peak)
    undefined = F.count_if(peak & (y == 0)) > 0
    share = F.when(rows == 0, 0.0).when(~undefined, F.avg(F.when(peak, ratio)) * 100)
    return df.groupBy(*by).agg(
        F.coalesce(F.avg(F.when(peak, F.abs(y - p))), F.lit(0.0)).alias("peak_mae"),
        share.alias("peak_mape"),
        F.when(rows == 0, 0.0).otherwise(100 - share).alias("peak_accuracy"),
        rows.alias("peak_hours_count"),
    )


def renewable_contribution(
    df: DataFrame, target: str, by: Sequence[str] = (), columns: Sequence[str] = TRACKED_RENEWABLES
) -> DataFrame:
    """Renewable output and its share of demand; forecast errors if ``<c>_forecast`` columns exist."""
    present = [c for c in columns if c in df.columns]
    if not present:
        zeros = [
            F.lit(0.0).alias(n)
            for n in ("avg_renewable_generation", "max_renewable_generation", "renewable_penetration",
                      "renewable_forecast_mae", "renewable_forecast_mape")
        ]
        return df.groupBy(*by).agg(*zeros) if by else df.agg(F.count(F.lit(1))).select(*zeros)
    total = row_sum(present)
    exprs = [
        F.avg(total).alias("avg_renewable_generation"),
        F.max(total).alias("max_renewable_generation"),
        (safe_ratio(F.sum(total), F.sum(target)) * 100).alias("renewable_penetration"),
    ]
    planned = [f"{c}_forecast" for c in present if f"{c}_forecast" in df.columns]
    if planned:
        gap = F.abs(total - row_sum(planned))
        defined = F.count_if(total == 0) == 0
        exprs += [
            F.avg(gap).alias("renewable_forecast_mae"),
            F.when(defined, F.avg(gap / F.nullif(total, F.lit(0.0))) * 100).alias("renewable_forecast_mape"),
        ]
    return df.groupBy(*by).agg(*exprs)


def reliability(
    df: DataFrame, by: Sequence[str] = (), actual: str = "actual", predicted: str = "prediction",
    lower: str | None = None, upper: str | None = None,
) -> DataFrame:
    """Bias, variance, consistency, interval coverage and a 0-100 score.

    ``pred_coverage`` (share of *forecasts* inside the interval) enters the score;
    ``actual_coverage`` is reported next to it.
    """
    y, p = F.col(actual), F.col(predicted)
    error = y - p
    bias, spread = F.avg(error), F.stddev_samp(error)
    consistency = 1 / (1 + spread)
    if lower and upper:
        low, high = F.col(lower), F.col(upper)
        pred_cov = F.avg(p.between(low, high).cast("double")) * 100
        actual_cov = F.avg(y.between(low, high).cast("double")) * 100
    else:
        pred_cov = actual_cov = F.lit(0.0)
    score = (
        (1 - F.abs(bias) / F.nullif(F.avg(y), F.lit(0.0))) * BIAS_WEIGHT
        + consistency * CONSISTENCY_WEIGHT
        + F.least(pred_cov / NOMINAL_COVERAGE, F.lit(1.0)) * COVERAGE_WEIGHT
    ) * 100
    return df.groupBy(*by).agg(
        bias.alias("forecast_bias"),
        F.var_samp(error).alias("forecast_variance"),
        consistency.alias("forecast_consistency"),
        pred_cov.alias("pred_coverage"),
        actual_cov.alias("actual_coverage"),
        F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)).alias("reliability_score"),
    )


def business_impact(
    df: DataFrame, by: Sequence[str] = (), actual: str = "actual", predicted: str = "prediction",
    price: float = PRICE,
) -> DataFrame:
    """Cost of forecast errors; under-forecasts weigh more than over-forecasts."""
    y, p = F.col(actual), F.col(predicted)
    error = y - p
    cost = F.sum(F.abs(error)) * price
    under = F.coalesce(F.sum(F.when(error > 0, error)), F.lit(0.0)) * price * UNDER_PENALTY
    over = F.coalesce(F.sum(F.when(error < 0, -error)), F.lit(0.0)) * price * OVER_PENALTY
    score = (1 - cost / F.nullif(F.sum(y) * price, F.lit(0.0))) * 100
    per_unit = F.when(F.sum(y) > 0, cost / F.nullif(F.sum(y), F.lit(0.0))).otherwise(F.lit(0.0))
    return df.groupBy(*by).agg(
        cost.alias("total_error_cost"),
        under.alias("under_forecast_cost"),
        over.alias("over_forecast_cost"),
        F.greatest(F.lit(0.0), score).alias("business_impact_score"),
        per_unit.alias("error_cost_per_mwh"),
    )


def long_metrics(wide: DataFrame, group: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per figure, named ``<group>.<figure>`` (or the bare figure for no group)."""
    names = [c for c in wide.columns if c not in by]
    prefix = f"{group}." if group else ""
    pairs = [
        F.struct(F.lit(f"{prefix}{c}").alias("metric"), F.col(c).cast("double").alias("value")) for c in names
    ]
    return wide.select(*by, F.inline(F.array(*pairs)))


def all_metrics(
    df: DataFrame, panel: Panel, by: Sequence[str] = (), actual: str = "actual",
    predicted: str = "prediction", price: float = PRICE, hours: Sequence[int] = PEAK_HOURS,
    lower: str | None = None, upper: str | None = None,
) -> DataFrame:
    """Every business figure of each run in ``by``, as one long table."""
    parts = [
        long_metrics(peak_demand(df, panel, by, actual, predicted, hours), "peak_demand", by),
        long_metrics(reliability(df, by, actual, predicted, lower, upper), "forecast_reliability", by),
        long_metrics(business_impact(df, by, actual, predicted, price), "business_impact", by),
    ]
    if any(c in df.columns for c in TRACKED_RENEWABLES):
        parts.append(long_metrics(renewable_contribution(df, actual, by), "renewable_contribution", by))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# Figures of the short summary.
SUMMARY = (
    "peak_demand.peak_accuracy",
    "forecast_reliability.reliability_score",
    "business_impact.business_impact_score",
    "business_impact.total_error_cost",
    "renewable_contribution.renewable_penetration",
)


def latest_summary(history: DataFrame, run: str = "run_ts", by: Sequence[str] = ()) -> DataFrame:
    """Summary figures of the latest run (of each group in ``by``)."""
    return history.filter(F.col("metric").isin(*SUMMARY)).groupBy(*by, "metric").agg(
        F.max_by("value", run).alias("value"), F.max(run).alias(run)
    )


def recent_runs(history: DataFrame, runs: int = 24, run: str = "run_ts", by: Sequence[str] = ()) -> DataFrame:
    """Figures of the last ``runs`` runs; the rank limit is applied before the shuffle as well."""
    newest = Window.partitionBy(*by, "metric").orderBy(F.col(run).desc())
    return history.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= runs).drop("_r")
