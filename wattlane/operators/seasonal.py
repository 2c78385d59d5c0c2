"""Additive trend and seasonality regression."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from wattlane.operators import cleaning, gram
from wattlane.operators.calendar import forecast_calendar
from wattlane.operators.params import attach
from wattlane.panel import Panel

# Period in hours and number of Fourier pairs of each seasonality.
SEASONS = {"daily": (24.0, 4), "weekly": (168.0, 3), "yearly": (8766.0, 10)}


def _terms(hours: Column, seasons: Sequence[str], span: float) -> list[Column]:
    """Constant, trend and Fourier pairs; the trend is kept near 1 for a well-scaled solve."""
    out = [F.lit(1.0), hours / F.lit(span)]
    for name in seasons:
        period, order = SEASONS[name]
        for k in range(1, order + 1):
            angle = hours * F.lit(2.0 * k / period) * F.pi()
            out += [F.sin(angle), F.cos(angle)]
    return out


def _hours(ts: str, origin: str = "_origin") -> Column:
    return (F.unix_micros(ts) - F.unix_micros(origin)) / F.lit(3.6e9)


def fit(
    df: DataFrame, panel: Panel, target: str, seasons: Sequence[str] = ("daily", "weekly"),
    ridge: float = 1e-6, span: float = 1000.0,
) -> DataFrame:
    """Coefficients ``_b`` and time origin per series."""
    origins = df.groupBy(*panel.keys).agg(F.min(panel.ts).alias("_origin"))
    terms = _terms(_hours(panel.ts), seasons, span)
    names = [f"_x{i}" for i in range(len(terms))]
    rows = attach(df.select(*panel.keys, panel.ts, target), origins, panel.keys).select(
        *panel.keys, "_origin", target, *[t.alias(n) for t, n in zip(terms, names)]
    )
    width = len(names)

    @F.pandas_udf("array<double>")
    def coefficients(sums: pd.Series) -> pd.Series:
        return sums.map(lambda flat: [float(v) for v in gram.solve(flat, width, ridge)])

    return gram.sums(rows, [*panel.keys, "_origin"], target, names).select(
        *panel.keys, "_origin", coefficients("_gram").alias("_b")
    )


def predict(
    rows: DataFrame, panel: Panel, model: DataFrame, seasons: Sequence[str] = ("daily", "weekly"),
    span: float = 1000.0,
) -> DataFrame:
    """Add ``prediction`` to rows with series keys and a time."""
    joined = attach(rows, model, panel.keys)
    terms = F.array(*_terms(_hours(panel.ts), seasons, span))
    dot = F.aggregate(F.zip_with(terms, F.col("_b"), lambda x, b: x * b), F.lit(0.0), lambda a, x: a + x)
    return joined.withColumn("prediction", dot).select(*rows.columns, "prediction")


def forecast(
    df: DataFrame, panel: Panel, target: str, horizon: int = 24, seasons: Sequence[str] = ("daily", "weekly"),
    standardize: bool = False,
) -> DataFrame:
    """Fit on each whole series and forecast; ``standardize`` fits on z-scores and scales back."""
    params = None
    source = df
    if standardize:
        params = cleaning.fit_scaler(df, [target], by=panel.keys)
        source = cleaning.scale(df, params, [target], by=panel.keys)
    model = fit(source, panel, target, seasons)
    last = df.groupBy(*panel.keys).agg(F.max(panel.ts).alias(panel.ts))
    out = predict(forecast_calendar(last, panel, horizon), panel, model, seasons)
    if params is None:
        return out
    back = out.withColumnRenamed("prediction", target)
    return cleaning.unscale(back, params, [target], by=panel.keys).withColumnRenamed(target, "prediction")
