"""Autoregressive forecasts on differenced series, for all series and folds in one plan."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from wattlane.operators import gram, metrics
from wattlane.operators.chunks import lag_of, over_chunks
from wattlane.operators.explore import ljung_box
from wattlane.operators.ordering import block_offsets
from wattlane.operators.params import attach
from wattlane.panel import Panel
from wattlane.session import materialize

# Fixed value: fewer usable rows give a fold without forecasts.
MIN_TRAIN = 50
#: Order of the autoregression whose residuals stand for the shocks of the moving-average terms.
LONG = 12


def _depth(p: int, q: int, long: int) -> int:
    """Lags of the differenced target that an order needs: its own, or those behind its oldest shock."""
    return max(p, long + q) if q else p


def _design(df: DataFrame, panel: Panel, target: str, lags: int, d: int) -> tuple[DataFrame, list[str]]:
    """Rows with the differenced target, its lags, and the last ``lags + d`` raw values as ``_state``.

    Without lags what is left is a level: the mean (d = 0), the last value (d = 1), the last slope (d = 2).
    """
    depth = lags + d
    raw = {f"_y{k}": lag_of(target, k) for k in range(1, depth + 1)}
    rows = over_chunks(df, panel, raw, lookback=depth) if raw else df
    ys = [F.col(target), *[F.col(f"_y{k}") for k in range(1, depth + 1)]]
    level = ys
    for _ in range(d):
        level = [a - b for a, b in zip(level, level[1:])]
    named = {"_z": level[0], **{f"_z{k}": level[k] for k in range(1, lags + 1)}}
    regressors = [f"_z{k}" for k in range(1, lags + 1)]
    if d == 0:
        named["_one"] = F.lit(1.0)
        regressors.append("_one")
    # Newest first: what a recursive forecast starts from after this row.
    state = F.array(*[c.cast("double") for c in ys[: max(depth, 1)]])
    return rows.withColumns(named).withColumn("_state", state), regressors


def _moments(flat, lags: int, constant: bool) -> np.ndarray:
    """Moments of (target, lag 1, ..., lag ``lags``, constant); the constant's row is 0 where there is none."""
    g = gram.unpack(flat, lags + constant)
    out = np.zeros((lags + 2, lags + 2))
    inner = slice(1, 1 + lags + constant)
    out[0, 0], out[0, inner], out[inner, 0], out[inner, inner] = g.yy, g.xy, g.xy, g.xx
    return out


def _fit(moments: np.ndarray, p: int, q: int, long: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients (p lags, q shocks, constant), the same as weights of the lags alone, and the shock's weights.

    Both least-squares stages are taken from one moment matrix: a shock is the residual of a long autoregression
    and so a fixed combination of lags, and products of combinations follow from products of lags.  Rows of
    ``shock`` and of the weights are (target, lags, constant).
    """
    size = len(moments)

    def regress(x: np.ndarray) -> np.ndarray:
        return np.linalg.lstsq(x @ moments @ x.T, x @ moments[:, 0], rcond=None)[0]

    unit = np.eye(size)
    last = unit[size - 1:]
    shock = unit[0].copy()
    rows = [unit[1:p + 1]]
    if q:
        first = np.vstack([unit[1:long + 1], last])
        shock -= regress(first) @ first
        for k in range(1, q + 1):
            moved = np.zeros(size)
            moved[k:size - 1] = shock[:size - 1 - k]
            moved[size - 1] = shock[size - 1]
            rows.append(moved[None])
    x = np.vstack([*rows, last])
    coefs = regress(x)
    return coefs, coefs @ x, shock


def _difference(values: np.ndarray, d: int) -> np.ndarray:
    for _ in range(d):
        values = values[:-1] - values[1:]
    return values


def _recursion(
    coefs: np.ndarray, shock: np.ndarray, state: np.ndarray, p: int, q: int, d: int, horizon: int
) -> list[float]:
    """Forecast ``horizon`` steps from ``state`` (newest first) and integrate ``d`` times; later shocks are 0."""
    past = _difference(state, d)
    z = list(past[:p])
    reach = len(shock) - 1
    shocks = [
        float(np.dot(shock[:len(part)], part) + shock[-1]) for part in (past[k:k + reach - q] for k in range(q))]
    ends = [float(_difference(state[: i + 1], i)[0]) for i in range(d)]
    out = []
    for _ in range(horizon):
        step = coefs[p + q] + float(np.dot(coefs[:p], z)) + float(np.dot(coefs[p:p + q], shocks))
        z, shocks = [step, *z][:p], [0.0, *shocks][:q]
        for i in reversed(range(d)):
            ends[i] += step
            step = ends[i]
        out.append(step)
    return out


def _forecaster(lags: int, p: int, d: int, horizon: int, q: int = 0, long: int = LONG, least: int = 0):
    """Forecasts from sums and state; NULLs where either is missing or fewer than ``least`` rows were summed."""

    @F.pandas_udf("array<double>")
    def run(sums: pd.Series, state: pd.Series) -> pd.Series:
        def one(flat, last) -> list[float | None]:
            if flat is None or last is None or any(v is None or v != v for v in last) or flat[0] < least:
                return [None] * horizon
            coefs, _, shock = _fit(_moments(flat, lags, d == 0), p, q, long)
            return _recursion(coefs, shock, np.asarray(last, dtype=float), p, q, d, horizon)

        return pd.Series([one(f, s) for f, s in zip(sums, state)])

    return run


def forecast(
    df: DataFrame, panel: Panel, target: str, p: int = 1, d: int = 1, horizon: int = 24, q: int = 0, long: int = LONG
) -> DataFrame:
    """Fit on each whole series and forecast ``horizon`` hours after its end.

    ``q`` moving-average terms are fitted in two least-squares stages: an autoregression of order ``long`` gives
    the shocks, whose lags are regressors of the second stage.  Both use the rows that have all lags.  A series
    too short or with a gap at its end has rows with NULL forecasts.
    """
    lags = _depth(p, q, long)
    rows, regressors = _design(df, panel, target, lags, d)
    fitted = gram.sums(rows, panel.keys, "_z", regressors)
    last = rows.groupBy(*panel.keys).agg(
        F.max(panel.ts).alias("origin_ts"), F.max_by("_state", panel.pos).alias("_state")
    )
    run = _forecaster(lags, p, d, horizon, q, long)
    joined = attach(last, fitted, panel.keys).withColumn("_f", run("_gram", "_state"))
    return joined.select(
        *panel.keys, "origin_ts", F.posexplode("_f").alias("_i", "prediction")
    ).select(
        *panel.keys,
        "origin_ts",
        (F.col("origin_ts") + F.make_dt_interval(hours=F.col("_i") + 1)).alias(panel.ts),
        (F.col("_i") + 1).alias("step"),
        "prediction",
    )


def walk_forward(
    df: DataFrame, panel: Panel, target: str, p: int = 1, d: int = 1, window: int = 720, horizon: int = 24,
    q: int = 0, long: int = LONG,
) -> DataFrame:
    """Forecasts of every expanding fold, next to the actual values.

    Training sums are taken once per block of rows between two fold starts and accumulated, so k
    folds cost one pass instead of k; shocks of moving-average terms follow from the same sums, so each
    fold has its own without another pass.  A fold with fewer than ``MIN_TRAIN`` usable training rows (or
    ``window``, if that is less) keeps its rows with NULL forecasts.
    """
    lags = _depth(p, q, long)
    rows, regressors = _design(df, panel, target, lags, d)
    keys = list(panel.keys)
    pos = F.col(panel.pos)
    # Fold k trains on blocks 0..k: block 0 ends where fold 0 starts.
    block = F.greatest(F.lit(0), F.floor((pos - window) / F.lit(horizon)) + 1).alias("fold")
    blocks = gram.sums(rows.select("*", block), [*keys, "fold"], "_z", regressors)
    size = 2 + len(regressors) + len(regressors) * (len(regressors) + 1) // 2
    entries = [f"_g{i}" for i in range(size)]
    # One row per fold and series, read three times below.
    wide = materialize(
        blocks.select(*keys, "fold", *[F.get("_gram", F.lit(i)).alias(g) for i, g in enumerate(entries)]), "sums"
    )
    earlier = block_offsets(wide, keys, "fold", entries).withColumnsRenamed({g: f"{g}_before" for g in entries})
    folded = wide.join(earlier, [*keys, "fold"]).select(
        *keys, "fold", F.array(*[F.col(g) + F.col(f"{g}_before") for g in entries]).alias("_gram")
    )
    at_end = (pos >= window - 1) & ((pos - window + 1) % horizon == 0)
    origins = rows.filter(at_end).select(
        *keys, ((pos - window + 1) / horizon).cast("long").alias("fold"), "_state"
    )
    run = _forecaster(lags, p, d, horizon, q, long, max(min(MIN_TRAIN, window) - d - lags, 1))
    predicted = (
        origins.join(folded, [*keys, "fold"], "left")
        .select(*keys, "fold", F.posexplode(run("_gram", "_state")).alias("_i", "prediction"))
        .select(
            *keys, "fold", (F.col("fold") * horizon + window + F.col("_i")).alias(panel.pos), "prediction"
        )
    )
    # A fold exists if its last test row does.
    ends = df.groupBy(*keys).agg(F.max(panel.pos).alias("_last"))
    actual = df.select(*keys, panel.ts, panel.pos, F.col(target).alias("actual"))
    inside = F.col("fold") * horizon + window + horizon - 1 <= F.col("_last")
    return attach(actual.join(predicted, [*keys, panel.pos]), ends, keys).filter(inside).drop("_last")


def tune(
    df: DataFrame, panel: Panel, target: str, ps: Sequence[int] = (1, 2, 3), ds: Sequence[int] = (0, 1),
    holdout: int = 24, qs: Sequence[int] = (0,), long: int = LONG,
) -> DataFrame:
    """MAE on each series' last ``holdout`` rows for every order.

    One set of cross products per degree of differencing serves every (p, q), so the scans do not grow with the
    grid, and all orders of a degree are fitted on the same rows.  Every series has a row for every order, with
    a NULL error where it is too short.
    """
    ends = df.groupBy(*panel.keys).agg(F.max(panel.pos).alias("_last"))
    marked = attach(df, ends, panel.keys)
    train = marked.filter(F.col(panel.pos) <= F.col("_last") - holdout).drop("_last")
    test = marked.filter(F.col(panel.pos) > F.col("_last") - holdout).select(
        *panel.keys, (F.col(panel.pos) - F.col("_last") + holdout).alias("step"), F.col(target).alias("actual")
    )
    actuals = test.groupBy(*panel.keys).agg(
        F.map_from_entries(F.collect_list(F.struct("step", "actual"))).alias("_actual"))
    orders = [(p, q) for p in ps for q in qs]
    lags = max(_depth(p, q, long) for p, q in orders)
    tried = None
    for d in ds:
        rows, regressors = _design(train, panel, target, lags, d)
        fitted = gram.sums(rows, panel.keys, "_z", regressors)
        last = rows.groupBy(*panel.keys).agg(F.max_by("_state", panel.pos).alias("_state"))
        runs = F.array(*[
            F.struct(F.lit(p).alias("p"), F.lit(q).alias("q"), F.lit(i).alias("_i")) for i, (p, q) in enumerate(orders)])
        made = attach(attach(ends, last, panel.keys), fitted, panel.keys).withColumn(
            "_f", _grid_forecaster(lags, d, holdout, orders, long)("_gram", "_state"))
        one = attach(made, actuals, panel.keys).select(
            *panel.keys, "_actual", "_f", F.lit(d).alias("d"), F.inline(runs)
        ).select(*panel.keys, "p", "d", "q", "_actual", F.get("_f", "_i").alias("_f"))
        tried = one if tried is None else tried.unionByName(one)
    error = F.transform("_f", lambda v, i: F.abs(F.try_element_at("_actual", (i + 1).cast("long")) - v))
    known = F.filter(error, lambda v: v.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda acc, v: acc + v)
    return tried.select(*panel.keys, "p", "d", "q", (total / F.nullif(F.size(known), F.lit(0))).alias("mae"))


def _grid_forecaster(lags: int, d: int, horizon: int, orders: Sequence[tuple[int, int]], long: int):
    """An array of forecasts per order, from one moment matrix."""

    @F.pandas_udf("array<array<double>>")
    def run(sums: pd.Series, state: pd.Series) -> pd.Series:
        def all_orders(flat, last) -> list[list[float | None]]:
            if flat is None or last is None or any(v is None or v != v for v in last):
                return [[None] * horizon] * len(orders)
            moments, start = _moments(flat, lags, d == 0), np.asarray(last, dtype=float)
            out = []
            for p, q in orders:
                coefs, _, shock = _fit(moments, p, q, long)
                out.append(_recursion(coefs, shock, start, p, q, d, horizon))
            return out

        return pd.Series([all_orders(f, s) for f, s in zip(sums, state)])

    return run


def validate(
    df: DataFrame, panel: Panel, target: str, p: int = 1, d: int = 1, holdout: int = 24, q: int = 0, long: int = LONG
) -> DataFrame:
    """In-sample and out-of-sample metrics of one order, and a white-noise test of its residuals."""
    ends = df.groupBy(*panel.keys).agg(F.max(panel.pos).alias("_last"))
    marked = attach(df, ends, panel.keys)
    train = marked.filter(F.col(panel.pos) <= F.col("_last") - holdout).drop("_last")
    lags = _depth(p, q, long)
    rows, regressors = _design(train, panel, target, lags, d)
    width = len(regressors)

    @F.pandas_udf("array<double>")
    def coefficients(sums: pd.Series) -> pd.Series:
        # Shocks are combinations of lags, so one step ahead is one too; without a constant its weight falls away.
        return sums.map(lambda flat: [float(v) for v in _fit(_moments(flat, lags, d == 0), p, q, long)[1][1:width + 1]])

    fitted = gram.sums(rows, panel.keys, "_z", regressors).withColumn("_b", coefficients("_gram")).drop("_gram")
    step = F.aggregate(
        F.zip_with(F.array(*regressors), F.col("_b"), lambda x, b: x * b), F.lit(0.0), lambda a, x: a + x
    )
    # One step ahead, the forecast error is the same before and after differencing.
    inside = (
        attach(rows, fitted, panel.keys)
        .filter(F.forall(F.array("_z", *regressors), lambda v: v.isNotNull()))
        .select(*panel.keys, panel.pos, F.col(target).alias("actual"), (F.col("_z") - step).alias("resid"))
        .withColumn("prediction", F.col("actual") - F.col("resid"))
    )
    test = marked.filter(F.col(panel.pos) > F.col("_last") - holdout).select(
        *panel.keys, (F.col(panel.pos) - F.col("_last") + holdout).alias("step"), F.col(target).alias("actual")
    )
    outside = forecast(train, panel, target, p, d, holdout, q, long).join(test, [*panel.keys, "step"])
    noise = ljung_box(inside, panel, "resid", 10).select(*panel.keys, "q_stat", "p_value", "white_noise")
    in_m = metrics.regression_metrics(inside, panel.keys).select(*panel.keys, F.struct(*metrics.METRICS).alias("_in"))
    out_m = metrics.regression_metrics(outside, panel.keys).select(*panel.keys, F.struct(*metrics.METRICS).alias("_out"))
    joined = attach(attach(in_m, out_m, panel.keys), noise, panel.keys)
    return joined.select(
        *panel.keys,
        *[F.col(f"_in.{m}").alias(f"in_{m}") for m in metrics.METRICS],
        *[F.col(f"_out.{m}").alias(f"out_{m}") for m in metrics.METRICS],
        "q_stat", "p_value", "white_noise",
    )
