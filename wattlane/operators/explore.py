"""Exploratory statistics of tables and series."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wattlane.operators import gram
from wattlane.operators.chunks import lag_of, over_chunks
from wattlane.operators.params import attach, finite
from wattlane.operators.quantiles import quantile_name, quantiles
from wattlane.panel import Panel

QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, std, min, quartiles, max."""
    q = quantiles(df, columns, QUARTILES)
    plain = df.agg(
        *[
            e
            for c in columns
            for e in (
                F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"),
                F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"),
            )
        ]
    )
    cells = [
        F.struct(
            F.lit(c).alias("field"),
            F.col(f"{c}__n").alias("count"),
            F.col(f"{c}__mean").alias("mean"),
            F.col(f"{c}__std").alias("std"),
            F.col(f"{c}__min").cast("double").alias("min"),
            *[F.col(quantile_name(c, p)).alias(n) for p, n in zip(QUARTILES, ("q25", "q50", "q75"))],
            F.col(f"{c}__max").cast("double").alias("max"),
        )
        for c in columns
    ]
    return attach(plain, q).select(F.inline(F.array(*cells)))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    cells = [
        F.struct(F.lit(c).alias("field"), F.count_if(F.col(c).isNull()).alias("nulls"))
        for c in (columns or df.columns)
    ]
    return df.agg(F.array(*cells).alias("_c")).select(F.inline("_c"))


def overview(df: DataFrame, ts: str, target: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.avg(target).alias("avg_load"),
        F.max(target).alias("peak_load"),
        F.count_if(F.col(target).isNull()).alias("missing"),
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every pair of columns, each over the rows where both are known; one pass."""
    cells = [
        F.struct(
            F.lit(a).alias("a"), F.lit(b).alias("b"),
            F.corr(F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))).alias("corr"),
        )
        for a in columns
        for b in columns
    ]
    return df.agg(F.array(*cells).alias("_c")).select(F.inline("_c"))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between minimum and maximum; the maximum falls in the last bin."""
    ends = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    cell = F.least(
        F.lit(bins - 1), F.coalesce(F.floor((F.col(column) - F.col("_lo")) / F.nullif(width, F.lit(0.0))), F.lit(0))
    ).cast("long")
    return (
        attach(df.filter(F.col(column).isNotNull()), ends)
        .withColumn("bin", cell)
        .groupBy("bin")
        .agg(
            F.count(F.lit(1)).alias("count"),
            (F.first("_lo") + F.col("bin") * F.first(width)).alias("left_edge"),
        )
    )


def melt(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    return df.unpivot(list(ids), list(columns), "variable", "value")


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 interquartile ranges) and outliers per column."""
    long = melt(df, columns).filter(F.col("value").isNotNull())
    q = quantiles(long, ["value"], QUARTILES, by=["variable"]).select(
        "variable", *[F.col(quantile_name("value", p)).alias(n) for p, n in zip(QUARTILES, ("q25", "q50", "q75"))]
    )
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    inside = F.col("value").between(F.col("q25") - reach, F.col("q75") + reach)
    return (
        attach(long, q, ["variable"])
        .groupBy("variable", "q25", "q50", "q75")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def autocorrelation(df: DataFrame, panel: Panel, column: str, lags: int = 50) -> DataFrame:
    """One row per series: ``n`` and ``acf``, an array for lags 0..``lags``.

    All lags come from one window and one aggregate.
    """
    known = df.filter(F.col(column).isNotNull())
    means = known.groupBy(*panel.keys).agg(F.avg(column).alias("_m"))
    centred = attach(known, means, panel.keys).select(
        *panel.keys, panel.pos, (F.col(column) - F.col("_m")).alias("_z")
    )
    new = {f"_z{k}": lag_of("_z", k) for k in range(1, lags + 1)}
    lagged = over_chunks(centred, panel, new, lookback=lags)
    total = F.sum(F.col("_z") * F.col("_z"))
    shares = [
        F.coalesce(F.sum(F.col("_z") * F.col(f"_z{k}")), F.lit(0.0)) / F.nullif(total, F.lit(0.0))
        for k in range(1, lags + 1)
    ]
    return lagged.groupBy(*panel.keys).agg(
        F.count("_z").alias("n"), F.array(total / F.nullif(total, F.lit(0.0)), *shares).alias("acf")
    )


def autocorrelation_table(df: DataFrame, panel: Panel, column: str, lags: int = 50) -> DataFrame:
    wide = autocorrelation(df, panel, column, lags)
    return wide.select(*panel.keys, F.posexplode("acf").alias("lag", "acf"))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _levinson_durbin(acf: pd.Series) -> pd.Series:
    """Partial autocorrelations from one short array of autocorrelations per row."""

    def one(r: np.ndarray) -> list[float]:
        out, phi, error = [1.0], np.zeros(0), 1.0
        for k in range(1, len(r)):
            reflection = (r[k] - phi @ r[k - 1 : 0 : -1]) / error if k > 1 else r[1]
            phi = np.append(phi - reflection * phi[::-1], reflection)
            error *= 1.0 - reflection**2
            out.append(float(reflection))
        return out

    return acf.map(lambda a: one(np.asarray(a, dtype=float)))


def partial_autocorrelation(df: DataFrame, panel: Panel, column: str, lags: int = 50, adjusted: bool = True) -> DataFrame:
    """Partial autocorrelations (Yule-Walker); ``adjusted`` divides lag k by n - k instead of n."""
    wide = autocorrelation(df, panel, column, lags)
    acf = F.transform("acf", lambda r, k: r * F.col("n") / (F.col("n") - k)) if adjusted else F.col("acf")
    return wide.select(*panel.keys, F.posexplode(_levinson_durbin(acf)).alias("lag", "pacf"))


def lag_correlations(df: DataFrame, panel: Panel, target: str, column: str, max_lag: int = 24) -> DataFrame:
    """Correlation of ``target`` with ``column`` 0..``max_lag`` rows earlier, one row per lag."""
    new = {f"_x{k}": lag_of(column, k) for k in range(1, max_lag + 1)}
    lagged = over_chunks(df.select(*panel.keys, panel.pos, target, column), panel, new, lookback=max_lag)
    cells = []
    for k in range(max_lag + 1):
        x = F.col(column if k == 0 else f"_x{k}")
        both = x.isNotNull() & F.col(target).isNotNull()
        cells.append(F.corr(F.when(both, F.col(target)), F.when(both, x)))
    return lagged.groupBy(*panel.keys).agg(F.array(*cells).alias("_r")).select(
        *panel.keys, F.posexplode("_r").alias("lag", "corr")
    )


def best_lag(correlations: DataFrame, keys: Sequence[str] = (), decimals: int | None = None) -> DataFrame:
    """Lag with the largest absolute correlation, the first on ties."""
    r = F.col("corr") if decimals is None else F.round("corr", decimals)
    rank = F.struct(-F.abs(r), F.col("lag"))
    known = correlations.filter(F.col("corr").isNotNull())
    return known.groupBy(*keys).agg(F.min_by("lag", rank).alias("best_lag"), F.min_by("corr", rank).alias("corr"))


def decompose(df: DataFrame, panel: Panel, column: str, period: int = 24) -> DataFrame:
    """Additive decomposition: centred moving-average trend, seasonal means, residual.

    The moving average of an even period spans ``period + 1`` rows with half weight at both ends.
    """
    half = period // 2

    def trend(w):
        value = F.col(column)
        if period % 2:
            frame = w.rowsBetween(-half, half)
            return F.when(F.count(column).over(frame) == period, F.avg(column).over(frame))
        wide, inner = w.rowsBetween(-half, half), w.rowsBetween(-half + 1, half - 1)
        ends = F.lag(column, half).over(w) + F.lead(column, half).over(w)
        total = F.sum(column).over(inner) + ends / 2
        return F.when(F.count(value).over(wide) == period + 1, total / period)

    phase = (F.col(panel.pos) % period).alias("_phase")
    out = over_chunks(
        df.select(*panel.keys, panel.ts, panel.pos, column), panel, {"trend": trend}, half, half
    ).select("*", phase)
    group = [*panel.keys, "_phase"]
    per_phase = out.groupBy(*group).agg(F.avg(F.col(column) - F.col("trend")).alias("_raw"))
    level = per_phase.groupBy(*panel.keys).agg(F.avg("_raw").alias("_level"))
    seasonal = attach(per_phase, level, panel.keys).select(*group, (F.col("_raw") - F.col("_level")).alias("seasonal"))
    return out.join(seasonal, group, "left").select(
        *panel.keys, panel.ts, panel.pos, column, "trend", "seasonal",
        (F.col(column) - F.col("trend") - F.col("seasonal")).alias("resid"),
    )


def chi_square_tail_even(q: Column, df: int) -> Column:
    """Upper tail of the chi-square distribution with an even number of degrees of freedom."""
    if df % 2:
        raise ValueError("closed form needs an even number of degrees of freedom")
    terms = [F.pow(q / 2, F.lit(i)) / math.factorial(i) for i in range(df // 2)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.exp(-q / 2) * total


def ljung_box(df: DataFrame, panel: Panel, column: str, lags: int = 10, alpha: float = 0.05) -> DataFrame:
    """White-noise test: Q statistic, p-value and whether the residuals pass."""
    wide = autocorrelation(df, panel, column, lags)
    n = F.col("n")
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(lags)),
        F.lit(0.0),
        lambda acc, k: acc + F.pow(F.get("acf", k), 2) / (n - k),
    )
    q = n * (n + 2) * terms
    return (
        wide.withColumn("q_stat", q)
        .withColumn("p_value", chi_square_tail_even(F.col("q_stat"), lags))
        .select(*panel.keys, "n", "q_stat", "p_value", (F.col("p_value") > alpha).alias("white_noise"))
    )


# Response-surface polynomials for the p-value of the unit-root statistic with a
# constant (MacKinnon 1994): limits, and coefficients for small and for large p.
ADF_MIN, ADF_SWITCH, ADF_MAX = -18.83, -1.61, 2.74
ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)


def adf_p_value(stat: float) -> float:
    if not math.isfinite(stat):
        return float("nan")
    if stat > ADF_MAX:
        return 1.0
    if stat < ADF_MIN:
        return 0.0
    coefs = ADF_SMALL_P if stat <= ADF_SWITCH else ADF_LARGE_P
    z = sum(c * stat**i for i, c in enumerate(coefs))
    return 0.5 * (1.0 + math.erf(z / math.sqrt(2.0)))


def _fit(g: gram.Gram, width: int, which: int) -> tuple[float, float]:
    """(AIC, t-statistic of regressor ``which``) of the model with the first ``width`` regressors."""
    xx, xy = g.xx[:width, :width], g.xy[:width]
    beta = np.linalg.lstsq(xx, xy, rcond=None)[0]
    sse = max(float(g.yy - beta @ xy), 1e-300)
    aic = g.n * (math.log(2 * math.pi) + math.log(sse / g.n) + 1) + 2 * width
    spread = math.sqrt(max(sse / max(g.n - width, 1) * np.linalg.pinv(xx)[which, which], 0.0))
    return aic, float(beta[which]) / spread if spread else math.nan


def unit_root_test(df: DataFrame, panel: Panel, column: str, max_lag: int | None = None, alpha: float = 0.05) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant; the lag count is chosen by AIC.

    Spark reduces each series to cross-product sums over a common sample; a small solve per series
    picks the lag count; a second pass sums over the sample of that lag count.  Each series tries lags up to a
    limit that its own length sets (and ``max_lag``, if given).  Every series has a row; its figures are NULL where it is
    too short or constant.
    """
    known = df.filter(F.col(column).isNotNull()).select(*panel.keys, panel.pos, column)
    n = F.count(column)
    most = F.lit(max_lag) if max_lag is not None else F.ceil(12.0 * F.pow(n / 100.0, F.lit(0.25)))
    limit = F.greatest(F.lit(0), F.least(most, F.floor(n / 2) - 2)).cast("int")
    limits = df.groupBy(*panel.keys).agg(limit.alias("_limit"))
    widest = limits.agg(F.max("_limit")).first()[0] or 0
    new = {"_prev": lag_of(column, 1)}
    stepped = over_chunks(known, panel, new, lookback=1).withColumn("_d", F.col(column) - F.col("_prev"))
    lags = {f"_d{k}": lag_of("_d", k) for k in range(1, widest + 1)}
    lagged = over_chunks(stepped, panel, lags, lookback=widest) if lags else stepped
    regressors = ["_one", "_prev", *lags]
    ready = attach(lagged.withColumn("_one", F.lit(1.0)), limits, panel.keys)

    def up_to(count: str) -> DataFrame:
        """The rows behind the first ``count`` lags.  Regressors past it are zeroed: they drop out of the solve."""
        rows = ready if count in ready.columns else attach(ready, chosen, panel.keys)
        return rows.filter(F.col(panel.pos) > F.col(count)).withColumns(
            {c: F.when(F.col(count) >= k, F.col(c)).otherwise(F.lit(0.0)) for k, c in enumerate(lags, 1)})

    @F.pandas_udf("int")
    def choose(sums: pd.Series, limit: pd.Series) -> pd.Series:
        def one(flat, most) -> int:
            g = gram.unpack(flat, len(regressors))
            return min(range(int(most) + 1), key=lambda k: (_fit(g, 2 + k, 1)[0], k))

        return pd.Series([one(f, m) for f, m in zip(sums, limit)])

    common = gram.sums(up_to("_limit"), [*panel.keys, "_limit"], "_d", regressors)
    chosen = common.select(*panel.keys, choose("_gram", "_limit").alias("lags"))
    final = gram.sums(up_to("lags"), [*panel.keys, "lags"], "_d", regressors)

    @F.pandas_udf("struct<statistic: double, p_value: double>")
    def test(sums: pd.Series, lags: pd.Series) -> pd.DataFrame:
        fits = [(gram.unpack(f, len(regressors)), 2 + int(k)) for f, k in zip(sums, lags)]
        stats = [_fit(g, width, 1)[1] if g.n > width else math.nan for g, width in fits]
        return pd.DataFrame({"statistic": stats, "p_value": [adf_p_value(s) for s in stats]})

    tested = final.withColumn("_t", test("_gram", "lags")).select(
        *panel.keys, "lags", finite(F.col("_t.statistic")).alias("statistic"), finite(F.col("_t.p_value")).alias("p_value"))
    return attach(limits.drop("_limit") if panel.keys else limits, tested, panel.keys).select(
        *panel.keys, "lags", "statistic", "p_value", (F.col("p_value") < alpha).alias("stationary"))
