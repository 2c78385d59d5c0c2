"""Regression-based operators against plain NumPy on small series."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlane.operators import autoregression, boosted, explore, forecast, seasonal
from wattlane.panel import Panel

PANEL = Panel(keys=("series",))
START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(42)
    out = {}
    for name, phi in (("a", 0.7), ("b", -0.3)):
        y = [50.0]
        for _ in range(199):
            y.append(20 + phi * y[-1] + rng.normal())
        out[name] = np.array(y) + 10 * np.sin(2 * np.pi * np.arange(200) / 24)
    return out


@pytest.fixture(scope="module")
def series(spark, values):
    data = [(k, START + dt.timedelta(hours=i), i, float(v)) for k, ys in values.items() for i, v in enumerate(ys)]
    return spark.createDataFrame(data, "series string, ts timestamp, pos long, y double").persist()


def ar_numpy(y, p, d, horizon):
    z = np.diff(y, d)
    cols = [z[p - k - 1: len(z) - k - 1] for k in range(p)] or [np.zeros(len(z))]
    if d == 0:
        cols.append(np.ones(len(z) - p))
    beta = np.linalg.lstsq(np.column_stack(cols), z[p:], rcond=None)[0]
    hist, out = list(z), []
    for _ in range(horizon):
        step = sum(beta[k] * hist[-1 - k] for k in range(p)) + (beta[-1] if d == 0 else 0)
        hist.append(step)
        out.append(step)
    out = np.array(out)
    for i in range(d):
        out = np.diff(y, d - 1 - i)[-1] + np.cumsum(out)
    return out


@pytest.mark.parametrize("p,d", [(0, 0), (0, 1), (0, 2), (1, 0), (3, 0), (1, 1), (2, 1), (2, 2)])
def test_autoregressive_forecast(series, values, p, d):
    got = autoregression.forecast(series, PANEL, "y", p, d, 6)
    for name, y in values.items():
        ours = [r["prediction"] for r in got.filter(F.col("series") == name).orderBy("step").collect()]
        assert ours == pytest.approx(list(ar_numpy(y, p, d, 6)), rel=1e-6)


def test_walk_forward_refits_on_every_prefix(series, values):
    got = autoregression.walk_forward(series, PANEL, "y", 2, 1, window=100, horizon=24).collect()
    starts = {r["fold"]: 100 + 24 * r["fold"] for r in got}
    assert sorted(starts.values()) == [100, 124, 148, 172]  # 172 + 24 <= 200
    for name, y in values.items():
        for fold, start in starts.items():
            ours = [r["prediction"] for r in sorted(got, key=lambda r: r["pos"]) if r["series"] == name and r["fold"] == fold]
            assert ours == pytest.approx(list(ar_numpy(y[:start], 2, 1, 24)), rel=1e-6)


def test_order_search_and_validation(series):
    tried = autoregression.tune(series, PANEL, "y", ps=(1, 2), ds=(0, 1)).collect()
    assert len(tried) == 8 and all(r["mae"] >= 0 for r in tried)
    row = autoregression.validate(series, PANEL, "y", 2, 1).filter("series = 'a'").first()
    assert row["in_mae"] > 0 and row["out_mae"] > 0 and 0 <= row["p_value"] <= 1


def arma_numpy(y, p, q, d, long, lags, horizon):
    """Two least-squares stages on explicit residuals, over the rows with ``lags`` lags."""
    z = np.diff(y, d)
    ones = [np.ones(len(z) - lags)] if d == 0 else []
    past = [z[lags - k: len(z) - k] for k in range(lags + 1)]  # past[k][t] = z[t - k]
    b = np.linalg.lstsq(np.column_stack([*past[1:long + 1], *ones]), past[0], rcond=None)[0] if q else np.zeros(long + 1)
    const = b[long] if q and d == 0 else 0.0
    e = [past[k] - sum(b[j] * past[k + j + 1] for j in range(long)) - const for k in range(q + 1)] if q else []
    cols = [*past[1:p + 1], *e[1:], *ones]
    beta = np.linalg.lstsq(np.column_stack(cols), past[0], rcond=None)[0] if cols else np.zeros(0)
    tail, shocks = list(z[::-1][:p]), [
        z[len(z) - 1 - k] - sum(b[j] * z[len(z) - 2 - k - j] for j in range(long)) - const for k in range(q)]
    ends = [np.diff(y, i)[-1] for i in range(d)]
    out = []
    for _ in range(horizon):
        step = float(np.dot(beta[:p], tail) + np.dot(beta[p:p + q], shocks) + (beta[p + q] if d == 0 else 0.0))
        tail, shocks = [step, *tail][:p], [0.0, *shocks][:q]
        for i in reversed(range(d)):
            ends[i] += step
            step = ends[i]
        out.append(step)
    return out


@pytest.mark.parametrize("p, d, q", [(0, 1, 1), (1, 1, 1), (2, 0, 2), (1, 2, 3), (0, 0, 1)])
def test_moving_average_terms(series, values, p, d, q):
    got = autoregression.forecast(series, PANEL, "y", p, d, 6, q=q, long=8)
    for name, y in values.items():
        ours = [r["prediction"] for r in got.filter(F.col("series") == name).orderBy("step").collect()]
        assert ours == pytest.approx(arma_numpy(y, p, q, d, 8, max(p, 8 + q), 6), rel=1e-6)


def test_folds_with_shocks_of_their_own(series, values):
    got = autoregression.walk_forward(series, PANEL, "y", 1, 1, window=100, horizon=24, q=1, long=6).collect()
    for name, y in values.items():
        for fold in range(4):
            start = 100 + 24 * fold
            ours = [r["prediction"] for r in sorted(got, key=lambda r: r["pos"]) if r["series"] == name and r["fold"] == fold]
            assert ours == pytest.approx(arma_numpy(y[:start], 1, 1, 1, 6, 7, 24), rel=1e-6)


def test_all_orders_in_a_fixed_number_of_scans(spark, series, values):
    small = autoregression.tune(series, PANEL, "y", ps=(0, 1), ds=(0, 1), qs=(0, 1), long=4)
    big = autoregression.tune(series, PANEL, "y", ps=range(6), ds=(0, 1), qs=range(6), long=4)
    scans = [df._jdf.queryExecution().optimizedPlan().toString().count("InMemoryRelation") for df in (small, big)]
    assert scans[0] == scans[1]
    rows = big.collect()
    assert len(rows) == 2 * 72
    y, lags = values["a"], 9
    for r in rows:
        if r["series"] == "a" and (r["p"], r["d"], r["q"]) in {(0, 1, 0), (3, 0, 0), (2, 1, 2), (5, 1, 5)}:
            ahead = np.array(arma_numpy(y[:176], r["p"], r["q"], r["d"], 4, lags, 24))
            assert r["mae"] == pytest.approx(np.abs(y[176:] - ahead).mean(), rel=1e-5)


def test_short_series_and_short_folds_keep_their_rows(spark):
    data = [(k, START + dt.timedelta(hours=i), i, float(i % 7)) for k, n in (("long", 120), ("short", 9)) for i in range(n)]
    df = spark.createDataFrame(data, "series string, ts timestamp, pos long, y double")
    got = autoregression.forecast(df, PANEL, "y", 1, 1, 3, q=1).collect()
    assert sorted((r["series"], r["prediction"] is None) for r in got) == [("long", False)] * 3 + [("short", True)] * 3
    tried = autoregression.tune(df, PANEL, "y", ps=(0, 1), ds=(1,), qs=(0, 1)).collect()
    assert sorted((r["series"], r["mae"] is None) for r in tried) == [("long", False)] * 4 + [("short", True)] * 4
    gaps = df.filter("series = 'long'").withColumn("y", F.when((F.col("pos") % 2 == 1) | (F.col("pos") > 60), F.col("y")))
    folds_ = autoregression.walk_forward(gaps, PANEL, "y", 2, 1, window=50, horizon=24).collect()
    assert {r["fold"]: r["prediction"] is None for r in folds_} == {0: True, 1: True}


def test_seasonal_regression(series, values):
    got = seasonal.forecast(series, PANEL, "y", 12, seasons=("daily",))
    t = np.arange(200)

    def design(h):
        cols = [np.ones(len(h)), h / 1000.0]
        for k in range(1, 5):
            cols += [np.sin(2 * np.pi * k * h / 24), np.cos(2 * np.pi * k * h / 24)]
        return np.column_stack(cols)

    for name, y in values.items():
        beta = np.linalg.lstsq(design(t.astype(float)), y, rcond=None)[0]
        want = design(np.arange(200, 212).astype(float)) @ beta
        ours = [r["prediction"] for r in got.filter(F.col("series") == name).orderBy("step").collect()]
        assert ours == pytest.approx(list(want), rel=1e-3)
    scaled = seasonal.forecast(series, PANEL, "y", 12, seasons=("daily",), standardize=True)
    assert scaled.count() == 24


def acf_numpy(y, lags):
    z = y - y.mean()
    return [float((z[k:] * z[: len(z) - k]).sum() / (z * z).sum()) for k in range(lags + 1)]


def test_autocorrelations(series, values):
    table = explore.autocorrelation_table(series, PANEL, "y", 12)
    partial = explore.partial_autocorrelation(series, PANEL, "y", 6, adjusted=False)
    for name, y in values.items():
        r = acf_numpy(y, 12)
        ours = [x["acf"] for x in table.filter(F.col("series") == name).orderBy("lag").collect()]
        assert ours == pytest.approx(r, abs=1e-9)
        want = [1.0]
        for k in range(1, 7):
            toeplitz = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
            want.append(float(np.linalg.solve(toeplitz, np.array(r[1: k + 1]))[-1]))
        got = [x["pacf"] for x in partial.filter(F.col("series") == name).orderBy("lag").collect()]
        assert got == pytest.approx(want, abs=1e-9)


def adf_numpy(y, max_lag):
    d = np.diff(y)

    def fit(lags, first):
        rows = range(first, len(d))
        x = np.array([[1.0, y[t], *[d[t - k] for k in range(1, lags + 1)]] for t in rows])
        z = d[first:]
        beta = np.linalg.lstsq(x, z, rcond=None)[0]
        sse = ((z - x @ beta) ** 2).sum()
        n, width = x.shape
        aic = n * (math.log(2 * math.pi) + math.log(sse / n) + 1) + 2 * width
        spread = math.sqrt(sse / (n - width) * np.linalg.inv(x.T @ x)[1, 1])
        return aic, beta[1] / spread

    best = min(range(max_lag + 1), key=lambda k: fit(k, max_lag)[0])
    return best, fit(best, best)[1]


def test_unit_root(series, values):
    got = {r["series"]: r for r in explore.unit_root_test(series, PANEL, "y", max_lag=4).collect()}
    for name, y in values.items():
        lags, stat = adf_numpy(y, 4)
        assert got[name]["lags"] == lags and got[name]["statistic"] == pytest.approx(stat, rel=1e-6)
    assert explore.adf_p_value(-2.86) == pytest.approx(0.05, abs=0.003)
    assert explore.adf_p_value(5.0) == 1.0 and explore.adf_p_value(-20.0) == 0.0


def test_unit_root_has_a_row_for_every_series_with_lags_of_its_own(spark, values):
    rows = [("long", i, float(v)) for i, v in enumerate(values["a"])]
    rows += [("short", i, float(v)) for i, v in enumerate(values["b"][:20])]
    rows += [("flat", i, 1.0) for i in range(30)] + [("pair", 0, 1.0), ("pair", 1, 2.0), ("none", 0, None)]
    frame = spark.createDataFrame(rows, "series string, pos long, y double")
    got = {r["series"]: r for r in explore.unit_root_test(frame, PANEL, "y").collect()}
    assert sorted(got) == ["flat", "long", "none", "pair", "short"]
    for name, y, most in (("long", values["a"], 15), ("short", values["b"][:20], 8)):
        lags, stat = adf_numpy(y, most)
        assert got[name]["lags"] == lags and got[name]["statistic"] == pytest.approx(stat, rel=1e-6)
    assert all(got[k]["statistic"] is None and got[k]["stationary"] is None for k in ("pair", "none"))


def test_ljung_box(series, values):
    got = {r["series"]: r for r in explore.ljung_box(series, PANEL, "y", 10).collect()}
    for name, y in values.items():
        r, n = acf_numpy(y, 10), len(y)
        q = n * (n + 2) * sum(r[k] ** 2 / (n - k) for k in range(1, 11))
        assert got[name]["q_stat"] == pytest.approx(q, rel=1e-9) and not got[name]["white_noise"]


def test_decomposition_adds_up(series):
    out = explore.decompose(series, PANEL, "y", 24)
    gap = out.filter(F.col("trend").isNotNull()).select(F.max(F.abs(F.col("y") - F.col("trend") - F.col("seasonal") - F.col("resid")))).first()[0]
    assert gap < 1e-9
    assert out.filter(F.col("trend").isNull()).count() == 2 * 24


def test_ensemble_weights(spark):
    df = spark.createDataFrame([("a", 10.0, 1), ("b", 20.0, 1), ("c", 99.0, 1)], "model string, prediction double, ts int")
    assert forecast.ensemble(df, ["ts"], {"a": 3, "b": 1}).first()["prediction"] == pytest.approx(12.5)
    assert forecast.ensemble(df.filter("model <> 'c'"), ["ts"]).first()["prediction"] == pytest.approx(15.0)


def test_lag_scan_keeps_the_first_of_equal_lags(spark):
    df = spark.createDataFrame([(0, 0.5), (1, -0.9), (2, 0.9)], "lag int, corr double")
    assert explore.best_lag(df).first()["best_lag"] == 1


def test_fold_search_halves_the_field_and_never_trains_on_later_rows(spark, monkeypatch):
    data = [(k, i, float(i % 5), 2.0 * (i % 5) + (i % 3)) for k, n in (("a", 80), ("b", 40)) for i in range(10, 10 + n)]
    rows = spark.createDataFrame(data, "series string, pos long, x double, y double")
    spans, fitted = [], boosted.fit

    def fit(train, features, estimator):
        spans.append({r["series"]: r["m"] for r in train.groupBy("series").agg(F.max("pos").alias("m")).collect()})
        return fitted(train, features, estimator)

    monkeypatch.setattr(boosted, "fit", fit)
    grid = [{"regParam": v} for v in (0.0, 1.0, 10.0, 100.0)]
    got = {r["trial"]: r for r in boosted.search_folds(rows, PANEL, ["x"], "y", boosted.linear, grid).collect()}
    # Folds of 20 and 10 rows: the first models see rows before 20 and 10, the last ones before 60 and 30.
    assert spans == [{"a": 19, "b": 9}] * 4 + [{"a": 39, "b": 19}] * 2 + [{"a": 59, "b": 29}]
    assert [got[i]["folds"] for i in range(4)] == [3, 2, 1, 1] and [i for i in got if got[i]["best"]] == [0]
    again = boosted.search_folds(rows, PANEL, ["x"], "y", boosted.linear, grid).collect()
    assert {r["trial"]: r for r in again} == got


def test_ranges_on_a_log_scale():
    drawn = [g["step"] for g in boosted.random_grid({"step": ("log", 0.001, 1.0)}, 400)]
    assert all(0.001 <= v <= 1.0 for v in drawn) and 150 < sum(v < 0.0316 for v in drawn) < 250
    assert drawn == [g["step"] for g in boosted.random_grid({"step": ("log", 0.001, 1.0)}, 400)]


def test_the_later_share_of_each_series(spark):
    rows = spark.createDataFrame([(k, i) for k, n in (("a", 100), ("b", 10)) for i in range(24, 24 + n)], "series string, pos long")
    got = boosted.mark_later(rows, PANEL).groupBy("series").agg(F.count_if("_later").alias("n")).collect()
    assert {r["series"]: r["n"] for r in got} == {"a": 20, "b": 2}
