"""Small inputs with hand-computed results for the semantic traps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattlane.functions import categories
from wattlane.functions.energy import row_sum
from wattlane.functions.time import parse_time
from wattlane.operators import calendar, cleaning, features, folds, forecast, kpi, metrics
from wattlane.operators.chunks import over_chunks, rolling_of
from wattlane.panel import Panel

ONE = Panel(keys=())


def frame(spark, values, start="2024-01-01 00:00:00"):
    base = dt.datetime.fromisoformat(start)
    data = [(base + dt.timedelta(hours=i), i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "ts timestamp, pos long, x double")


def column(df, name, order="pos"):
    return [r[0] for r in df.orderBy(order).select(name).collect()]


def test_rolling_mean_needs_a_full_frame(spark):
    df = over_chunks(frame(spark, [1.0, None, 3.0, 4.0, 5.0, 6.0]), ONE, {"m": rolling_of("x", 2, "mean")}, lookback=1)
    assert column(df, "m") == [None, None, None, 3.5, 4.5, 5.5]


def test_unknown_rolling_function(spark):
    with pytest.raises(ValueError):
        rolling_of("x", 2, "median")


def test_bins(spark):
    df = spark.createDataFrame([(0.0, 0), (5.0, 1), (5.1, 2), (25.0, 3), (None, 4)], "x double, pos int")
    assert column(df.select("pos", categories.wind_category(F.col("x")).alias("c")), "c") == [None, "calm", "light", "storm", None]
    df = spark.createDataFrame([(0.0, 0), (30.0, 1), (100.0, 2), (101.0, 3)], "x double, pos int")
    assert column(df.select("pos", categories.humidity_category(F.col("x")).alias("c")), "c") == [None, "dry", "very_humid", None]
    df = spark.createDataFrame([(-3.0, 0), (0.0, 1), (0.1, 2), (30.0, 3), (30.1, 4)], "x double, pos int")
    assert column(df.select("pos", categories.temperature_category(F.col("x")).alias("c")), "c") == [
        "freezing", "freezing", "cold", "warm", "hot"]


def test_resample_of_empty_hours(spark):
    data = [(dt.datetime(2024, 1, 1, 0, 10), 1.0), (dt.datetime(2024, 1, 1, 2, 10), None), (dt.datetime(2024, 1, 1, 2, 20), 7.0)]
    df = spark.createDataFrame(data, "ts timestamp, x double")
    out = calendar.resample(df, ONE, "H", {m: ("x", m) for m in ("mean", "sum", "first", "last", "total", "count")})
    assert column(out, "mean") == [1.0, None, 7.0]
    assert column(out, "sum") == [1.0, 0.0, 7.0]
    assert column(out, "first") == [1.0, None, 7.0]
    assert column(out, "last") == [1.0, None, 7.0]
    assert column(out, "total") == [1.0, None, 7.0]
    assert column(out, "count") == [1, 0, 1]
    with pytest.raises(ValueError):
        calendar.resample(df, ONE, "H", {"x": ("x", "median")})
    with pytest.raises(ValueError):
        calendar.resample(df, ONE, "5min", {"x": ("x", "mean")})


def test_row_sums_skip_nulls(spark):
    df = spark.createDataFrame([(0, None, None), (1, 1.0, None)], "pos int, a double, b double")
    assert column(df.select("pos", row_sum(["a", "b"]).alias("s")), "s") == [0.0, 1.0]


def test_one_hot_of_null_is_false(spark):
    df = spark.createDataFrame([(0, "x"), (1, None), (2, "y")], "pos int, weather_main string")
    made = features.add_weather(df, ONE)
    assert column(made, "weather_x") == [True, False, False]
    assert column(made, "weather_y") == [False, False, True]


@pytest.mark.parametrize(
    "strategy,value", [("mean", 2.0), ("median", 1.0), ("most_frequent", 1.0), ("constant", 0.0), ("nonsense", 2.0)]
)
def test_imputation(spark, strategy, value):
    df = frame(spark, [1.0, 1.0, 4.0, None])
    assert column(cleaning.impute(df, ["x"], strategy), "x") == [1.0, 1.0, 4.0, value]


def test_all_null_column_stays(spark):
    df = frame(spark, [None, None])
    for strategy in ("mean", "median", "most_frequent", "constant"):
        assert column(cleaning.impute(df, ["x"], strategy), "x") == [None, None]


def test_fill_both_ways_of_a_series_without_values_falls_back(spark):
    df = frame(spark, [None, None])
    assert column(cleaning.impute(df, ["x"], "ffill_bfill", panel=ONE), "x") == [0.0, 0.0]


def test_null_is_no_outlier(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, None])
    assert column(cleaning.drop_outliers(df, ["x"]), "x") == [1.0, 2.0, 3.0, 4.0, 5.0, None]
    assert column(cleaning.flag_outliers(df, "x"), "is_outlier") == [False] * 5 + [True, False]
    with pytest.raises(ValueError):
        cleaning.drop_outliers(df, ["x"], method="other")


@pytest.mark.parametrize("method", ["standard", "minmax"])
def test_scaling_a_constant_gives_zero(spark, method):
    scaled, params = cleaning.normalize(frame(spark, [5.0, 5.0, 5.0]), ["x"], method)
    assert column(scaled, "x") == [0.0, 0.0, 0.0]
    assert column(cleaning.unscale(scaled, params, ["x"]), "x") == [5.0, 5.0, 5.0]


def test_contract(spark):
    df = frame(spark, [1.0])
    assert cleaning.check_contract(df, {"x": "double"}) is df
    for bad in ({"y": "double"}, {"x": "string"}):
        with pytest.raises(cleaning.ContractError):
            cleaning.check_contract(df, bad)
    with pytest.raises(cleaning.ContractError):
        cleaning.check_contract(df.limit(0), {"x": "double"})


def starts(df):
    return sorted({r[0] for r in df.select("fold_start").collect()})


def test_walk_forward_keeps_the_fold_that_ends_the_series(spark):
    df = frame(spark, [float(i) for i in range(100)])
    out = folds.walk_forward(df, ONE, "x", window=40, horizon=20)
    assert starts(out) == [40, 60, 80]
    assert [r["naive"] for r in out.orderBy("pos").collect()] == [39.0] * 20 + [59.0] * 20 + [79.0] * 20
    assert starts(folds.walk_forward(frame(spark, [1.0] * 99), ONE, "x", 40, 20)) == [40, 60]


def test_time_series_split(spark):
    df = frame(spark, [1.0] * 100)
    table = folds.time_series_splits(df, ONE, 3)
    assert sorted(tuple(r) for r in table.collect()) == [(0, 25, 25), (1, 50, 25), (2, 75, 25)]
    fold = column(folds.assign_time_series_split(df, ONE, 3), "fold")
    assert fold == [None] * 25 + [0] * 25 + [1] * 25 + [2] * 25


def test_split_sizes(spark):
    df = frame(spark, [1.0] * 200)
    parts = {r["split"]: r["count"] for r in folds.split_by_fraction(df, ONE).groupBy("split").count().collect()}
    assert parts == {"train": 160, "test": 40}


def test_tail_folds_need_fifty_training_rows(spark):
    out = folds.tail_folds(frame(spark, [float(i) for i in range(80)]), ONE, "x")
    assert starts(out) == [56, 68]
    assert {r["fold_start"]: r["naive"] for r in out.collect()} == {56: 55.0, 68: 67.0}


def test_batch_forecast_keeps_the_last_full_chunk(spark):
    df = frame(spark, [float(i) for i in range(96)])
    out = forecast.batch_naive(df, ONE, "x", batch=24, horizon=2)
    assert sorted({r["chunk"] for r in out.collect()}) == [0, 1, 2, 3]
    assert column(out, "prediction", "ts") == [23.0, 23.0, 47.0, 47.0, 71.0, 71.0, 95.0, 95.0]


def test_horizon_limits(spark):
    df = frame(spark, [1.0])
    for bad in (0, 169):
        with pytest.raises(ValueError):
            forecast.naive(df, ONE, "x", bad)


def pairs(spark, values):
    return spark.createDataFrame(values, "actual double, prediction double")


def test_mape_with_a_zero_actual_is_undefined(spark):
    row = metrics.regression_metrics(pairs(spark, [(0.0, 1.0), (2.0, 2.0)])).first()
    assert row["mape"] is None and row["mae"] == 0.5


@pytest.mark.parametrize("data,r2", [
    ([(2.0, 2.0), (2.0, 2.0)], 1.0), ([(2.0, 2.0), (2.0, 3.0)], 0.0), ([(2.0, 2.0)], None), ([(1.0, 1.0), (3.0, 3.0)], 1.0),
])
def test_r_squared_of_constant_actuals(spark, data, r2):
    assert metrics.regression_metrics(pairs(spark, data)).first()["r2"] == r2


def test_infinite_folds_are_left_out(spark):
    inf = float("inf")
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", inf), ("b", inf)], "model string, mae double")
    out = {r["model"]: r for r in metrics.fold_summary(df, names=["mae"]).collect()}
    assert out["a"]["mae_mean"] == 2.0 and out["a"]["mae_std"] == 1.0 and out["b"]["mae_mean"] is None
    assert metrics.best_by_error(metrics.fold_summary(df, names=["mae"])).first()["best_model"] == "a"


def test_best_of_three(spark):
    df = spark.createDataFrame([("arima", 1000.0), ("prophet", 1200.0), ("lstm", 800.0)], "model string, mae double")
    best = metrics.best_by_error(df, error="mae").first()
    assert tuple(best) == ("lstm", 800.0)


def test_reliability_without_interval(spark):
    row = kpi.reliability(pairs(spark, [(10.0, 10.0), (20.0, 20.0)])).first()
    assert row["reliability_score"] == pytest.approx(80.0) and row["pred_coverage"] == 0.0


def test_offsets_meet_in_utc(spark):
    df = spark.createDataFrame([(0, "2024-01-01T01:00:00+01:00"), (1, "2024-01-01T00:00:00+00:00"), (2, "junk")], "pos int, t string")
    a, b, c = column(df.select("pos", parse_time(F.col("t")).alias("p")), "p")
    assert a == b and c is None


def test_slice_of_an_empty_range_is_empty(spark):
    df = frame(spark, [1.0] * 48)
    assert calendar.slice_dates(df, ONE, "2024-01-02", "2024-01-02").count() == 24
    assert calendar.slice_dates(df, ONE, "2030-01-01", "2030-01-02").count() == 0


def test_lags_warm_up_before_rolling(spark):
    base = frame(spark, [float(i) for i in range(12)])
    made = features.full_features(base, ONE, "x", lags=[1, 4], windows=[3], horizons=[1])
    assert column(made, "x_lag_4h") == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0]
    assert column(made, "x_rolling_3h_mean") == [None, None, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0]
    assert column(made, "x_target_1h")[-1] is None


def test_mode_of_text(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert sorted(r[0] for r in cleaning.impute(df, ["c"], "most_frequent").collect()) == ["a", "a", "a", "b", "b"]


def test_strict_time_parsing_fails(spark):
    df = spark.createDataFrame([("junk",)], "t string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        df.select(parse_time(F.col("t"), strict=True)).collect()


def test_lags_by_the_clock_step_over_missing_hours(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0]).filter("pos <> 1")
    assert column(features.add_time_lags(df, ONE, ["x"], [1]), "x_lag_1h") == [None, None, 3.0]


def test_random_grid_is_repeatable():
    from wattlane.operators.boosted import random_grid

    ranges = {"maxDepth": (2, 6), "stepSize": (0.01, 0.3), "maxIter": [5, 10]}
    grid = random_grid(ranges, 5)
    assert grid == random_grid(ranges, 5) and len(grid) == 5
    assert all(2 <= g["maxDepth"] <= 6 and 0.01 <= g["stepSize"] <= 0.3 and g["maxIter"] in (5, 10) for g in grid)


def test_one_hot_weather_of_types_that_no_row_has(spark, tmp_path):
    from __spark_entry__ import queries

    spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 5), 3, "click", 4.0, '{"k": 7}'),
         (2, dt.datetime(2024, 1, 1, 5), 3, "view", 4.0, '{"k": 8}'),
         (3, dt.datetime(2024, 1, 1, 6), 3, "error", 4.0, '{"k": 70}')],
        "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    ).selectExpr("event_id", "CAST(ts AS timestamp_ntz) AS ts", "user_id", "event_type", "value", "props").write.parquet(
        f"{tmp_path}/events.parquet")
    made = queries()["one_hot_weather"](spark, str(tmp_path)).orderBy("ts")
    flags = ["weather_click", "weather_error", "weather_purchase", "weather_signup", "weather_view"]
    assert made.columns == ["ts", "city", *flags]
    # The second hour's type is hidden by its humidity of 70.
    assert [tuple(r)[2:] for r in made.collect()] == [(True, False, False, False, False), (False,) * 5]
