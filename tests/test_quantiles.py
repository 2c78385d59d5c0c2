"""Exact quantiles by radix selection, against Spark's one-buffer percentile and sorted lists."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlane.operators import cleaning
from wattlane.operators.quantiles import iqr_bounds, key_value, most_frequent, quantile_name, quantiles, sort_keys

PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


@pytest.fixture(scope="module")
def values(spark):
    """Heavy tail, a value that holds a seventh of the rows, and missing values."""
    x = F.when(F.col("id") % 7 == 0, 5.0).when(F.col("id") % 11 == 0, None).otherwise(F.exp(F.rand(3) * 15) - 50)
    return spark.range(20000).select((F.col("id") % 3).alias("g"), x.alias("x")).persist()


@pytest.mark.parametrize("by", [[], ["g"]])
def test_radix_equals_one_buffer(values, by, rows):
    order = by or [F.lit(1)]
    want = values.groupBy(*by).agg(
        *[F.percentile("x", F.lit(q)).alias(quantile_name("x", q)) for q in PROBS]
    )
    got = quantiles(values, ["x"], PROBS, by)
    pairs = zip(rows(got.select(want.columns), *order), rows(want, *order), strict=True)
    assert all(a == pytest.approx(b, rel=1e-15) for a, b in pairs)


def test_two_columns_at_once(values):
    df = values.withColumn("y", -F.col("x"))
    got = quantiles(df, ["x", "y"], [0.25, 0.75]).first()
    assert got["x_q0_25"] == pytest.approx(-got["y_q0_75"], rel=1e-15)


EDGES = [0.0, -0.0, 1.0, -1.0, 2.0, 1.5, math.pi, 1e300, -1e300, 1.7976931348623157e308, -1.7976931348623157e308,
         2.2250738585072014e-308, 2.225073858507201e-308, 5e-324, -5e-324, 1e-310, math.inf, -math.inf,
         *[2.0**k for k in range(-1074, 1024, 97)], *[np.nextafter(2.0**k, 0) for k in range(-1020, 1024, 61)],
         *[np.nextafter(2.0**k, np.inf) for k in range(-1020, 1024, 61)], 0.1, 1 / 3, 123456789.123]


def test_keys_keep_order_and_can_be_undone(spark):
    draw = np.random.default_rng(1)
    bits = draw.integers(0, 1 << 63, 3000, dtype=np.int64) ^ draw.integers(-1, 1, 3000, dtype=np.int64)
    drawn = [v for v in bits.view(np.float64).tolist() if not math.isnan(v)]
    sample = [float(v) for v in EDGES] + drawn
    df = sort_keys(spark.createDataFrame([(v,) for v in sample], "x double"), ["x"], keep=["x"])
    found = df.withColumn("back", key_value(F.col("_k0"))).collect()
    assert all(r["x"] == r["back"] for r in found)
    found.sort(key=lambda r: r["x"])
    keys = [r["_k0"] for r in found]
    assert keys == sorted(keys) and len(set(keys)) == len({v for v in sample})


def test_values_over_the_whole_range_of_doubles(spark):
    sample = [float(v) for v in EDGES]
    df = spark.createDataFrame([(v,) for v in sample], "x double")
    sample.sort()
    for k in (0, 1, len(sample) // 2, len(sample) - 1):
        q = k / (len(sample) - 1)
        got = quantiles(df, ["x"], [q]).first()[0]
        assert got == pytest.approx(sample[k], rel=1e-12) or got == sample[k]


def test_all_values_equal(spark):
    df = spark.range(5000).select(F.lit(2.0).alias("x"))
    assert quantiles(df, ["x"], [0.25, 0.5]).first()[0] == 2.0


def test_empty_tables_and_missing_groups(spark):
    df = spark.createDataFrame([(None, 1.0, 5), ("a", None, None), ("a", None, 7), (None, 3.0, 9)], "g string, x double, n int")
    got = {r["g"]: tuple(r)[1:] for r in quantiles(df, ["x", "n"], [0.5], ["g"]).collect()}
    assert got == {None: (2.0, 7.0), "a": (None, 7.0)}
    assert [tuple(r) for r in quantiles(df.limit(0), ["x"], [0.5]).collect()] == [(None,)]
    assert quantiles(df.limit(0), ["x"], [0.5], ["g"]).count() == 0


def test_quantile_of_a_short_column_with_a_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    assert quantiles(df, ["x"], [0.25]).first()[0] == 1.75
    assert iqr_bounds(df, "x").first()[0] == pytest.approx(1.75 - 1.5 * 1.5)


def test_no_list_grows_with_the_values(values):
    plan = quantiles(values, ["x"], [0.25, 0.5], ["g"])._jdf.queryExecution().toString().lower()
    assert "collect_list" not in plan and "collect_set" not in plan and "percentile" not in plan


def test_statistics_per_series(spark):
    rows = [("a", 1.0), ("a", None), ("a", 3.0), ("a", 2.0), ("b", 100.0), ("b", None), ("b", 300.0), (None, None)]
    df = spark.createDataFrame(rows, "s string, x double")
    for strategy, want in (("median", {("a", 2.0), ("b", 200.0)}), ("mean", {("a", 2.0), ("b", 200.0)}),
                           ("most_frequent", {("a", 1.0), ("b", 100.0)})):
        filled = cleaning.impute(df.withColumn("was", F.col("x")), ["x"], strategy, by=["s"]).where("was IS NULL AND s IS NOT NULL")
        assert {(r["s"], r["x"]) for r in filled.collect()} == want, strategy
    spread = [("a", float(v)) for v in range(10)] + [("a", 99.0)] + [("b", 1000.0 + v) for v in range(10)] + [("b", 9.0)]
    df = spark.createDataFrame(spread, "s string, x double")
    flagged = {(r["s"], r["x"]) for r in cleaning.flag_outliers(df, "x", by=["s"]).where("is_outlier").collect()}
    assert flagged == {("a", 99.0), ("b", 9.0)}


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (1.0,), (3.0,), (None,)], "x double")
    assert most_frequent(df, "x").first()[0] == 1.0
