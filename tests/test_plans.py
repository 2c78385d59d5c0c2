"""Shapes of physical plans: what is read, and that no row-level table goes to one task."""

import re

import pytest
from pyspark.sql import functions as F

from wattlane.operators import calendar, cleaning, features, folds, supervised
from wattlane.operators.chunks import lag_of, over_chunks
from wattlane.plans import views
from wattlane.panel import Panel

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def exchanges(df) -> list[str]:
    tree = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"\bExchange (.*)", tree)


@pytest.fixture(scope="module")
def series(spark):
    return spark.range(10000).select(
        (F.col("id") % 4).alias("series"), F.timestamp_seconds(F.col("id") * 3600).alias("ts"),
        F.floor(F.col("id") / 4).cast("long").alias("pos"), F.rand(1).alias("x"),
    )


ONE = Panel(keys=())
MANY = Panel(keys=("series",))


@pytest.mark.parametrize("panel", [ONE, MANY])
def test_windows_are_hash_partitioned_by_chunk(series, panel):
    out = over_chunks(series, panel, {"l": lag_of("x", 24)}, lookback=24)
    found = exchanges(out)
    assert found and all("hashpartitioning" in e and "_chunk" in e for e in found)


def test_feature_frame_has_one_shuffle(series):
    out = features.full_features(series, ONE, "x", lags=[1, 24], windows=[6, 24], horizons=[1])
    assert len(exchanges(out)) == 1


def test_boosted_features_have_one_shuffle(series):
    assert len(exchanges(supervised.add_boosted_features(series, MANY, "x"))) == 1


def test_walk_forward_has_one_shuffle(series):
    found = exchanges(folds.walk_forward(series, MANY, "x", 100, 24))
    assert len(found) == 1 and "fold" in found[0]


def test_parameters_without_keys_need_no_join(series):
    text = plan(cleaning.normalize(series, ["x"])[0])
    assert "Join" not in text and "Subquery" in text


def test_scan_reads_only_needed_columns(spark):
    text = plan(views.hourly(spark, FOLDER))
    schemas = re.findall(r"ReadSchema: (.*)", text)
    assert schemas and all("props" not in s and "user_id" not in s for s in schemas)


def test_time_filter_reaches_the_scan(spark):
    from wattlane.operators.calendar import slice_dates

    text = plan(slice_dates(spark.read.parquet(f"{FOLDER}/events.parquet"), views.RAW, "2024-01-05", "2024-01-06"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts", text)


def test_single_task_stages_hold_aggregates_only(spark):
    """A single partition may only receive rows that were aggregated before."""
    for view in (views.hourly, views.energy, views.supplier_daily, views.pairs):
        df = view(spark, FOLDER)
        text = df._jdf.queryExecution().executedPlan().toString()
        lines = text.splitlines()
        for i, line in enumerate(lines):
            if "SinglePartition" in line:
                assert "partial_" in lines[i + 1], text


@pytest.mark.parametrize("panel", [ONE, Panel(keys=("event_type",))])
def test_resample_scans_once(spark, panel):
    out = calendar.resample(spark.read.parquet(f"{FOLDER}/events.parquet"), panel, "H", {"load": ("value", "total")})
    out.collect()
    ran = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert ran.count("FileScan") == 1


def test_resample_keeps_the_values_of_a_null_series(spark):
    df = spark.sql("SELECT * FROM VALUES (NULL, TIMESTAMP'2024-01-01 00:10', 1.0), (NULL, TIMESTAMP'2024-01-01 02:10', 2.0), "
                   "('a', TIMESTAMP'2024-01-01 00:10', 3.0) AS t(series, ts, x)").withColumn("x", F.col("x").cast("double"))
    out = calendar.resample(df, MANY, "H", {"load": ("x", "total")}).orderBy("series", "ts")
    assert [(r["series"], r["load"]) for r in out.collect()] == [(None, 1.0), (None, None), (None, 2.0), ("a", 3.0)]


def test_rolling_takes_arrays_with_the_figures_of_windows(spark):
    from wattlane.operators.chunks import rolling_of

    spec = "series string, pos long, x double, y double"
    values = [None if i % 11 == 7 else float("nan") if i % 37 == 5 else ((i * 7919) % 1013) / 7 - 60 for i in range(240)]
    data = [(k, i, v, float(i) / 3) for k in (None, "a", "b") for i, v in enumerate(values[:80 if k == "b" else 240])]
    df = spark.createDataFrame([*data, ("short", 0, 1.0, None)], spec).repartition(5)
    made = features.add_rolling(df, MANY, ["x", "y"], [3, 6])
    assert "MapInArrow" in plan(made) and "Window" not in plan(made)
    new = {f"{c}_rolling_{n}h_{f}": rolling_of(c, n, f) for c in ("x", "y") for n in (3, 6) for f in features.ROLLING}
    by_window = over_chunks(df, MANY, new, lookback=5)
    assert made.columns == by_window.columns
    assert sorted(map(str, made.collect())) == sorted(map(str, by_window.collect()))
    empty = features.add_rolling(df.where("pos < 0"), MANY, ["x"], [3])
    assert empty.count() == 0 and empty.columns[-1] == "x_rolling_3h_max"
    whole = features.add_rolling(df.withColumn("x", F.col("pos")), MANY, ["x"], [3], ["max"])
    assert whole.schema["x_rolling_3h_max"].dataType.typeName() == "long"


def test_gaps_are_filled_without_sorting_steps(spark):
    rows = [(None, "2024-01-01 05:00:00", 1.0), (None, "2024-01-01 09:30:00", 2.0), ("a", "1999-12-31 23:10:00", 3.0),
            ("a", "1999-12-31 23:50:00", 4.0), ("a", "2001-02-01 00:00:00", None), ("b", None, 5.0), ("c", "1960-01-01 00:00:00", 6.0)]
    df = spark.createDataFrame(rows, "series string, t string, x double").selectExpr("series", "CAST(t AS timestamp) ts", "x")
    made = calendar.resample(df, MANY, "H", {"s": ("x", "sum"), "t": ("x", "total"), "n": ("x", "count")})
    assert "Join" not in plan(made)
    got = {(r.series, r.pos): (str(r.ts), r.s, r.t, r.n) for r in made.collect()}
    days = 366 + 31  # from the last hour of 1999 to the first of February 2001
    assert made.count() == len(got) == 5 + days * 24 + 2 + 1
    assert got[None, 0] == ("2024-01-01 05:00:00", 1.0, 1.0, 1) and got[None, 4] == ("2024-01-01 09:00:00", 2.0, 2.0, 1)
    assert got[None, 2] == ("2024-01-01 07:00:00", 0.0, None, 0) and got["c", 0] == ("1960-01-01 00:00:00", 6.0, 6.0, 1)
    assert got["a", 0] == ("1999-12-31 23:00:00", 7.0, 7.0, 2) and got["a", days * 24 + 1] == ("2001-02-01 00:00:00", 0.0, None, 0)
    assert got["a", 5000][0] == "2000-07-27 07:00:00"


def test_rounding_near_ties_and_far_from_them(spark):
    from wattlane.plans.catalog import rounded

    values = [0.5, -0.5, 2.5e-6, 1.0000005, 1.0000015, -1.0000005, 0.1234565, 1 / 3, -2 / 3, 1e5 / 7, 1e18 / 7, 1e300, 0.0, -0.0,
              float("nan"), float("inf"), float("-inf"), None, 123456.7890125, 2.675, 1.005]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 1, 2, 6, 7):
        found = df.select((rounded(F.col("v"), digits) + F.lit(0.0)).alias("a"), (F.round("v", digits) + F.lit(0.0)).alias("b"))
        assert [str(r.a) for r in found.collect()] == [str(r.b) for r in found.collect()]
