"""Chunked and blocked forms against one global window."""

import pytest
from pyspark.sql import Window, functions as F

from wattlane.operators.chunks import fill_both_ways, lag_of, lead_of, over_chunks, rolling_of
from wattlane.operators.ordering import reposition, running_totals, with_positions
from wattlane.panel import Panel

PANEL = Panel(keys=("series",))


@pytest.fixture(scope="module")
def series(spark):
    """Three series, one of them holding most rows; a third of the values is missing."""
    ids = spark.range(1500)
    key = F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").otherwise("small")
    value = F.when(F.col("id") % 3 != 1, F.sin("id") * 100)
    base = ids.select(key.alias("series"), F.timestamp_seconds(F.col("id") * 3600).alias("ts"), value.alias("x"))
    w = Window.partitionBy("series").orderBy("ts")
    return base.withColumn("pos", (F.row_number().over(w) - 1).cast("long")).persist()


def test_chunked_windows_equal_global_windows(spark, series, rows):
    columns = {
        "lag_5": lag_of("x", 5), "lead_7": lead_of("x", 7), "mean_6": rolling_of("x", 6, "mean"),
        "std_9": rolling_of("x", 9, "std", shift=1), "min_3": rolling_of("x", 3, "min"),
    }
    w = Window.partitionBy("series").orderBy("pos")
    whole = series.select("*", *[fn(w).alias(n) for n, fn in columns.items()])
    for size in (10, 64, 8192):
        cut = over_chunks(series, PANEL, columns, lookback=9, lookahead=7, chunk_rows=size)
        assert cut.count() == 1500
        assert rows(cut.select(whole.columns), "series", "pos") == rows(whole, "series", "pos")


def test_halo_is_never_smaller_than_the_frame(series, rows):
    w = Window.partitionBy("series").orderBy("pos")
    cut = over_chunks(series, PANEL, {"l": lag_of("x", 40)}, lookback=40, chunk_rows=3)
    assert rows(cut.select("series", "pos", "l"), "series", "pos") == rows(
        series.select("series", "pos", F.lag("x", 40).over(w).alias("l")), "series", "pos"
    )


def test_positions_with_equal_times_and_a_hot_instant(spark, rows):
    ids = spark.range(2000)
    ts = F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 50).otherwise(F.col("id")))
    df = ids.select((F.col("id") % 2).alias("series"), ts.alias("ts"), F.col("id").alias("tie"))
    panel = Panel(tie=("tie",))
    w = Window.partitionBy("series").orderBy("ts", "tie")
    want = df.withColumn("pos", (F.row_number().over(w) - 1).cast("long"))
    got = with_positions(df, panel)
    assert rows(got.select(want.columns), "series", "pos") == rows(want, "series", "pos")


def test_positions_of_one_long_series(spark, rows):
    df = spark.range(1000).select(F.timestamp_seconds(F.hash("id").cast("long") % 100000).alias("ts"), F.col("id").alias("tie"))
    got = with_positions(df, Panel(keys=(), tie=("tie",)))
    want = df.withColumn("pos", (F.row_number().over(Window.orderBy("ts", "tie")) - 1).cast("long"))
    assert rows(got.select(want.columns), "pos") == rows(want, "pos")


def test_reposition_counts_survivors(series, rows):
    kept = series.filter(F.col("x").isNotNull())
    got = reposition(kept, PANEL, chunk_rows=16)
    w = Window.partitionBy("series").orderBy("ts")
    want = kept.withColumn("pos", (F.row_number().over(w) - 1).cast("long"))
    assert rows(got.select(want.columns), "series", "pos") == rows(want, "series", "pos")


def test_fill_carries_across_chunks(spark, rows):
    gaps = [None, None, 3.0] + [None] * 20 + [7.0] + [None] * 15
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(gaps)] + [("b", 0, None)], "series string, pos long, x double")
    got = fill_both_ways(df, PANEL, ["x"], chunk_rows=4)
    want = [("a", i, 3.0 if i < 23 else 7.0) for i in range(len(gaps))] + [("b", 0, None)]
    assert rows(got, "series", "pos") == want


def test_running_totals(spark, rows):
    df = spark.range(500).select((F.hash("id") % 10000).alias("v"), F.col("id").alias("n")).dropDuplicates(["v"])
    got = running_totals(df, ["v"], ["n"])
    want = df.withColumn("cum_n", F.sum("n").over(Window.orderBy("v")))
    assert rows(got.select("v", "cum_n"), "v") == rows(want.select("v", "cum_n"), "v")
