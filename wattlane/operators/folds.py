"""Time-ordered splits and validation folds.

Folds are never built by copying training rows: test rows get their fold number by arithmetic on the
position, and what a fold needs to know about its past comes along as one extra row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wattlane.operators.params import attach
from wattlane.panel import Panel


def sizes(df: DataFrame, panel: Panel) -> DataFrame:
    return df.groupBy(*panel.keys).agg(F.count(F.lit(1)).alias("_size"))


def split_by_fraction(df: DataFrame, panel: Panel, fraction: float = 0.8) -> DataFrame:
    """``split`` = train for the first ``int(n * fraction)`` rows of a series, else test.

    ``pos`` restarts at 0 in the test rows.
    """
    cut = F.floor(F.col("_size") * F.lit(float(fraction)))
    late = F.col(panel.pos) >= cut
    return (
        attach(df, sizes(df, panel), panel.keys)
        .withColumn("split", F.when(late, "test").otherwise("train"))
        .withColumn(panel.pos, F.when(late, F.col(panel.pos) - cut).otherwise(F.col(panel.pos)))
        .drop("_size")
    )


def split_train_validation_test(df: DataFrame, panel: Panel, fraction: float = 0.8) -> DataFrame:
    """Nested split: the training share is cut once more by the same fraction."""
    n = F.col("_size")
    outer = F.floor(n * F.lit(float(fraction)))
    inner = F.floor(outer * F.lit(float(fraction)))
    pos = F.col(panel.pos)
    role = F.when(pos < inner, "train").when(pos < outer, "validation").otherwise("test")
    return attach(df, sizes(df, panel), panel.keys).withColumn("split", role).drop("_size")


def tail(df: DataFrame, panel: Panel, rows: int) -> DataFrame:
    """Last ``rows`` rows of each series."""
    counted = attach(df, sizes(df, panel), panel.keys)
    return counted.filter(F.col(panel.pos) >= F.col("_size") - rows).drop("_size")


def head(df: DataFrame, panel: Panel, rows: int) -> DataFrame:
    return df.filter(F.col(panel.pos) < rows)


def recent_fraction(df: DataFrame, panel: Panel, fraction: float) -> DataFrame:
    """Last ``int(n * fraction)`` rows of each series, renumbered from 0."""
    start = F.col("_size") - F.floor(F.col("_size") * F.lit(float(fraction)))
    counted = attach(df, sizes(df, panel), panel.keys).withColumn("_start", start)
    return (
        counted.filter(F.col(panel.pos) >= F.col("_start"))
        .withColumn(panel.pos, F.col(panel.pos) - F.col("_start"))
        .drop("_size", "_start")
    )


def reference_and_current(df: DataFrame, panel: Panel, fraction: float = 0.9) -> DataFrame:
    """``batch`` = reference for the first share of a series, current for the rest."""
    cut = F.floor(F.col("_size") * F.lit(float(fraction)))
    batch = F.when(F.col(panel.pos) < cut, "reference").otherwise("current")
    return attach(df, sizes(df, panel), panel.keys).withColumn("batch", batch).drop("_size")


def time_series_splits(df: DataFrame, panel: Panel, splits: int = 5) -> DataFrame:
    """Number of training and test rows, and first test position, of every split.

    Split ``i`` tests ``n // (splits + 1)`` rows from ``n - (splits - i) * size`` on and trains on
    all rows before them.
    """
    size = F.floor(F.col("_size") / F.lit(splits + 1))
    return (
        sizes(df, panel)
        .withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
        .withColumn("test_start", (F.col("_size") - (F.lit(splits) - F.col("fold")) * size).cast("long"))
        .select(*panel.keys, "fold", "test_start", size.cast("long").alias("test_size"))
        .filter(F.col("test_size") > 0)
    )


def assign_time_series_split(df: DataFrame, panel: Panel, splits: int = 5) -> DataFrame:
    """``fold`` in which a row is tested; NULL for rows that only train.  Folds train on all rows
    before their first test row, so the number says everything."""
    size = F.floor(F.col("_size") / F.lit(splits + 1))
    first = F.col("_size") - splits * size
    pos = F.col(panel.pos)
    fold = F.when((pos >= first) & (size > 0), F.floor((pos - first) / size))
    return attach(df, sizes(df, panel), panel.keys).withColumn("fold", fold.cast("long")).drop("_size")


def walk_forward(df: DataFrame, panel: Panel, target: str, window: int = 720, horizon: int = 24) -> DataFrame:
    """Test rows of every fold with the fold's number and its naive forecast.

    Fold ``k`` starts at ``i = window + k * horizon``, tests ``[i, i + horizon)`` and exists if all
    these rows do.  Each fold is one group of ``horizon + 1`` rows: its test rows and the row before
    them (whose value is the naive forecast).  One shuffle, no counting pass and no join.
    """
    pos = F.col(panel.pos)
    since = pos - window
    here = F.floor(since / F.lit(horizon))
    at_end = (since + 1) % F.lit(horizon) == 0
    roles = F.array_compact(
        F.array(
            F.when(since >= 0, F.struct(here.alias("fold"), F.lit("test").alias("role"))),
            F.when(
                (since >= -1) & at_end, F.struct((here + 1).alias("fold"), F.lit("origin").alias("role"))
            ),
        )
    )
    spread = df.select(*panel.keys, panel.ts, panel.pos, target, F.inline(roles))
    group = Window.partitionBy(*panel.keys, "fold")
    naive = F.max(F.when(F.col("role") == "origin", F.col(target))).over(group)
    complete = F.max(((F.col("role") == "test") & at_end).cast("int")).over(group)
    return (
        spread.select("*", naive.alias("naive"), complete.alias("_complete"))
        .filter((F.col("role") == "test") & (F.col("_complete") == 1))
        .select(
            *panel.keys,
            "fold",
            (F.col("fold") * horizon + window).alias("fold_start"),
            panel.ts,
            panel.pos,
            F.col(target).alias("actual"),
            "naive",
        )
    )


def expanding_window(df: DataFrame, panel: Panel, target: str, initial: int = 168, horizon: int = 24) -> DataFrame:
    return walk_forward(df, panel, target, initial, horizon)


def tail_folds(
    df: DataFrame, panel: Panel, target: str, splits: int = 3, test_rows: int = 12,
    min_train: int = 50, recent: float = 1.0,
) -> DataFrame:
    """Short folds at the end of each series with their naive forecast.

    ``recent`` keeps only the last share of a series first.
    """
    rows = recent_fraction(df, panel, recent) if recent < 1.0 else df
    first = F.col("_size") - splits * test_rows
    since = F.col(panel.pos) - first
    counted = attach(rows, sizes(rows, panel), panel.keys).filter(since >= -1)
    here = F.floor(since / F.lit(test_rows))
    roles = F.array_compact(
        F.array(
            F.when(since >= 0, F.struct(here.alias("fold"), F.lit("test").alias("role"))),
            F.when(
                ((since + 1) % F.lit(test_rows) == 0) & (here + 1 < splits),
                F.struct((here + 1).alias("fold"), F.lit("origin").alias("role")),
            ),
        )
    )
    spread = counted.select(*panel.keys, panel.ts, panel.pos, target, "_size", F.inline(roles))
    group = Window.partitionBy(*panel.keys, "fold")
    naive = F.max(F.when(F.col("role") == "origin", F.col(target))).over(group)
    start = F.col("_size") - (F.lit(splits) - F.col("fold")) * test_rows
    return (
        spread.withColumn("naive", naive)
        .filter((F.col("role") == "test") & (start >= min_train))
        .select(*panel.keys, "fold", start.alias("fold_start"), panel.ts, panel.pos,
                F.col(target).alias("actual"), "naive")
    )
