"""Moments of columns that merge: counts, means, squared deviations, extremes and missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wattlane.operators.drift import MEAN_SHIFT


def of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: ``field``, ``n`` (values), ``missing``, ``mean``, ``m2``, ``low``, ``high``; one pass."""
    cells = [
        F.struct(
            F.lit(c).alias("field"), F.count(c).alias("n"), F.count_if(F.col(c).isNull()).alias("missing"),
            F.avg(c).cast("double").alias("mean"), (F.var_pop(c) * F.count(c)).alias("m2"),
            F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high"),
        )
        for c in columns
    ]
    return df.agg(F.array(*cells).alias("_c")).select(F.inline("_c"))


def merged(parts: DataFrame) -> DataFrame:
    """The moments of all rows behind ``parts``, as if taken in one pass."""
    n = F.sum("n")
    middle = parts.groupBy("field").agg(
        n.alias("n"), F.sum("missing").alias("missing"), (F.sum(F.col("mean") * F.col("n")) / F.nullif(n, F.lit(0))).alias("mean"),
        F.min("low").alias("low"), F.max("high").alias("high"))
    gaps = parts.select("field", F.col("n").alias("_n"), F.col("mean").alias("_mean"), F.col("m2").alias("_m2")).join(
        middle.select("field", F.col("mean").alias("_all")), "field")
    spread = gaps.groupBy("field").agg(F.sum(F.col("_m2") + F.col("_n") * F.pow(F.col("_mean") - F.col("_all"), 2)).alias("m2"))
    return middle.join(spread, "field").select("field", "n", "missing", "mean", "m2", "low", "high")


def compare(reference: DataFrame, current: DataFrame, threshold: float = MEAN_SHIFT) -> DataFrame:
    """Means, deviations and missing shares of both sides per column, and whether the mean has shifted."""

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = F.col("n") + F.col("missing")
        return df.select(
            "field", F.col("n").alias(f"{name}_n"), F.col("mean").alias(f"{name}_mean"),
            F.sqrt(F.col("m2") / F.nullif("n", F.lit(0))).alias(f"{name}_std"),
            (F.col("missing") / F.nullif(rows, F.lit(0))).alias(f"{name}_missing"))

    both = side(reference, "reference").join(side(current, "current"), "field")
    gap = F.abs(F.col("reference_mean") - F.col("current_mean"))
    return both.withColumn("drifted", F.coalesce(gap > threshold * F.abs("reference_mean"), F.lit(False)))
