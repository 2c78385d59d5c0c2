"""Data quality and drift between a reference and a current table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattlane.operators.ordering import running_totals
from wattlane.operators.params import finite
from wattlane.session import materialize

# Relative mean shift that counts as drift, weight of one column, KS significance.
MEAN_SHIFT = 0.1
COLUMN_WEIGHT = 0.1
KS_ALPHA = 0.05
# Cramer's V above which a categorical column drifted, share of columns that makes a table drift.
CRAMERS_V = 0.1
DRIFT_SHARE = 0.5
# Fixed value: cost of a fully missing column in the quality score.
MISSING_WEIGHT = 0.1


def missing_shares(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of NULLs per column, one pass."""
    names = list(columns) if columns is not None else df.columns
    cells = [
        F.struct(
            F.lit(c).alias("field"),
            F.count_if(F.col(c).isNull()).alias("missing"),
            (F.count_if(F.col(c).isNull()) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("share"),
        )
        for c in names
    ]
    return df.agg(F.array(*cells).alias("_c")).select(F.inline("_c"))


def quality_score(shares: DataFrame) -> DataFrame:
    """1 minus a tenth of the missing shares, not below 0."""
    return shares.agg(
        F.greatest(F.lit(0.0), 1.0 - MISSING_WEIGHT * F.sum("share")).alias("data_quality_score"),
        F.count_if(F.col("share") > 0).alias("columns_with_missing"),
    )


def mean_shift(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], threshold: float = MEAN_SHIFT
) -> DataFrame:
    """Means of both sides per column and whether they differ by over ``threshold`` of the reference."""

    def means(df: DataFrame, name: str) -> DataFrame:
        cells = [F.struct(F.lit(c).alias("field"), F.avg(c).alias(name)) for c in columns]
        return df.agg(F.array(*cells).alias("_c")).select(F.inline("_c"))

    both = means(reference, "reference_mean").join(means(current, "current_mean"), "field")
    gap = F.abs(F.col("reference_mean") - F.col("current_mean"))
    drifted = F.coalesce(gap > threshold * F.abs("reference_mean"), F.lit(False))
    return both.withColumn("drifted", drifted)


def drift_score(shift: DataFrame) -> DataFrame:
    return shift.agg(
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("drift_detected"),
        (F.count_if("drifted") * COLUMN_WEIGHT).alias("drift_score"),
    )


def _ks_tail(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample tail, with the usual small-sample factor; 100 terms of the series."""
    root = F.sqrt(n * m / (n + m))
    lam = (root + 0.12 + 0.11 / root) * d
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * lam * lam),
    )
    # The alternating series does not settle near 0, where the tail is 1.
    return F.when(lam < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * terms)))


def ks_test(reference: DataFrame, current: DataFrame, column: str, alpha: float = KS_ALPHA) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and p-value.

    Both samples are counted per distinct value, and the two running counts come from range blocks,
    so the sample is sorted across the cluster and never held in one task.
    """
    sides = reference.select(F.col(column).alias("v"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        current.select(F.col(column).alias("v"), F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    cells = (
        sides.filter(F.col("v").isNotNull())
        .groupBy("v")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    )
    steps = running_totals(cells, ["v"], ["a", "b"])
    totals = steps.agg(F.max("cum_a").alias("n"), F.max("cum_b").alias("m"))
    pair = totals.select(F.struct("n", "m").alias("p")).scalar()
    n, m = F.col("_t")["n"], F.col("_t")["m"]
    gap = F.abs(F.col("cum_a") / n - F.col("cum_b") / m)
    found = steps.withColumn("_t", pair).agg(
        F.max(gap).alias("statistic"),
        F.max(n).cast("long").alias("reference_rows"),
        F.max(m).cast("long").alias("current_rows"),
    )
    p_value = _ks_tail(F.col("statistic"), F.col("reference_rows"), F.col("current_rows"))
    return found.select(
        F.lit(column).alias("field"), "statistic", "reference_rows", "current_rows", p_value.alias("p_value")
    ).withColumn("drifted", F.col("p_value") < alpha)


def categorical_drift(
    reference: DataFrame, current: DataFrame, column: str, threshold: float = CRAMERS_V
) -> DataFrame:
    """Cramer's V between the side and a categorical column."""
    sides = reference.select(F.col(column).alias("v"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        current.select(F.col(column).alias("v"), F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    cells = sides.filter(F.col("v").isNotNull()).groupBy("v").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    sums = cells.agg(F.sum("a").alias("n"), F.sum("b").alias("m"))
    pair = sums.select(F.struct("n", "m").alias("p")).scalar()
    n, m = F.col("_t")["n"], F.col("_t")["m"]
    row = F.col("a") + F.col("b")
    ea, eb = row * n / (n + m), row * m / (n + m)
    chi = F.pow(F.col("a") - ea, 2) / F.nullif(ea, F.lit(0.0)) + F.pow(F.col("b") - eb, 2) / F.nullif(eb, F.lit(0.0))
    # Two sides, so the smaller table dimension minus one is 1 (given at least two values).
    return (
        cells.withColumn("_t", pair)
        .agg(F.sum(chi).alias("chi2"), F.sum(row).alias("rows"), F.count(F.lit(1)).alias("n_values"))
        .select(
            F.lit(column).alias("field"),
            "chi2",
            "n_values",
            F.when(F.col("n_values") > 1, F.sqrt(F.col("chi2") / F.col("rows"))).otherwise(0.0).alias("cramers_v"),
        )
        .withColumn("drifted", F.col("cramers_v") > threshold)
    )


def column_drift(
    reference: DataFrame, current: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (),
    alpha: float = KS_ALPHA, threshold: float = CRAMERS_V,
) -> DataFrame:
    """A row per column: Kolmogorov-Smirnov test of numeric ones, Cramer's V of categorical ones.

    Both sides become one long table of (column, value) counts, so each side is scanned once whatever the number
    of columns.  All numeric columns share one range-partitioned sort: running counts go on from column to column,
    and a column's own begin where the ones before it end.  NULL, NaN and infinite values count as missing; a
    column without a value on one side has a NULL statistic and did not drift.
    """

    def side(df: DataFrame, a: int, b: int) -> DataFrame:
        none_v, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
        cells = [(c, finite(F.col(c).cast("double")), none_s) for c in numeric]
        cells += [(c, none_v, F.col(c).cast("string")) for c in categorical]
        rows = F.array(*[F.struct(F.lit(c).alias("field"), v.alias("v"), s.alias("s")) for c, v, s in cells])
        return df.select(F.inline(rows)).where("v IS NOT NULL OR s IS NOT NULL").select(
            "*", F.lit(a).alias("a"), F.lit(b).alias("b"))

    counted = side(reference, 1, 0).unionByName(side(current, 0, 1)).groupBy("field", "v", "s")
    cells = materialize(counted.agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "cells")
    sums = cells.groupBy("field", F.col("v").isNotNull().alias("_number")).agg(F.sum("a").alias("n"), F.sum("b").alias("m"))
    # One row per column of the table.
    before = Window.partitionBy("_number").orderBy("field").rowsBetween(Window.unboundedPreceding, -1)
    totals = sums.select(
        "field", "_number", F.nullif("n", F.lit(0)).alias("n"), F.nullif("m", F.lit(0)).alias("m"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_a"), F.coalesce(F.sum("m").over(before), F.lit(0)).alias("_b"))
    steps = running_totals(cells.where("v IS NOT NULL").select("field", "v", "a", "b"), ["field", "v"], ["a", "b"])
    gap = F.abs((F.col("cum_a") - F.col("_a")) / F.col("n") - (F.col("cum_b") - F.col("_b")) / F.col("m"))
    numbers = steps.join(totals.where("_number"), "field").groupBy("field").agg(
        F.max(gap).alias("statistic"), F.max("n").alias("n"), F.max("m").alias("m")
    ).withColumn("p_value", _ks_tail(F.col("statistic"), F.col("n"), F.col("m")))
    row, n, m = F.col("a") + F.col("b"), F.col("n"), F.col("m")
    ea, eb = row * n / (n + m), row * m / (n + m)
    chi = F.pow(F.col("a") - ea, 2) / ea + F.pow(F.col("b") - eb, 2) / eb
    values = cells.where("s IS NOT NULL").join(totals.where("NOT _number"), "field").groupBy("field").agg(
        F.sqrt(F.sum(chi) / F.sum(row)).alias("statistic"), F.max("n").alias("n"), F.max("m").alias("m")
    ).withColumn("p_value", F.lit(None).cast("double"))
    kinds = [(c, "numeric") for c in numeric] + [(c, "categorical") for c in categorical]
    listed = reference.sparkSession.createDataFrame(kinds, "field string, kind string")
    drifted = F.when(F.col("kind") == "numeric", F.col("p_value") < alpha).otherwise(F.col("statistic") > threshold)
    return listed.join(numbers.unionByName(values), "field", "left").select(
        "field", "kind", "statistic", "p_value", F.coalesce("n", F.lit(0)).alias("reference_rows"),
        F.coalesce("m", F.lit(0)).alias("current_rows"), F.coalesce(drifted, F.lit(False)).alias("drifted"))


def dataset_drift(columns: DataFrame, share: float = DRIFT_SHARE) -> DataFrame:
    """Number and share of drifted columns, and whether the table as a whole drifted."""
    found = F.count_if("drifted") / F.nullif(F.count(F.lit(1)), F.lit(0))
    return columns.agg(
        F.count(F.lit(1)).alias("n_columns"), F.count_if("drifted").alias("n_drifted"), found.alias("drifted_share"),
        F.coalesce(found >= share, F.lit(False)).alias("dataset_drift"))
