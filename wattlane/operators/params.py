"""Small fitted parameters applied to every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def attach(df: DataFrame, params: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add the columns of ``params`` to every row of ``df``.

    Without keys ``params`` is one row and becomes a scalar subquery: no join and no shuffle.  With
    keys it is an equi-join whose strategy is left to the optimizer, because the number of series
    has no fixed bound; a skewed key is split by adaptive execution.
    """
    if keys:
        return df.join(params, list(keys), "left")
    row = params.select(F.struct(*params.columns).alias("_p")).scalar()
    return df.withColumn("_p", row).select(
        *df.columns, *[F.col("_p")[c].alias(c) for c in params.columns]
    )


def matched(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match: the columns of ``left``, then the other ones of ``right``."""
    renamed = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return left.join(renamed, condition, how).drop(*[f"_of_{k}" for k in keys])


def finite(column: Column) -> Column:
    """NULL in place of NaN and the infinities."""
    inf = float("inf")
    return F.when(~F.isnan(column) & (F.abs(column) != F.lit(inf)), column)
