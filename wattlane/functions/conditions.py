"""Rule predicates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: two metric values this close count as equal.
TOLERANCE = 1e-6


def holds(value: Column, operator: Column, threshold: Column) -> Column:
    """Whether ``value <operator> threshold``; NULL values and unknown operators never hold."""
    gap = F.abs(value - threshold)
    outcome = (
        F.when(operator == ">", value > threshold)
        .when(operator == "<", value < threshold)
        .when(operator == ">=", value >= threshold)
        .when(operator == "<=", value <= threshold)
        .when(operator == "==", gap < TOLERANCE)
        .when(operator == "!=", gap >= TOLERANCE)
    )
    return F.coalesce(outcome, F.lit(False))
