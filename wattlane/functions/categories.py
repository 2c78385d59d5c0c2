"""Binned weather categories and one-hot flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Right-closed bin edges and their labels.  The lowest edge is open: a value equal to
# it, like a value above the last edge, falls in no bin.
TEMPERATURE_BINS = (
    (None, 0, "freezing"), (0, 10, "cold"), (10, 20, "cool"), (20, 30, "warm"), (30, None, "hot"),
)
WIND_BINS = (
    (0, 5, "calm"), (5, 10, "light"), (10, 15, "moderate"), (15, 20, "strong"), (20, None, "storm"),
)
HUMIDITY_BINS = ((0, 30, "dry"), (30, 60, "comfortable"), (60, 80, "humid"), (80, 100, "very_humid"))


def binned(value: Column, bins: Sequence[tuple[float | None, float | None, str]]) -> Column:
    label = F.lit(None).cast("string")
    for low, high, name in reversed(bins):
        inside = F.lit(True)
        if low is not None:
            inside = inside & (value > low)
        if high is not None:
            inside = inside & (value <= high)
        label = F.when(value.isNotNull() & inside, name).otherwise(label)
    return label


def temperature_category(value: Column) -> Column:
    return binned(value, TEMPERATURE_BINS)


def wind_category(value: Column) -> Column:
    return binned(value, WIND_BINS)


def humidity_category(value: Column) -> Column:
    return binned(value, HUMIDITY_BINS)


def one_hot(column: str, values: Sequence[str], prefix: str = "weather") -> dict[str, Column]:
    """One flag per listed value; NULL gives false everywhere."""
    return {f"{prefix}_{v}": F.coalesce(F.col(column) == F.lit(v), F.lit(False)) for v in values}
