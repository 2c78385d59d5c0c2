"""Energy-domain expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Generation columns counted as renewable and as fossil.
RENEWABLE = (
    "generation_solar",
    "generation_wind_onshore",
    "generation_hydro_run_of_river_and_poundage",
    "generation_hydro_water_reservoir",
    "generation_other_renewable",
)
FOSSIL = (
    "generation_fossil_coal_derived_gas",
    "generation_fossil_gas",
    "generation_fossil_hard_coal",
    "generation_fossil_oil",
    "generation_fossil_brown_coal_lignite",
)


def row_sum(columns: Iterable[str]) -> Column:
    """Sum that skips NULLs; all NULL gives 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in columns])


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Quotient with NULL for a zero denominator."""
    return top / F.nullif(bottom, F.lit(0.0))


def load_columns(present: Sequence[str]) -> dict[str, Column]:
    if not {"total_load_actual", "total_load_forecast"} <= set(present):
        return {}
    actual, forecast = F.col("total_load_actual"), F.col("total_load_forecast")
    return {"load_factor": safe_ratio(actual, forecast), "load_error": actual - forecast}


def mix_columns(present: Sequence[str]) -> dict[str, Column]:
    """Renewable and fossil totals, and the renewable share when both exist."""
    green = [c for c in RENEWABLE if c in present]
    brown = [c for c in FOSSIL if c in present]
    out: dict[str, Column] = {}
    if green:
        out["total_renewable"] = row_sum(green)
    if brown:
        out["total_fossil"] = row_sum(brown)
    if green and brown:
        out["renewable_ratio"] = safe_ratio(row_sum(green), row_sum(green) + row_sum(brown))
    return out


def interaction_columns(present: Sequence[str]) -> dict[str, Column]:
    """Products of weather with time, generation and load, for the columns at hand."""
    pairs = {
        "temp_hour_interaction": ("temp", "hour_sin"),
        "wind_generation_interaction": ("wind_speed", "generation_wind_onshore"),
        "load_temp_interaction": ("total_load_actual", "temp"),
    }
    return {
        name: F.col(a) * F.col(b) for name, (a, b) in pairs.items() if a in present and b in present
    }
