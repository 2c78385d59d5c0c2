"""Parsing and calendar parts of a timestamp column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_time(raw: Column, fmt: str | None = None, strict: bool = False) -> Column:
    """Parse to a UTC instant; offsets in the text are honoured.

    Unparsable text gives NULL, or an error when ``strict``.
    """
    if strict:
        return F.to_timestamp(raw, fmt) if fmt else F.to_timestamp(raw)
    return F.try_to_timestamp(raw, F.lit(fmt)) if fmt else F.try_to_timestamp(raw)


def without_zone(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def calendar_parts(ts: Column) -> dict[str, Column]:
    """hour, weekday (Monday = 0), month, quarter, day of year and ISO week."""
    return {
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "month": F.month(ts),
        "quarter": F.quarter(ts),
        "day_of_year": F.dayofyear(ts),
        "week_of_year": F.weekofyear(ts),
    }


def cycle(part: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of ``part`` on a circle of ``period`` steps."""
    angle = F.lit(2) * F.pi() * part / F.lit(period)
    return F.sin(angle), F.cos(angle)


def cyclic_parts(parts: dict[str, Column], periods: dict[str, tuple[str, int]]) -> dict[str, Column]:
    """``periods`` maps an output prefix to (part name, period)."""
    out: dict[str, Column] = {}
    for prefix, (part, period) in periods.items():
        out[f"{prefix}_sin"], out[f"{prefix}_cos"] = cycle(parts[part], period)
    return out


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def is_business_hours(ts: Column) -> Column:
    """Nine to five inclusive, Monday to Friday."""
    return (F.hour(ts).between(9, 17) & (F.weekday(ts) < 5)).cast("int")


def seasonal_columns(ts: Column) -> dict[str, Column]:
    """Calendar set of the full feature pipeline."""
    parts = calendar_parts(ts)
    cyclic = cyclic_parts(
        parts, {"hour": ("hour", 24), "month": ("month", 12), "day_of_week": ("day_of_week", 7)}
    )
    return {
        **parts, **cyclic, "is_weekend": is_weekend(ts), "is_business_hours": is_business_hours(ts)
    }


def boosted_time_columns(ts: Column) -> dict[str, Column]:
    """Calendar set of the boosted-tree features."""
    parts = calendar_parts(ts)
    kept = {name: parts[name] for name in ("hour", "day_of_week", "month", "quarter")}
    cyclic = cyclic_parts(
        parts, {"hour": ("hour", 24), "dow": ("day_of_week", 7), "month": ("month", 12)}
    )
    return {**kept, "day_of_month": F.dayofmonth(ts), "is_weekend": is_weekend(ts), **cyclic}
