"""Names of the columns that give a time-series table its order."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Panel:
    """A table of series: ``keys`` name the series, ``ts`` orders it, ``tie`` breaks equal times.

    ``keys`` may be empty (one long series).  ``pos`` is the 0-based row number inside a series
    once it has been assigned.
    """

    keys: tuple[str, ...] = ("series",)
    ts: str = "ts"
    tie: tuple[str, ...] = ()
    pos: str = "pos"

    @property
    def order(self) -> tuple[str, ...]:
        return (self.ts, *self.tie)

    def with_keys(self, *keys: str) -> "Panel":
        return replace(self, keys=tuple(keys))

    def key_cols(self) -> list[Column]:
        return [F.col(k) for k in self.keys]
