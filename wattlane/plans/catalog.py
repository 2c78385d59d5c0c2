"""Registry of the queries that are checked against SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFn
    covers: tuple[str, ...]
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(covers: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a function under its name; ``covers`` lists operator IDs of the survey."""

    def add(fn: QueryFn) -> QueryFn:
        if fn.__name__ in CATALOG:
            raise ValueError(f"query {fn.__name__} is registered twice")
        CATALOG[fn.__name__] = Query(fn.__name__, fn, tuple(covers.split()), sql)
        return fn

    return add


Digits = int | Mapping[str, int]


def _digits(digits: Digits, name: str) -> int:
    """Decimals of one column; a mapping gives exceptions and, under "", the rest.

    Means of short runs of two-decimal values are finite decimals, so a digit at which they could
    end in a 5 has to be avoided: the engines break such ties differently.
    """
    return digits if isinstance(digits, int) else digits.get(name, digits[""])


# Fold metrics of two-decimal values over 24 or 96 rows.
METRIC_DIGITS = {"": 5, "mse": 1, "mse_mean": 1, "mse_min": 1, "mse_max": 1, "mse_std": 1}


def rounded(c: Column, digits: int) -> Column:
    """``F.round`` of a double; decimal arithmetic only near a tie or for large values, as it costs most of a row.

    Elsewhere the scaled value has one nearest integer, and dividing that is exact to the last bit.
    """
    scaled = c * F.lit(10.0 ** digits)
    plain = (F.abs(scaled) < 1e11) & (F.abs(scaled - F.floor(scaled) - 0.5) > 0.001)
    return F.when(plain, F.rint(scaled) / F.lit(10.0 ** digits)).otherwise(F.round(c, digits))


def emit(df: DataFrame, *columns: str, digits: Digits = 6) -> DataFrame:
    """Bring a result to the types that are compared: rounded doubles, long integers, zone-free times."""
    out = []
    for name in columns or df.columns:
        kind = df.schema[name].dataType
        c = F.col(name)
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = rounded(c.cast("double"), _digits(digits, name)) + F.lit(0.0)
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(kind, (T.TimestampType, T.DateType)):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(name))
    return df.select(*out)


def oracle(sql: str, doubles: str = "", ints: str = "", times: str = "", digits: Digits = 6) -> str:
    """The same for the SQL side."""
    cells = [f"round(CAST({c} AS DOUBLE), {_digits(digits, c)}) + CAST(0 AS DOUBLE) AS {c}" for c in doubles.split()]
    cells += [f"CAST({c} AS BIGINT) AS {c}" for c in ints.split()]
    cells += [f"CAST({c} AS TIMESTAMP) AS {c}" for c in times.split()]
    return f"SELECT * REPLACE ({', '.join(cells)}) FROM (\n{sql.strip()}\n) AS result" if cells else sql.strip()
