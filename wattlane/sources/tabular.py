"""CSV with row validation, and SQL sources."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wattlane.functions.time import parse_time
from wattlane.sources import schemas


@dataclass(frozen=True)
class Validated:
    """Result of a validated load: every valid row, typed, and every other row as it was read."""

    good: DataFrame
    rejected: DataFrame


def clean_name(name: str) -> str:
    return re.sub(r"[^\w]", "_", name.replace(" ", "_").lower())


def scan_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All fields as text, with cleaned names.  Tries ``sep``, ``;`` and tab and takes the first that
    gives more than one column; only the header line is read to decide."""
    table = None
    for candidate in (sep, ";", "\t"):
        table = spark.read.csv(path, header=True, sep=candidate, inferSchema=False)
        if len(table.columns) > 1:
            break
    names = [clean_name(c) for c in table.columns]
    table = table.toDF(*names)
    if len(names) < 2:
        if table.isEmpty():
            raise ValueError(f"no data in {path}")
        raise ValueError(f"{path} has fewer than two columns")
    return table


def known(raw: Column) -> Column:
    """The text, or NULL where it stands for a missing value."""
    return F.when(~raw.isin(*schemas.MISSING), raw)


def _coerced(raw: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.IntegerType):
        number = raw.try_cast("double")
        return F.when(number == F.floor(number), number.try_cast("int"))
    if isinstance(kind, T.DoubleType):
        return raw.try_cast("double")
    return raw


def typed(raw: DataFrame, schema: T.StructType) -> list[Column]:
    """Declared columns in declared order: undeclared ones are dropped, missing ones are NULL."""
    return [
        (_coerced(F.col(f.name), f.dataType) if f.name in raw.columns else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in schema.fields
    ]


def row_is_valid(raw: DataFrame, schema: T.StructType) -> Column:
    """Every field is missing or has its type; required fields are present and not empty.  Text fits any text."""
    ok = F.lit(True)
    for f in schema.fields:
        if f.name not in raw.columns:
            if not f.nullable:
                ok = F.lit(False)
            continue
        value = F.col(f.name)
        if not isinstance(f.dataType, T.StringType):
            ok = ok & (value.isNull() | _coerced(value, f.dataType).isNotNull())
        if not f.nullable:
            ok = ok & F.coalesce(F.length(value) >= 1, F.lit(False))
    return ok


def validate_rows(raw: DataFrame, schema: T.StructType, max_bad_share: float | None = None) -> Validated:
    """Split rows into valid and rejected ones; none is left out, wherever it stands.

    With ``max_bad_share`` the rows are counted, and a larger share of bad ones raises ``ValueError``.  A table
    without rows gives two empty tables.
    """
    cleaned = raw.select(*[known(F.col(c)).alias(c) for c in raw.columns])
    judged = cleaned.withColumn("_ok", F.coalesce(row_is_valid(cleaned, schema), F.lit(False)))
    if max_bad_share is not None:
        rows, bad = judged.agg(F.count(F.lit(1)), F.count_if(~F.col("_ok"))).first()
        if bad > max_bad_share * rows:
            raise ValueError(f"{bad} of {rows} rows are bad, more than a share of {max_bad_share}")
    return Validated(judged.filter("_ok").select(*typed(cleaned, schema)), judged.filter(~F.col("_ok")).drop("_ok"))


def load_csv(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", max_bad_share: float | None = None
) -> Validated:
    """Validated CSV load."""
    return validate_rows(scan_csv(spark, path, sep), schema, max_bad_share)


def load_energy(spark: SparkSession, path: str) -> DataFrame:
    return load_csv(spark, path, schemas.ENERGY).good


def load_weather(spark: SparkSession, path: str) -> DataFrame:
    return load_csv(spark, path, schemas.WEATHER).good


def load_with_time(spark: SparkSession, path: str, time_column: str = "time") -> DataFrame:
    """CSV with one parsed time column; other fields stay text."""
    table = spark.read.csv(path, header=True)
    return table.withColumn(time_column, parse_time(F.col(time_column)))


def load_predictions(spark: SparkSession, path: str) -> DataFrame:
    table = spark.read.csv(path, header=True)
    return table.withColumn("prediction", F.col("prediction").try_cast("double"))


def reference_sample(df: DataFrame, ts: str, target: str, start: str, end: str) -> DataFrame:
    """Rows of a time range, ``end`` left out, with a target: a monitoring reference.  It may be empty."""
    inside = (F.col(ts) >= F.to_timestamp(F.lit(start))) & (F.col(ts) < F.to_timestamp(F.lit(end)))
    return df.filter(inside & F.col(target).isNotNull())


def load_query(
    spark: SparkSession, query: str, url: str | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Result of a SQL query: on catalog tables, or pushed down to a database over JDBC.

    For a big result pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``
    (with ``dbtable`` in place of the query), or it is read by a single task.
    """
    if url is None:
        return spark.sql(query)
    reader = spark.read.format("jdbc").option("url", url)
    opts = dict(options or {})
    if "dbtable" not in opts:
        reader = reader.option("query", query)
    return reader.options(**opts).load()
