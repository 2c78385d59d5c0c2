"""Contract checks, imputation, outliers and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wattlane.operators.chunks import fill_both_ways
from wattlane.operators.params import attach, matched
from wattlane.operators.quantiles import iqr_bounds, most_frequent, quantile_name, quantiles
from wattlane.panel import Panel
from wattlane.session import materialize


@dataclass(frozen=True)
class Roles:
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    time: tuple[str, ...]
    target: str | None


def column_roles(df: DataFrame, target: str | None = None) -> Roles:
    """Column roles from the schema; the target is listed on its own."""
    numeric, categorical, time = [], [], []
    for field in df.schema.fields:
        if field.name == target:
            continue
        if isinstance(field.dataType, T.NumericType):
            numeric.append(field.name)
        elif isinstance(field.dataType, T.StringType):
            categorical.append(field.name)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            time.append(field.name)
    return Roles(tuple(numeric), tuple(categorical), tuple(time), target)


class ContractError(ValueError):
    """The table does not have the declared columns and types."""


def check_contract(df: DataFrame, expected: Mapping[str, str], allow_empty: bool = False) -> DataFrame:
    """Raise unless every expected column exists with its type; returns ``df`` for chaining."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for name, kind in expected.items():
        if name not in actual:
            raise ContractError(f"missing column: {name}")
        if actual[name] != kind:
            raise ContractError(f"column {name} is {actual[name]}, expected {kind}")
    if not allow_empty and df.limit(1).isEmpty():
        raise ContractError("table is empty")
    return df


def contract_report(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """One row per expected column: whether it is there, has its type, and how many NULLs it holds."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    entries = [
        F.struct(
            F.lit(name).alias("field"),
            F.lit(name in actual).alias("present"),
            F.lit(actual.get(name) == kind).alias("type_ok"),
            (F.count_if(F.col(name).isNull()) if name in actual else F.lit(None).cast("long")).alias("nulls"),
            F.count(F.lit(1)).alias("rows"),
        )
        for name, kind in expected.items()
    ]
    return df.agg(F.array(*entries).alias("_e")).select(F.inline("_e"))


STRATEGIES = ("mean", "median", "most_frequent", "constant")


def impute(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    strategy: str = "mean",
    fit_on: DataFrame | None = None,
    panel: Panel | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Replace NULLs by a statistic of the column.

    An unknown strategy means ``mean``; a column without any value stays as it is.
    ``ffill_bfill`` (needs ``panel``) fills along each series, then falls back to the mean and 0.
    ``fit_on`` limits the statistics to, say, training rows; ``by`` (say, ``panel.keys``) takes them per group, where
    NULL is a group, too, and a group that ``fit_on`` doesn't have stays as it is.
    """
    by = list(by)
    names = list(columns) if columns is not None else [c for c in column_roles(df).numeric if c not in by]
    if columns is None and panel is not None:
        names = [c for c in names if c not in (panel.pos, *panel.keys)]
    if not names:
        return df
    source = fit_on if fit_on is not None else df
    if strategy == "ffill_bfill":
        if panel is None:
            raise ValueError("ffill_bfill needs a panel")
        filled = fill_both_ways(df, panel, names)
        rest = source.groupBy(*by).agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"_fill_{c}") for c in names])
        return _fill(filled, rest, names, by)
    if strategy not in STRATEGIES:
        strategy = "mean"
    if strategy == "mean":
        stats = source.groupBy(*by).agg(*[F.avg(c).alias(f"_fill_{c}") for c in names])
    elif strategy == "median":
        q = quantiles(source, names, [0.5], by)
        stats = q.select(*by, *[F.col(quantile_name(c, 0.5)).alias(f"_fill_{c}") for c in names])
    elif strategy == "most_frequent":
        parts = [most_frequent(source, c, by).withColumnRenamed(c, f"_fill_{c}") for c in names]
        stats = source.select(*by).distinct() if by else parts.pop(0)
        for part in parts:
            stats = matched(stats, part, by, "left") if by else attach(stats, part)
    else:
        stats = source.groupBy(*by).agg(*[F.when(F.count(c) > 0, F.lit(0.0)).alias(f"_fill_{c}") for c in names])
    return _fill(df, stats, names, by)


def _fill(df: DataFrame, stats: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    known = matched(df, stats, by, "left") if by else attach(df, stats)
    return known.select(*[F.coalesce(c, f"_fill_{c}").alias(c) if c in names else F.col(c) for c in df.columns])


def _outside(column: str) -> Column:
    value = F.col(column)
    # NULL is not an outlier.
    return F.coalesce((value < F.col("_lower")) | (value > F.col("_upper")), F.lit(False))


def flag_outliers(df: DataFrame, column: str, factor: float = 1.5, by: Sequence[str] = ()) -> DataFrame:
    """Add ``is_outlier``: outside the quartiles (of its ``by`` group) by more than ``factor`` interquartile ranges."""
    bounds = iqr_bounds(df, column, factor, by)
    known = matched(df, bounds, by, "left") if by else attach(df, bounds)
    return known.select(*df.columns, _outside(column).alias("is_outlier"))


def drop_outliers(
    df: DataFrame, columns: Sequence[str], method: str = "iqr", factor: float = 1.5,
    by: Sequence[str] = (),
) -> DataFrame:
    """Drop outliers column after column: the bounds of each come from the rows still there.

    ``iqr``: outside the quartiles by more than ``factor`` interquartile ranges; ``zscore``: further than ``factor``
    standard deviations from the mean.  The two bounds of a column are fixed before the next one is looked at,
    so each column costs its own scan and not those of all columns before it.  NULL is not an outlier.  With ``by``
    the bounds are those of the row's group and meet it in a join.
    """
    if method not in ("iqr", "zscore"):
        raise ValueError(f"unknown outlier method: {method}")
    out = df
    for column in columns:
        if method == "iqr":
            limits = iqr_bounds(out, column, factor, by)
        else:
            mean, spread = F.avg(column), F.coalesce(F.stddev(column), F.lit(0.0))
            limits = out.groupBy(*by).agg((mean - factor * spread).alias("_lower"), (mean + factor * spread).alias("_upper"))
        if by:
            fixed = materialize(limits, "bounds")
            out = matched(out, fixed, by, "left").filter(~_outside(column)).select(*df.columns)
            continue
        bounds = limits.first()
        if bounds is None or bounds["_lower"] is None:
            continue
        value = F.col(column)
        outside = (value < F.lit(bounds["_lower"])) | (value > F.lit(bounds["_upper"]))
        out = out.filter(~F.coalesce(outside, F.lit(False)))
    return out


def outlier_report(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    flagged = flag_outliers(df, column, factor)
    return flagged.agg(
        F.count_if("is_outlier").alias("outliers"),
        (F.count_if("is_outlier") * 100.0 / F.count(F.lit(1))).alias("outlier_pct"),
    )


def fit_scaler(
    df: DataFrame, columns: Sequence[str], method: str = "standard", by: Sequence[str] = ()
) -> DataFrame:
    """Scaling parameters: ``<c>_a`` is subtracted, ``<c>_b`` divides (1 when there is no spread)."""
    exprs = []
    for c in columns:
        if method == "standard":
            shift, spread = F.avg(c), F.stddev_pop(c)
        elif method == "minmax":
            shift, spread = F.min(c), F.max(c) - F.min(c)
        else:
            raise ValueError(f"unknown normalization method: {method}")
        spread = F.when(spread == 0, F.lit(1.0)).otherwise(spread)
        exprs += [shift.cast("double").alias(f"{c}_a"), spread.cast("double").alias(f"{c}_b")]
    return df.groupBy(*by).agg(*exprs)


def _rescale(df: DataFrame, params: DataFrame, columns: Sequence[str], by: Sequence[str], back: bool) -> DataFrame:
    def expr(c: str) -> Column:
        a, b = F.col(f"{c}_a"), F.col(f"{c}_b")
        return (F.col(c) * b + a if back else (F.col(c) - a) / b).alias(c)

    return attach(df, params, by).select(*[expr(c) if c in columns else F.col(c) for c in df.columns])


def scale(df: DataFrame, params: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return _rescale(df, params, columns, by, back=False)


def unscale(df: DataFrame, params: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return _rescale(df, params, columns, by, back=True)


def normalize(df: DataFrame, columns: Sequence[str], method: str = "standard") -> tuple[DataFrame, DataFrame]:
    """Scaled table and its parameters."""
    params = fit_scaler(df, columns, method)
    return scale(df, params, columns), params


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast to double; text that is no number becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def drop_target_columns(columns: Sequence[str]) -> list[str]:
    """Feature names without the columns that look into the future."""
    return [c for c in columns if "_target_" not in c]
