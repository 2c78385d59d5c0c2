"""Exact quantiles in constant memory: radix selection on the bits of doubles.

A double becomes a long that keeps its order.  Four passes of 16 bits each find the wanted ranks: a pass counts, for
every group, column and prefix that still holds a wanted rank, how often each of the next 65,536 digits occurs; the
running totals say which digit holds the rank.  All groups, columns and ranks go through the same four scans of the
keys, which are written once, so the plan before them runs once.  A scan keeps counters only, whatever the number of rows, distinct values or equal values, and nothing depends on table size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattlane.operators.params import attach, matched
from wattlane.session import materialize

_DIGIT = 16
_PASSES = 64 // _DIGIT
# Of the binary format of doubles: bits of the fraction, bias of the exponent, exponent of infinity, least normal.
_FRACTION, _BIAS, _TOP = 52, 1023, 2047
_LEAST = 2.0**-1022


def quantile_name(column: str, q: float) -> str:
    return f"{column}_q{q:g}".replace(".", "_")


def sort_keys(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``_k0``, ``_k1``, ...: longs in the order of the columns' values as doubles (NaN last), NULL for NULL.

    Powers of two are exact, so all of this is: scaling a double by one changes its exponent only.  The logarithm
    may miss the exponent by one next to a power of two, which the fraction shows.
    """
    numbers = range(len(columns))
    values = df.select(*keep, *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(columns)])
    sizes = values.select(*values.columns, *[
        F.floor(F.greatest(F.least(F.log2(F.abs(f"_v{i}")), F.lit(float(_BIAS))), F.lit(1.0 - _BIAS))).alias(f"_e{i}")
        for i in numbers])
    scaled = sizes.select(*sizes.columns, *[
        (F.abs(f"_v{i}") / F.pow(F.lit(2.0), F.col(f"_e{i}"))).alias(f"_m{i}") for i in numbers])
    unit = F.lit(2.0**_FRACTION)

    def key(i: int) -> Column:
        v, e, m = F.col(f"_v{i}"), F.col(f"_e{i}"), F.col(f"_m{i}")
        beyond = F.when(m < 1, 2 * m - 2).when(m >= 2, m / 2).otherwise(m - 1)
        size = (
            F.when(F.isnan(v), F.lit((_TOP << _FRACTION) + 1))
            .when(F.abs(v) == F.lit(float("inf")), F.lit(_TOP << _FRACTION))
            .when(F.abs(v) < _LEAST, (F.abs(v) * F.lit(2.0**537) * F.lit(2.0**537)).cast("long"))
            .otherwise((e + _BIAS) * F.lit(1 << _FRACTION) + (beyond * unit).cast("long"))
        )
        return F.when(v.isNotNull(), F.when(v < 0, -size).otherwise(size)).alias(f"_k{i}")

    return scaled.select(*keep, *[key(i) for i in numbers])


def key_value(key: Column) -> Column:
    """The double of a key."""
    size = F.abs(key)
    exponent, fraction = F.shiftright(size, _FRACTION), size.bitwiseAND(F.lit((1 << _FRACTION) - 1)).cast("double")
    value = (
        F.when(exponent == 0, fraction * F.lit(2.0**-537) * F.lit(2.0**-537))
        .when(exponent == _TOP, F.when(fraction == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan"))))
        .otherwise((1 + fraction / F.lit(2.0**_FRACTION)) * F.pow(F.lit(2.0), exponent - _BIAS))
    )
    return F.when(key < 0, -value).otherwise(value)


def _advance(state: DataFrame, cells: DataFrame, by: Sequence[str], step: int) -> DataFrame:
    """Move every wanted rank into the digit that holds it."""
    keys = [*by, "_col", "_prefix"] if step else [*by, "_col"]
    earlier = Window.partitionBy(*keys).orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
    ranged = cells.select(*keys, "_digit", "_count", F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_before"))
    held = matched(state, ranged, keys).where(
        (F.col("_rest") >= F.col("_before")) & (F.col("_rest") < F.col("_before") + F.col("_count")))
    prefix = F.shiftleft("_prefix", _DIGIT).bitwiseOR(F.col("_digit")) if step else F.col("_digit")
    return materialize(held.select(
        *by, "_col", "_slot", "_size", prefix.alias("_prefix"), (F.col("_rest") - F.col("_before")).alias("_rest")), "radix")


def _count(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    flat = cells.select(*by, F.explode("_cells").alias("_cell")).select(*by, "_cell.*")
    return flat.groupBy(*by, "_col", "_prefix", "_digit").agg(F.count(F.lit(1)).alias("_count"))


# Expressions of every column and rank are written as SQL text: one call each instead of dozens.


def _cell(i: int, prefix: str, digit: str, condition: str) -> str:
    cell = f"named_struct('_col', {i}, '_prefix', CAST({prefix} AS BIGINT), '_digit', CAST({digit} AS BIGINT))"
    return f"CASE WHEN {condition} THEN {cell} END"


def _cells(cells: Sequence[str]) -> Column:
    return F.expr(f"array_compact(array({', '.join(cells)}))").alias("_cells")


def _by_column(state: DataFrame, by: Sequence[str], columns: int, slots: int, value: str, name: str) -> DataFrame:
    """One row per group: ``value`` of every column and rank as ``<name><column>_<slot>``, and the columns' sizes."""
    held = [f"max(CASE WHEN _col = {i} AND _slot = {s} THEN {value} END) AS {name}{i}_{s}"
            for i in range(columns) for s in range(slots)]
    sizes = [f"max(CASE WHEN _col = {i} THEN _size END) AS _size{i}" for i in range(columns)]
    return state.groupBy(*by).agg(*[F.expr(e) for e in held + sizes])


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolated quantiles, one row per group, columns ``<column>_q<prob>``.

    NULL values don't count; a group (NULL is one, too) or table without any value has NULL.  NaN is above infinity.
    """
    by, columns, slots = list(by), list(columns), 2 * len(probs)
    numbers = range(len(columns))
    keyed = materialize(sort_keys(df, columns, by), "radix-keys")

    # The first pass also lists the groups (column -1) and counts the values, which says the ranks.
    top = [_cell(i, "0", f"shiftright(_k{i}, {64 - _DIGIT})", f"_k{i} IS NOT NULL") for i in numbers]
    cells = materialize(_count(keyed.select(*by, _cells([_cell(-1, "0", "0", "true"), *top])), by), "radix-cells")
    sizes = cells.where("_col >= 0").groupBy(*by, "_col").agg(F.sum("_count").alias("_size"))
    ends = [(F.col("_size") - 1) * F.lit(float(q)) for q in probs]
    ranks = F.array(*[F.struct(F.lit(2 * j + k).alias("_slot"), edge(p).cast("long").alias("_rest"))
                      for j, p in enumerate(ends) for k, edge in enumerate((F.floor, F.ceil))])
    wanted = sizes.select("*", F.inline(ranks)).withColumn("_prefix", F.lit(0).cast("long"))
    state = _advance(wanted, cells.where("_col >= 0"), by, 0)
    for step in range(1, _PASSES):
        active = _by_column(state, by, len(columns), slots, "_prefix", "_p")
        # Without groups the prefixes are one row, a scalar; with groups they meet their rows in a join.
        rows = matched(keyed, active, by, "left") if by else attach(keyed, active)
        shift = 64 - _DIGIT * step
        next_digits = []
        for i in numbers:
            prefix, wanted = f"shiftright(_k{i}, {shift})", ", ".join(f"_p{i}_{s}" for s in range(slots))
            digit = f"shiftright(_k{i}, {shift - _DIGIT}) & {(1 << _DIGIT) - 1}"
            next_digits.append(_cell(i, prefix, digit, f"{prefix} IN ({wanted})"))
        state = _advance(state, _count(rows.select(*by, _cells(next_digits)), by), by, step)
    values = state.select("*", key_value(F.col("_prefix")).alias("_value"))
    found = _by_column(values, by, len(columns), slots, "_value", "_f")
    if by:
        found = matched(cells.where("_col = -1").select(*by), found, by, "left")
    out = []
    for i in numbers:
        for j, q in enumerate(probs):
            rank, low, high = f"((_size{i} - 1) * {float(q)!r}D)", f"_f{i}_{2 * j}", f"_f{i}_{2 * j + 1}"
            mixed = f"(ceil({rank}) - {rank}) * {low} + ({rank} - floor({rank})) * {high}"
            out.append(F.expr(f"CASE WHEN {low} = {high} THEN {low} ELSE {mixed} END").alias(quantile_name(columns[i], q)))
    return found.select(*by, *out)


def iqr_bounds(df: DataFrame, column: str, factor: float = 1.5, by: Sequence[str] = ()) -> DataFrame:
    """Lower and upper outlier bounds, one row per group."""
    q = quantiles(df, [column], [0.25, 0.75], by)
    q1, q3 = F.col(quantile_name(column, 0.25)), F.col(quantile_name(column, 0.75))
    return q.select(
        *by,
        (q1 - factor * (q3 - q1)).alias("_lower"),
        (q3 + factor * (q3 - q1)).alias("_upper"),
    )


def most_frequent(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent value, the smallest on ties: counted per value, so no buffer grows."""
    cells = df.filter(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
    return cells.groupBy(*by).agg(F.min_by(F.col(column), F.struct(-F.col("_n"), F.col(column))).alias(column))
