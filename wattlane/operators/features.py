"""Feature columns: lags, rolling statistics, calendar, weather, energy and targets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wattlane.functions import categories, energy, time as tm
from wattlane.operators.chunks import DEFAULT_CHUNK, WindowExpr, lag_of, lead_of, over_chunks, rolling_of, spread_chunks
from wattlane.operators.ordering import reposition
from wattlane.operators.rolling import add_statistics
from wattlane.panel import Panel

# Default feature parameters, in rows (hours).
LAGS = (1, 2, 6, 12, 24, 48, 72)
WINDOWS = (6, 12, 24, 48)
HORIZONS = (1, 6, 12, 24)
BOOSTED_LAGS = (1, 2, 3, 6, 12, 24, 48, 168)
BOOSTED_WINDOWS = (3, 6, 12, 24, 48)
ROLLING = ("mean", "std", "min", "max")
# Columns that get lags and rolling statistics besides the target.
COMPANIONS = ("generation_solar", "generation_wind_onshore", "temp", "wind_speed")

# Keys whose equality Arrow and Spark see alike.
_PLAIN = (T.StringType, T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.DecimalType)


def add_lags(
    df: DataFrame, panel: Panel, columns: Sequence[str], lags: Sequence[int], suffix: str = "",
    chunk_rows: int = DEFAULT_CHUNK,
) -> DataFrame:
    """``<c>_lag_<k><suffix>`` for the columns that exist; every row is kept."""
    present = [c for c in columns if c in df.columns]
    if not present or not lags:
        return df
    new = {f"{c}_lag_{k}{suffix}": lag_of(c, k) for c in present for k in lags}
    return over_chunks(df, panel, new, lookback=max(lags), chunk_rows=chunk_rows)


def skip_warm_up(df: DataFrame, panel: Panel, rows: int) -> DataFrame:
    """Drop the first ``rows`` rows of each series and start counting from 0 again."""
    return df.filter(F.col(panel.pos) >= rows).withColumn(panel.pos, F.col(panel.pos) - rows)


def add_lags_and_trim(df: DataFrame, panel: Panel, columns: Sequence[str], lags: Sequence[int]) -> DataFrame:
    """Lags named ``<c>_lag_<k>h``, then the warm-up rows are dropped."""
    if not any(c in df.columns for c in columns):
        return df
    return skip_warm_up(add_lags(df, panel, columns, lags, "h"), panel, max(lags)) if lags else df


def add_time_lags(df: DataFrame, panel: Panel, columns: Sequence[str], hours: Sequence[int]) -> DataFrame:
    """Lags by the clock instead of by rows: the value ``k`` hours earlier, NULL if there is none."""
    out = df
    for k in hours:
        past = df.select(
            *panel.keys,
            (F.col(panel.ts) + F.expr(f"INTERVAL {int(k)} HOUR")).alias(panel.ts),
            *[F.col(c).alias(f"{c}_lag_{k}h") for c in columns],
        )
        out = out.join(past, [*panel.keys, panel.ts], "left")
    return out


def rolling_columns(columns: Sequence[str], windows: Sequence[int], functions: Sequence[str]) -> dict[str, WindowExpr]:
    return {f"{c}_rolling_{n}h_{f}": rolling_of(c, n, f) for c in columns for n in windows for f in functions}


def add_rolling(
    df: DataFrame, panel: Panel, columns: Sequence[str], windows: Sequence[int],
    functions: Sequence[str] = ROLLING,
) -> DataFrame:
    """``<c>_rolling_<n>h_<f>``, NULL until the frame holds n known rows; every row is kept.

    Double columns take the array form, which costs a fraction of the windows and has the same figures.
    """
    new = rolling_columns(columns, windows, functions)
    back = max(windows) - 1
    kinds = [df.schema[c].dataType for c in columns]
    keys = [df.schema[k].dataType for k in panel.keys]
    if not new or not all(isinstance(k, T.DoubleType) for k in kinds) or not all(isinstance(k, _PLAIN) for k in keys):
        return over_chunks(df, panel, new, lookback=back)
    kept = [c for c in df.columns if c not in new]
    wanted = [(f"{c}_rolling_{n}h_{f}", c, n, f) for c in columns for n in windows for f in functions]
    group = [*panel.keys, "_chunk"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return add_statistics(batches, group, wanted, kept, "_home", "_chunk")

    schema = T.StructType([*[df.schema[c] for c in kept], *[T.StructField(n, T.DoubleType()) for n in new]])
    ordered = spread_chunks(df, panel, lookback=back).sortWithinPartitions(*group, panel.pos)
    return ordered.mapInArrow(run, schema)


def add_seasonal(df: DataFrame, panel: Panel) -> DataFrame:
    return df.withColumns(tm.seasonal_columns(F.col(panel.ts)))


def weather_values(df: DataFrame, column: str = "weather_main") -> list[str]:
    """Categories for one-hot flags, found in one pass over the column."""
    found = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(1001).collect()
    if len(found) > 1000:
        raise ValueError(f"{column} has over 1000 categories; pass the list of values to encode")
    return sorted(r[0] for r in found)


def weather_columns(df: DataFrame, conditions: Sequence[str] | None = None) -> dict[str, Column]:
    """Categories and condition flags for the weather columns at hand."""
    new = {}
    if "temp" in df.columns:
        new["temp_category"] = categories.temperature_category(F.col("temp"))
    if "wind_speed" in df.columns:
        new["wind_category"] = categories.wind_category(F.col("wind_speed"))
    if "humidity" in df.columns:
        new["humidity_category"] = categories.humidity_category(F.col("humidity"))
    if "weather_main" in df.columns:
        values = weather_values(df) if conditions is None else conditions
        new |= categories.one_hot("weather_main", values)
    return new


def add_weather(df: DataFrame, panel: Panel, conditions: Sequence[str] | None = None) -> DataFrame:
    """Weather columns and the temperature change since the previous row."""
    new = weather_columns(df, conditions)
    out = df.withColumns(new) if new else df
    if "temp" in df.columns:
        change = {"temp_change": lambda w: F.col("temp") - F.lag("temp", 1).over(w)}
        out = over_chunks(out, panel, change, lookback=1)
    return out


def add_energy(df: DataFrame, panel: Panel) -> DataFrame:
    """Load factor, generation mix and price volatility for the energy columns at hand."""
    new = {**energy.load_columns(df.columns), **energy.mix_columns(df.columns)}
    out = df.withColumns(new) if new else df
    if "price_actual" in df.columns:
        volatility = {"price_volatility": rolling_of("price_actual", 24, "std")}
        out = over_chunks(out, panel, volatility, lookback=23)
    return out


def add_interactions(df: DataFrame) -> DataFrame:
    new = energy.interaction_columns(df.columns)
    return df.withColumns(new) if new else df


def add_targets(df: DataFrame, panel: Panel, target: str, horizons: Sequence[int]) -> DataFrame:
    new = {f"{target}_target_{h}h": lead_of(target, h) for h in horizons}
    return over_chunks(df, panel, new, lookahead=max(horizons))


def full_features(
    df: DataFrame,
    panel: Panel,
    target: str = "total_load_actual",
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    horizons: Sequence[int] = HORIZONS,
    conditions: Sequence[str] | None = None,
) -> DataFrame:
    """Complete feature frame.

    The warm-up of the lags is dropped before rolling statistics, temperature change and price
    volatility are taken, so those warm up again from the first row that is left.  Hiding the
    warm-up rows from their frames gives the same values as dropping the rows first, and lets all
    windows share one shuffle and one sort.
    """
    keys = [c for c in (target, *COMPANIONS) if c in df.columns]
    warm = max(lags, default=0)

    def left(column: str) -> Column:
        return F.when(F.col(panel.pos) >= warm, F.col(column))

    windowed = {f"{c}_lag_{k}h": lag_of(c, k) for c in keys for k in lags}
    for c in keys:
        for n in windows:
            for f in ROLLING:
                windowed[f"{c}_rolling_{n}h_{f}"] = rolling_of(left(c), n, f)
    reach = max([warm, 1, *[n - 1 for n in windows]])
    if "temp" in df.columns:
        windowed["temp_change"] = lambda w: F.col("temp") - F.lag(left("temp"), 1).over(w)
    if "price_actual" in df.columns:
        windowed["price_volatility"] = rolling_of(left("price_actual"), 24, "std")
        reach = max(reach, 23)
    windowed |= {f"{target}_target_{h}h": lead_of(target, h) for h in horizons}
    made = over_chunks(df, panel, windowed, lookback=reach, lookahead=max(horizons, default=0))
    trimmed = skip_warm_up(made, panel, warm)
    # Row-wise columns come last so that the shuffle carries only what windows need.
    rowwise = {**energy.load_columns(df.columns), **energy.mix_columns(df.columns), **weather_columns(df, conditions)}
    return add_interactions(add_seasonal(trimmed, panel).withColumns(rowwise))


def drop_rows(df: DataFrame, panel: Panel, keep) -> DataFrame:
    """Filter rows and renumber positions, so that row-based windows step over the survivors."""
    return reposition(df.filter(keep), panel)
