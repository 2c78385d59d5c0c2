"""Positional windows over chunks of a series with a halo of neighbouring rows.

``Window.partitionBy(series)`` puts a whole series in one task and ``Window.orderBy`` alone puts the
whole table there.  Bounded frames need only a few neighbours, so a series is cut into chunks of
positions and the rows next to a border are sent to both sides.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from wattlane.panel import Panel

WindowExpr = Callable[[WindowSpec], Column]
DEFAULT_CHUNK = 8192


def spread_chunks(
    df: DataFrame, panel: Panel, lookback: int = 0, lookahead: int = 0, chunk_rows: int = DEFAULT_CHUNK
) -> DataFrame:
    """Rows dealt by series and ``_chunk``; those near a border also to the neighbour of their ``_home``."""
    size = max(chunk_rows, lookback, lookahead, 1)
    pos = F.col(panel.pos)
    home = F.floor(pos / F.lit(size))
    offset = pos - home * F.lit(size)
    targets = [home]
    if lookback:
        targets.append(F.when(offset >= size - lookback, home + 1))
    if lookahead:
        targets.append(F.when(offset < lookahead, home - 1))
    spread = df.withColumn("_home", home).withColumn(
        "_chunk", F.explode(F.array_compact(F.array(*targets)))
    )
    # Frames cost time, not bytes: a stated number of partitions keeps adaptive execution from
    # merging well-compressed chunks into a few tasks.  The window reuses this shuffle.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return spread.repartition(parts, *panel.keys, "_chunk")


def over_chunks(
    df: DataFrame,
    panel: Panel,
    columns: Mapping[str, WindowExpr],
    lookback: int = 0,
    lookahead: int = 0,
    chunk_rows: int = DEFAULT_CHUNK,
) -> DataFrame:
    """Add window ``columns``; each maps a name to a function of the chunk's window.

    Frames may reach at most ``lookback`` rows back and ``lookahead`` rows forward.  All columns
    share one shuffle and one sort.
    """
    spread = spread_chunks(df, panel, lookback, lookahead, chunk_rows)
    window = Window.partitionBy(*panel.keys, "_chunk").orderBy(panel.pos)
    kept = [c for c in df.columns if c not in columns]
    return (
        spread.select(*kept, "_home", "_chunk", *[fn(window).alias(n) for n, fn in columns.items()])
        .filter(F.col("_home") == F.col("_chunk"))
        .drop("_home", "_chunk")
    )


def lag_of(column: str, k: int) -> WindowExpr:
    return lambda w: F.lag(column, k).over(w)


def lead_of(column: str, k: int) -> WindowExpr:
    return lambda w: F.lead(column, k).over(w)


# pandas-style rolling aggregates: NULL until the frame holds n non-null rows.
_ROLLING = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def rolling_of(column: str | Column, n: int, func: str, shift: int = 0) -> WindowExpr:
    if func not in _ROLLING:
        raise ValueError(f"unknown rolling function: {func}")

    def build(w: WindowSpec) -> Column:
        frame = w.rowsBetween(-(n - 1) - shift, -shift)
        return F.when(F.count(column).over(frame) == n, _ROLLING[func](column).over(frame))

    return build


def fill_both_ways(
    df: DataFrame, panel: Panel, columns: list[str], chunk_rows: int = DEFAULT_CHUNK
) -> DataFrame:
    """Forward fill, then backward fill, over unbounded distances.

    Inside a chunk the fill is an ordinary window; across chunks the last and first known values of
    every chunk are carried through a table with one row per chunk.
    """
    keys = list(panel.keys)
    chunked = df.withColumn("_chunk", F.floor(F.col(panel.pos) / F.lit(chunk_rows)))
    edges = chunked.groupBy(*keys, "_chunk").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(panel.pos))).alias(f"_l_{c}") for c in columns],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(panel.pos))).alias(f"_f_{c}") for c in columns],
    )
    carried = _known_around(edges, keys, columns)
    rows = Window.partitionBy(*keys, "_chunk").orderBy(panel.pos)
    upto = rows.rowsBetween(Window.unboundedPreceding, 0)
    onward = rows.rowsBetween(0, Window.unboundedFollowing)
    local = chunked.select(
        "*",
        *[F.last(c, ignorenulls=True).over(upto).alias(f"_u_{c}") for c in columns],
        *[F.first(c, ignorenulls=True).over(onward).alias(f"_o_{c}") for c in columns],
    )
    filled = local.join(carried, [*keys, "_chunk"])
    return filled.select(
        *[
            F.coalesce(f"_u_{c}", f"_p_{c}", f"_o_{c}", f"_n_{c}").alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


_SUPER = 4096


def _known_around(edges: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Last known value before and first known value after each chunk (``_p_``, ``_n_``).

    The chunk table of a very long series is long itself, so it is cut once more.
    """
    staged = edges.withColumn("_super", F.floor(F.col("_chunk") / F.lit(_SUPER)))
    at = F.col("_chunk")
    supers = staged.groupBy(*keys, "_super").agg(
        *[F.max_by(f"_l_{c}", F.when(F.col(f"_l_{c}").isNotNull(), at)).alias(f"_l_{c}") for c in columns],
        *[F.min_by(f"_f_{c}", F.when(F.col(f"_f_{c}").isNotNull(), at)).alias(f"_f_{c}") for c in columns],
    )

    def around(table: DataFrame, window: WindowSpec, kept: list[str], mark: str) -> DataFrame:
        earlier = window.rowsBetween(Window.unboundedPreceding, -1)
        later = window.rowsBetween(1, Window.unboundedFollowing)
        return table.select(
            *kept,
            *[F.last(f"_l_{c}", ignorenulls=True).over(earlier).alias(f"_{mark}p_{c}") for c in columns],
            *[F.first(f"_f_{c}", ignorenulls=True).over(later).alias(f"_{mark}n_{c}") for c in columns],
        )

    inside = around(staged, Window.partitionBy(*keys, "_super").orderBy("_chunk"), [*keys, "_super", "_chunk"], "i")
    across = around(supers, Window.partitionBy(*keys).orderBy("_super"), [*keys, "_super"], "a")
    return inside.join(across, [*keys, "_super"]).select(
        *keys,
        "_chunk",
        *[F.coalesce(f"_i{side}_{c}", f"_a{side}_{c}").alias(f"_{side}_{c}") for c in columns for side in ("p", "n")],
    )
