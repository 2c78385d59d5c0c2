"""Row positions and running totals without sending a series to one task.

A running total is computed in two levels: rows are laid out in *blocks* that follow the order and
have a bounded size, each block is summed, the block sums are accumulated, and rows add the total
of the blocks before theirs.  A series that holds a third of a table is spread over many blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wattlane.panel import Panel
from wattlane.session import materialize

# monotonically_increasing_id() keeps the row number of a partition in its low 33 bits.
_ROW_BITS = 33
_SUPER = 4096


def range_blocks(df: DataFrame, order: list[str]) -> DataFrame:
    """Sort across the cluster and stamp ``_block`` (partition) and ``_idx`` (row inside it).

    Range partitions are cut from a sample, so they are balanced even when one key or one instant
    dominates, but a second run could cut elsewhere.  The stamped rows are therefore written once
    and both the totals and the rows are read from that table.
    """
    stamped = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    saved = materialize(stamped, "ordered")
    return (
        saved.withColumn("_block", F.shiftright("_row", _ROW_BITS))
        .withColumn("_idx", F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_row")
    )


def with_positions(df: DataFrame, panel: Panel) -> DataFrame:
    """Add ``pos`` (0-based row number in time order inside each series) to arbitrary rows."""
    keys = list(panel.keys)
    blocks = range_blocks(df, [*keys, *panel.order])
    # One row per partition and series that meets it.
    totals = blocks.groupBy(*keys, "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_idx").alias("_first")
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        "_block",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
    )
    return (
        blocks.join(offsets, [*keys, "_block"])
        .withColumn(panel.pos, F.col("_idx") + F.col("_offset"))
        .drop("_block", "_idx", "_offset")
    )


def block_offsets(totals: DataFrame, keys: list[str], block: str, measures: list[str]) -> DataFrame:
    """Exclusive running sums of per-block ``measures``; blocks are grouped again so that the
    accumulation of a very long series is itself spread over tasks."""
    staged = totals.withColumn("_super", F.floor(F.col(block) / F.lit(_SUPER)))
    inside = (
        Window.partitionBy(*keys, "_super").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    )
    across = Window.partitionBy(*keys).orderBy("_super").rowsBetween(Window.unboundedPreceding, -1)
    supers = (
        staged.groupBy(*keys, "_super")
        .agg(*[F.sum(m).alias(m) for m in measures])
        .select(
            *keys,
            "_super",
            *[F.coalesce(F.sum(m).over(across), F.lit(0)).alias(f"_s_{m}") for m in measures],
        )
    )
    local = staged.select(
        *keys,
        block,
        "_super",
        *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"_b_{m}") for m in measures],
    )
    return local.join(supers, [*keys, "_super"]).select(
        *keys, block, *[(F.col(f"_b_{m}") + F.col(f"_s_{m}")).alias(m) for m in measures]
    )


def reposition(df: DataFrame, panel: Panel, chunk_rows: int = 8192) -> DataFrame:
    """Renumber ``pos`` densely after rows were removed.

    Old positions already bound the blocks (at most ``chunk_rows`` rows each), so no sort across
    the cluster is needed.
    """
    keys = list(panel.keys)
    chunked = df.withColumn("_chunk", F.floor(F.col(panel.pos) / F.lit(chunk_rows)))
    totals = chunked.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    offsets = block_offsets(totals, keys, "_chunk", ["_n"])
    rank = F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(panel.pos)) - 1
    return (
        chunked.withColumn("_rank", rank)
        .join(offsets, [*keys, "_chunk"])
        .withColumn(panel.pos, (F.col("_rank") + F.col("_n")).cast("long"))
        .drop("_chunk", "_rank", "_n")
    )


def running_totals(df: DataFrame, order: list[str], measures: list[str]) -> DataFrame:
    """Inclusive running sums of ``measures`` over the whole table in ``order``.

    ``order`` must identify a row.  Adds one ``cum_<measure>`` column per measure.
    """
    blocks = range_blocks(df, order)
    totals = blocks.groupBy("_block").agg(*[F.sum(m).alias(m) for m in measures])
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: small by construction.
    offsets = totals.select(
        "_block", *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_o_{m}") for m in measures]
    )
    inside = (
        Window.partitionBy("_block").orderBy("_idx").rowsBetween(Window.unboundedPreceding, 0)
    )
    local = blocks.select("*", *[F.sum(m).over(inside).alias(f"_c_{m}") for m in measures])
    return local.join(offsets, "_block").select(
        *df.columns, *[(F.col(f"_c_{m}") + F.col(f"_o_{m}")).alias(f"cum_{m}") for m in measures]
    )
