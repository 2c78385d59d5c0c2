"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered 0 to N-1 in an order that the data alone decides.  A Feistel network permutes the smallest range of
2^k numbers that holds them all; a number that leaves 0 to N-1 walks on through the network until it comes back, so
0 to N-1 is permuted within itself.  The permuted number p gives shard p mod S and slot p div S: shards differ by one
row at most, slots have no gap, and both directions can be computed for any row without reading the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlane.llm.texts import mix64, text_bytes, without
from wattlane.operators.ordering import with_positions
from wattlane.panel import Panel

#: Shards of the registered query.
SHARDS = 24
ROUNDS = 8
#: Bytes of text in a file that ``write`` makes, on average.
FILE_BYTES = 128 << 20


@dataclass(frozen=True)
class Shuffle:
    """A permutation of 0 to ``total`` - 1; equal totals and seeds give equal permutations."""

    total: int
    seed: int = 0

    @property
    def widths(self) -> tuple[int, int]:
        """Bits of the left and the right half; the range is less than twice (or, at least, four) the total."""
        bits = max(2, (max(self.total, 1) - 1).bit_length())
        return bits // 2, bits - bits // 2

    def _mask(self, half: np.ndarray, step: int, width: int) -> np.ndarray:
        key = np.uint64((self.seed * 0x9E3779B97F4A7C15 + (step + 1) * 0xD1B54A32D192ED03) & (1 << 64) - 1)
        return mix64(mix64(half + key) ^ key) & np.uint64((1 << width) - 1)

    def _once(self, values: np.ndarray, back: bool) -> np.ndarray:
        left, right = self.widths
        high, low = values >> np.uint64(right), values & np.uint64((1 << right) - 1)
        # Even rounds change the high half by the low one, odd rounds the other way; each undoes itself.
        for step in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if step % 2:
                low = low ^ self._mask(high, step, right)
            else:
                high = high ^ self._mask(low, step, left)
        return high << np.uint64(right) | low

    def _walk(self, numbers: np.ndarray, back: bool) -> np.ndarray:
        out = self._once(np.asarray(numbers).astype(np.uint64), back)
        outside = np.flatnonzero(out >= self.total)
        while len(outside):
            out[outside] = self._once(out[outside], back)
            outside = outside[out[outside] >= self.total]
        return out.astype(np.int64)

    def place(self, numbers: np.ndarray) -> np.ndarray:
        """Where rows of these numbers go."""
        return self._walk(numbers, False)

    def origin(self, places: np.ndarray) -> np.ndarray:
        """Numbers of the rows that went to these places."""
        return self._walk(places, True)

    def shard_and_slot(self, numbers: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
        places = self.place(numbers)
        return places % shards, places // shards

    def row_at(self, shard: np.ndarray, slot: np.ndarray, shards: int) -> np.ndarray:
        """Numbers of the rows at these shards and slots."""
        return self.origin(np.asarray(slot) * shards + np.asarray(shard))


def numbered(docs: DataFrame, order: list[str]) -> DataFrame:
    """Add ``row_number`` (0 to N-1) by ``order``, NULL first; rows equal in it are told apart by where they were read.

    The order is a range shuffle that is written once, so equal keys of any number spread over its partitions.
    """
    told = docs.withColumn("_read", F.monotonically_increasing_id())
    return with_positions(told, Panel(keys=(), ts=order[0], tie=(*order[1:], "_read"), pos="row_number")).drop("_read")


def assign(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """Add ``row_number``, ``shard`` (0 to shards-1) and ``slot`` (from 0 in its shard, without gaps).

    Row numbers follow doc_id (NULL first), then size, CRC and a 64-bit hash of the text; rows equal in all of them
    are interchangeable, so reruns agree.  All rows stay: NULL and empty texts, NULL and repeated ids, equal rows.
    An empty table gives no rows.  Columns of these three names (and ``_size``, ``_crc``, ``_hash``) are replaced,
    others carried along.
    """
    made = ("row_number", "shard", "slot", "_size", "_crc", "_hash", "_read", "_row", "_block", "_idx", "_offset")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        *without(docs, *made), F.octet_length(text).cast("long").alias("_size"),
        F.crc32(text.cast("binary")).alias("_crc"), F.xxhash64(text).alias("_hash"))
    return _dealt(numbered(rows, ["doc_id", "_size", "_crc", "_hash"]).drop("_size", "_crc", "_hash"), shards, seed)


def _dealt(rows: DataFrame, shards: int, seed: int) -> DataFrame:
    order = Shuffle(rows.count(), seed)  # of the written, numbered table: file footers
    place = rows.columns.index("row_number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, slot = order.shard_and_slot(batch.column(place).to_numpy(zero_copy_only=False), shards)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shard, pa.int32()), pa.array(slot, pa.int64())],
                [*batch.schema.names, "shard", "slot"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, shard int, slot long")


def write(spark: SparkSession, docs: DataFrame, path: str, shards: int = SHARDS, seed: int = 0) -> None:
    """Write whole documents to ``path`` as folders by shard, rows of a file in order of their slots.

    A shard is as many files as its bytes ask for; no task writes a whole one.
    """
    files = max(shards, -(-text_bytes(docs) // FILE_BYTES))
    rows = assign(spark, docs, shards, seed)
    rows.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard").parquet(path)


def plan(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """What each document's place is, without carrying texts through the shuffle.

    ``doc_id``, ``size`` (UTF-8 bytes of the text plus 8), ``text_crc32``, ``law`` (``rows``), ``shard``, ``slot``,
    ``grown_shard`` (NULL: this law moves rows when shards are added), ``row_number``.  Rows as in ``assign``; a NULL
    text has no bytes and CRC 0.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), F.xxhash64(text).alias("_hash"))
    dealt = _dealt(numbered(rows, ["doc_id", "size", "text_crc32", "_hash"]).drop("_hash"), shards, seed)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number")
