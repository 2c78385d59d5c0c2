"""Connected components of an edge table by alternating star contractions.

Each round reads the edges from a table written into the shared checkpoint folder, so lineage stays short
and lost executors cost single tasks.  Edges inside a task are first reduced to a forest by union-find.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattlane.session import materialize


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find: (node, smallest node reached) for every node of the edges that isn't the smallest."""
    names, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(names)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(index[:len(a)].tolist(), index[len(a):].tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    roots = np.array([root(x) for x in range(len(names))], int)
    moved = roots != np.arange(len(names))
    return names[moved], names[roots[moved]]


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = forest(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node reachable, for nodes of ``edges`` (a, b) that aren't roots.

    Loops and repeated edges do no harm; an edge table without rows gives no rows.
    """
    current = materialize(edges.select("a", "b").mapInArrow(_reduce, "a long, b long").distinct(), "edges")
    size = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")))
    before = current.agg(size).first()
    while before[0][0]:
        both = current.union(current.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = (
            both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        )
        # A node that is its own smallest neighbour keeps none of the rows above but is named by them.
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        current = materialize(small.union(least.select("a", F.col("low").alias("b"))).distinct(), "edges")
        after = current.agg(size).first()
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
