"""Whitening of embeddings with exact cross-products from bit planes.

Entries become integers.  In a block of rows every dimension is shifted by its smallest value there, and each bit
of the shifted values becomes a plane: one bit a row, packed into 64-bit words.  The cross-product of two dimensions
is the sum of 2^(a+b) * popcount(plane a AND plane b) over their planes, so it is exact; shifting back is integer
arithmetic too.  Blocks are summed by a grouped aggregate, the driver gets one number per pair of dimensions, centres
them as integers, and only then turns to floating point for the eigenvectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlane.session import materialize

#: An entry c becomes floor(SCALE * c); an origin added to all entries would change no covariance.
SCALE = 64.0
#: Scaled entries are held inside +-LIMIT, so that they fit a long.
LIMIT = float(1 << 62)
#: Components returned at most.
COMPONENTS = 32
#: Entries (rows times dimensions) that a task works on at once.
BLOCK_ENTRIES = 1 << 21
#: An eigenvalue below this share of the trace is rounding, not variance.
NOISE = 1e-12

_SPLIT = 10**18
_SUMS = "size int, i int, j int, n long, hi decimal(38,0), lo decimal(38,0)"


def integers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of equally long vectors: their rows in the batch, and floor(64 * c) as int64.

    Vectors that are NULL or hold NULL or a value that is not finite are in no block.
    """
    vectors = column.cast(pa.large_list(pa.float64()))
    sizes = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes[sizes > 0]):
        mine = np.flatnonzero(sizes == size)
        step = max(1, BLOCK_ENTRIES // int(size))
        for at in range(0, len(mine), step):
            rows = mine[at:at + step]
            flat = vectors.take(pa.array(rows)).flatten()
            block = pc.fill_null(flat, math.nan).to_numpy(zero_copy_only=False).reshape(len(rows), int(size))
            whole = np.isfinite(block).all(axis=1)
            if whole.any():
                scaled = np.floor(np.clip(SCALE * block[whole], -LIMIT, LIMIT))
                yield rows[whole], scaled.astype(np.int64)


def planes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of a block: 64-bit words (planes x words), and the dimension and bit of each plane.

    ``values`` are not negative (rows x dimensions); a dimension has as many planes as its largest value has bits.
    """
    n, size = values.shape
    bits = [int(v).bit_length() for v in values.max(axis=0)]
    dims = np.repeat(np.arange(size), bits)
    order = np.concatenate([np.arange(b) for b in bits] or [np.empty(0, int)]).astype(np.int64)
    words = np.zeros((len(dims), -(-n // 64) * 8), np.uint8)
    for p in range(len(dims)):
        packed = np.packbits((values[:, dims[p]] >> np.uint64(order[p])).astype(np.uint8) & 1)
        words[p, :len(packed)] = packed
    return words.view(np.uint64), dims, order


def scatter(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums per dimension and cross-products of a block of integers (rows x dimensions), as Python integers."""
    n, size = values.shape
    low = values.min(axis=0)
    shifted = (values - low).view(np.uint64)  # a difference of longs inside +-2^62 fits 63 bits
    words, dims, order = planes(shifted)
    count = len(dims)
    both = np.zeros((count, count), np.int64)
    for p in range(count):
        both[p, p:] = np.bitwise_count(words[p:] & words[p]).sum(axis=1, dtype=np.int64)
    both = np.maximum(both, both.T)
    wide = 2 * (int(order.max()) + 1 if count else 0) + n.bit_length() > 62
    weight = np.array([1 << int(b) for b in order], object if wide else np.int64)
    at = np.zeros((count, size), object if wide else np.int64)
    at[np.arange(count), dims] = weight
    cross = (at.T @ (both.astype(at.dtype) @ at)).astype(object)
    sums = (at.T @ np.diagonal(both).astype(at.dtype)).astype(object)
    low = low.astype(object)
    cross = cross + np.outer(low, sums) + np.outer(sums, low) + n * np.outer(low, low)
    return sums + n * low, cross


def _decimals(values: list[int]) -> pa.Array:
    from decimal import Decimal

    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's sums: a row per length and pair of dimensions (j = -1: the sum of dimension i)."""
    totals: dict[int, list] = {}
    for batch in batches:
        for rows, block in integers(batch.column(0)):
            sums, cross = scatter(block)
            held = totals.setdefault(block.shape[1], [0, 0, 0])
            held[0] += len(rows)
            held[1] = held[1] + sums
            held[2] = held[2] + cross
    for size, (n, sums, cross) in totals.items():
        i, j = np.triu_indices(size)
        values = [*sums, *cross[i, j]]
        parts = [divmod(v, _SPLIT) for v in values]
        yield pa.RecordBatch.from_arrays([
            pa.array([size] * len(values), pa.int32()),
            pa.array([*range(size), *i.tolist()], pa.int32()),
            pa.array([-1] * size + j.tolist(), pa.int32()),
            pa.array([n] * len(values), pa.int64()),
            _decimals([p[0] for p in parts]), _decimals([p[1] for p in parts]),
        ], ["size", "i", "j", "n", "hi", "lo"])


@dataclass(frozen=True)
class Whitening:
    """What a task needs: row count, exact sums, projections (dimensions x components), eigenvalues, trace."""

    n: int
    sums: tuple[int, ...]
    project: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def size(self) -> int:
        return len(self.sums)


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Exact moments of all usable vectors and the leading eigenvectors; None without a usable vector.

    Vectors count if they have the commonest length (ties: the longer one).  The driver receives one row per pair
    of dimensions and length.
    """
    sums = vectors.select(F.col(column).cast("array<double>").alias("v")).mapInArrow(_partial, _SUMS)
    found = materialize(
        sums.groupBy("size", "i", "j").agg(F.sum("n").alias("n"), F.sum("hi").alias("hi"), F.sum("lo").alias("lo")),
        "moments")
    best = found.where("i = 0 AND j = -1").orderBy(F.desc("n"), F.desc("size")).first()
    if best is None:
        return None
    size, n = best["size"], best["n"]
    first, cross = [0] * size, np.zeros((size, size), object)
    for r in found.where(F.col("size") == size).collect():
        value = int(r["hi"]) * _SPLIT + int(r["lo"])
        if r["j"] < 0:
            first[r["i"]] = value
        else:
            cross[r["i"], r["j"]] = cross[r["j"], r["i"]] = value
    return solve(n, first, cross, components)


def solve(n: int, first: list[int], cross: np.ndarray, components: int) -> Whitening:
    """Centre as integers (n * cross - sums x sums), divide once, and take the leading eigenvectors."""
    sums = np.array(first, object)
    centred = n * cross - np.outer(sums, sums)
    square = n * n
    cov = np.array([[v / square for v in row] for row in centred], float).reshape(len(first), len(first))
    values, vectors = np.linalg.eigh(cov)
    keep = np.argsort(values, kind="stable")[::-1][:components]
    values, vectors = values[keep], vectors[:, keep]
    # Signs are free; the largest entry of each vector is made positive, so that reruns agree.
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(keep))] < 0, -1.0, 1.0)
    trace = float(sum(int(v) for v in centred.diagonal()) / square)
    real = values > NOISE * trace
    project = np.where(real, vectors / np.sqrt(np.where(real, values, 1.0)), np.nan)
    return Whitening(n, tuple(int(s) for s in first), project, np.where(real, values, 0.0), trace)


def centred(block: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - S, exactly: int64 where it fits, else Python integers."""
    top = max(int(np.abs(block).max()) if block.size else 0, max((abs(s) for s in model.sums), default=0) // model.n + 1)
    kind = np.int64 if 2 * model.n * top < 1 << 62 else object
    return block.astype(kind) * model.n - np.array(model.sums, kind)


def whitened(block: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """Exact centred rows, and their projections divided by the components' standard deviations."""
    exact = centred(block, model)
    return exact, (exact.astype(float) / model.n) @ model.project


def _deviations(exact: np.ndarray) -> pa.Array:
    """Sum of squares per row as a long; NULL where it doesn't fit one."""
    if exact.dtype != object and exact.size:
        top = int(np.abs(exact).max())
        if top * top * exact.shape[1] < 1 << 63:
            return pa.array((exact * exact).sum(axis=1), pa.int64())
    sums = [int(v) for v in (exact.astype(object) ** 2).sum(axis=1)]
    return pa.array([v if v < 1 << 63 else None for v in sums], pa.int64())


def identity_error(vectors: DataFrame, model: Whitening, column: str = "embedding") -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, measured on all of them.

    Components without variance don't count.
    """
    real = np.flatnonzero(model.values > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(len(real)), np.zeros((len(real), len(real)))
        for batch in batches:
            for _, block in integers(batch.column(0)):
                if block.shape[1] == model.size:
                    made = whitened(block, model)[1][:, real]
                    first += made.sum(axis=0)
                    second += made.T @ made
        i, j = np.triu_indices(len(real))
        yield pa.RecordBatch.from_arrays([
            pa.array([*range(len(real)), *i.tolist()], pa.int32()),
            pa.array([-1] * len(real) + j.tolist(), pa.int32()),
            pa.array([*first, *second[i, j]], pa.float64()),
        ], ["i", "j", "total"])

    parts = vectors.select(F.col(column).cast("array<double>").alias("v")).mapInArrow(run, "i int, j int, total double")
    first, second = np.zeros(len(real)), np.zeros((len(real), len(real)))
    for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        if r["j"] < 0:
            first[r["i"]] = r["total"]
        else:
            second[r["i"], r["j"]] = second[r["j"], r["i"]] = r["total"]
    if not len(real):
        return 0.0
    mean = first / model.n
    return float(np.abs(second / model.n - np.outer(mean, mean) - np.eye(len(real))).max())


_ROWS = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
         "identity_error double, eigenvalue double")


def whiten(
    spark: SparkSession, vectors: DataFrame, key: str = "vec_id", column: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """A row per usable vector and component (numbered from 1 by falling eigenvalue).

    Dropped are vectors that are NULL, empty, hold NULL or a value that is not finite, or have another length than
    most (ties: the longer length stays).  Entries beyond 2^62 / 64 count as that bound.  ``deviation`` is NULL where
    it doesn't fit a long; ``whitened`` is NULL for a component without variance (constant or too few rows), its
    ``explained`` is 0.  Repeated rows and keys, and NULL keys, are rows like any other; equal eigenvalues keep an
    arbitrary but fixed order.  Without a usable vector the result is empty.  Other columns are ignored, whatever
    their names.
    """
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    model = fit(rows, "v", components)
    if model is None:
        return spark.createDataFrame([], _ROWS)
    error = identity_error(rows, model, "v")
    kept = model.project.shape[1]
    share = model.values / model.trace if model.trace > 0 else np.zeros(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, block in integers(batch.column(1)):
                if block.shape[1] != model.size:
                    continue
                exact, made = whitened(block, model)
                each = pa.array(np.repeat(np.arange(len(at)), kept))
                total = len(at) * kept
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(at)).take(each),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(total, model.n, np.int64)),
                    _deviations(exact).take(each),
                    pa.array(made.ravel(), from_pandas=True),
                    pa.array(np.tile(share, len(at))),
                    pa.array(np.full(total, error)),
                    pa.array(np.tile(model.values, len(at))),
                ], [f.split()[0] for f in _ROWS.split(", ")])

    return rows.mapInArrow(run, _ROWS)
