"""Helpers shared by the text operators: slices of Arrow batches, UTF-8 buffers, word hashes, splits of rows.

Work inside a task is done on slices of a few megabytes, so that its memory depends on the longest single
text and not on the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: Bytes of text that a task works on at once.
SLICE_BYTES = 2 << 20
#: Bytes whose prefix sums are kept at once while words are hashed.
PIECE_BYTES = 1 << 18

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def remainder(key: str, divisor: int) -> Column:
    """crc32 of a column's text, modulo ``divisor``; a NULL key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def slices(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose texts hold ``limit`` bytes together; a longer text stands alone."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins and ends; NULL counts as empty."""
    flat = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1, flat.offset * 8)
    buffer = flat.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _letters() -> np.ndarray:
    """A random 64-bit number for every byte, A to Z like a to z."""
    table = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    table[65:91] = table[97:123]
    return table


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


LETTERS = _letters()
_UP, _DOWN = _powers(_BASE, PIECE_BYTES), _powers(_INVERSE, PIECE_BYTES)

#: Bytes of words that white space (space, \t to \r) separates.
UNSPACED = np.ones(256, bool)
UNSPACED[[9, 10, 11, 12, 13, 32]] = False


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of the bytes marked in ``inside`` (a table of 256), and for each
    document the index of its first word; runs end where documents end."""
    n = len(data)
    on = inside[data]
    first, last = on.copy(), on.copy()
    if n:
        first[1:] &= ~on[:-1]
        last[:-1] &= ~on[1:]
        borders = offsets[(offsets > 0) & (offsets < n)]
        first[borders] = on[borders]
        last[borders - 1] = on[borders - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, without regard to the case of A to Z."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, base + PIECE_BYTES, side="right")))
        piece = data[base:ends[stop - 1]]
        up, down = (_UP, _DOWN) if len(piece) <= PIECE_BYTES else (_powers(_BASE, len(piece)), _powers(_INVERSE, 1))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(LETTERS[piece] * up[:len(piece)], out=sums[1:])
        lo, hi = starts[at:stop] - base, ends[at:stop] - base
        out[at:stop] = mix64((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64))
        at = stop
    return out


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: one number, from an aggregate."""
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


def as_signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def without(df: DataFrame, *made: str) -> list[str]:
    """Columns of ``df`` that can be carried beside the ``made`` ones."""
    return [c for c in df.columns if c not in made]
