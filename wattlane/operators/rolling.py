"""Rolling statistics of double columns on sorted Arrow batches.

A sliding window aggregate visits every row of the frame for every row of the table, row by row.  Here the frame is
walked once for a whole batch: step k takes the values k rows earlier, in the same order and by the same formulas as
Spark's own aggregates, so that the figures are the same to the last bit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _means(x: np.ndarray, n: int) -> np.ndarray:
    size = len(x) - n + 1
    total = np.zeros(size)
    for k in range(n):
        total += x[k:k + size]
    return total / n


def _deviations(x: np.ndarray, n: int) -> np.ndarray:
    size = len(x) - n + 1
    mean, squares = np.zeros(size), np.zeros(size)
    delta, share = np.empty(size), np.empty(size)
    for k in range(n):
        np.subtract(x[k:k + size], mean, out=delta)
        np.divide(delta, k + 1.0, out=share)
        mean += share
        np.subtract(delta, share, out=share)
        share *= delta
        squares += share
    return np.sqrt(squares / (n - 1.0)) if n > 1 else squares


def _extremes(pick: np.ufunc) -> Callable[[np.ndarray, int], np.ndarray]:
    def best(x: np.ndarray, n: int) -> np.ndarray:
        """Of frames of 1, 2, 4, ... rows; two that overlap make the last one."""
        reach = 1
        while 2 * reach <= n:
            x = pick(x[:-reach], x[reach:])
            reach *= 2
        return pick(x[:len(x) - (n - reach)], x[n - reach:]) if n > reach else x

    return best


# NaN is the largest double: it is a minimum only of NaN alone, and always the maximum.
_STATISTICS = {"mean": _means, "std": _deviations, "min": _extremes(np.fmin), "max": _extremes(np.maximum)}


def _begins(table: pa.Table, group: Sequence[str]) -> np.ndarray:
    """Whether a row's group differs from that of the row before; NULL equals NULL."""
    begins = np.zeros(table.num_rows, bool)
    begins[:1] = True
    for name in group:
        column = table.column(name).combine_chunks()
        a, b = column.slice(1), column.slice(0, max(len(column) - 1, 0))
        same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        begins[1:] |= ~same.to_numpy(zero_copy_only=False)
    return begins


def add_statistics(
    batches: Iterator[pa.RecordBatch], group: Sequence[str], new: Sequence[tuple[str, str, int, str]],
    kept: Sequence[str], home: str, chunk: str,
) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``group`` and order, with ``new`` columns (name, column, frame, statistic); NULL until the frame
    has only known rows of the group.  Rows whose ``home`` is another ``chunk`` only fill frames.
    """
    reach = max(n for _, _, n, _ in new) - 1
    needed = list(dict.fromkeys([*group, *[c for _, c, _, _ in new]]))
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        seen = rows.select(needed) if before is None else pa.concat_tables([before, rows.select(needed)])
        begins, old = _begins(seen, group), seen.num_rows - rows.num_rows
        at = np.arange(seen.num_rows)
        nth = at - np.maximum.accumulate(np.where(begins, at, 0))
        stay = pc.equal(rows.column(home), rows.column(chunk)).combine_chunks()
        made = rows.select([c for c in kept])
        values, known = {}, {}
        for name, column, n, statistic in new:
            if column not in values:
                cells = seen.column(column).combine_chunks()
                known[column] = np.concatenate([[0], np.cumsum(cells.is_valid().to_numpy(zero_copy_only=False))])
                values[column] = pc.fill_null(cells, 0.0).to_numpy(zero_copy_only=False)
            full = np.zeros(len(at), bool)
            out = np.zeros(len(at))
            if len(at) >= n:
                count = known[column]
                full[n - 1:] = (nth[n - 1:] >= n - 1) & (count[n:] - count[:-n] == n)
                if statistic == "std" and n == 1:
                    full[:] = False
                with np.errstate(all="ignore"):
                    out[n - 1:] = _STATISTICS[statistic](values[column], n)
            made = made.append_column(name, pa.array(out[old:], mask=~full[old:]))
        yield from made.filter(stay).combine_chunks().to_batches()
        before = seen.slice(max(seen.num_rows - reach, 0)) if reach else None
