"""Cross-product sums of a regression, and the small solve on them.

The sums are ordinary aggregates, so least squares over any number of rows and series is one
grouping with map-side combine; only p x p matrices reach Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


@dataclass
class Gram:
    n: float
    yy: float
    xy: np.ndarray
    xx: np.ndarray


def entries(width: int) -> list[Column]:
    """Products whose sums describe the regression: 1, y*y, x*y and the upper triangle of x*x."""
    y = F.col("_t")
    x = [F.get("_x", F.lit(i)) for i in range(width)]
    out = [F.lit(1.0), y * y, *[v * y for v in x]]
    return out + [x[i] * x[j] for i in range(width) for j in range(i, width)]


def sums(df: DataFrame, by: Sequence[str], target: str, regressors: Sequence[str]) -> DataFrame:
    """Column ``_gram`` per group, over the rows where target and regressors are known.

    The regressors travel as one array: a null check on dozens of derived columns would make the
    optimizer infer constraints between all of them.
    """
    x = F.array(*regressors) if regressors else F.array().cast("array<double>")
    packed = df.select(*by, F.col(target).alias("_t"), x.alias("_x"))
    complete = packed.filter(F.col("_t").isNotNull() & F.forall("_x", lambda v: v.isNotNull()))
    return complete.groupBy(*by).agg(F.array(*[F.sum(e) for e in entries(len(regressors))]).alias("_gram"))


def unpack(flat, width: int) -> Gram:
    v = np.asarray(flat, dtype=float)
    xx = np.zeros((width, width))
    upper = np.triu_indices(width)
    xx[upper] = v[2 + width :]
    xx = xx + xx.T - np.diag(np.diag(xx))
    return Gram(v[0], v[1], v[2 : 2 + width], xx)


def solve(flat, width: int, ridge: float = 0.0) -> np.ndarray:
    """Coefficients; least norm where the matrix is singular, none without regressors."""
    if not width:
        return np.empty(0)
    g = unpack(flat, width)
    return np.linalg.lstsq(g.xx + ridge * np.eye(width), g.xy, rcond=None)[0]
