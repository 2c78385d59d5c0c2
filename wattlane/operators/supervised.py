"""Tables ready for a learner: boosted-tree features, scaled splits and sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wattlane.functions.time import boosted_time_columns
from wattlane.operators import cleaning, folds
from wattlane.operators.chunks import WindowExpr, lag_of, over_chunks, rolling_of
from wattlane.operators.features import BOOSTED_LAGS, BOOSTED_WINDOWS, ROLLING
from wattlane.panel import Panel


def boosted_window_columns(
    target: str, lags: Sequence[int] = BOOSTED_LAGS, windows: Sequence[int] = BOOSTED_WINDOWS
) -> dict[str, WindowExpr]:
    """Lags and rolling statistics that end one row before the current one."""
    out: dict[str, WindowExpr] = {f"lag_{k}": lag_of(target, k) for k in lags}
    for n in windows:
        for f in ROLLING:
            out[f"rolling_{f}_{n}"] = rolling_of(target, n, f, shift=1)
    return out


def add_boosted_features(
    df: DataFrame,
    panel: Panel,
    target: str,
    lags: Sequence[int] = BOOSTED_LAGS,
    windows: Sequence[int] = BOOSTED_WINDOWS,
    time_features: bool = True,
) -> DataFrame:
    """Features for boosted trees; none reads the current or a later target value."""
    new = boosted_window_columns(target, lags, windows)
    out = over_chunks(df, panel, new, lookback=max([*lags, *windows], default=0))
    return out.withColumns(boosted_time_columns(F.col(panel.ts))) if time_features else out


def feature_names(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns other than the target, its future values and bookkeeping columns."""
    roles = cleaning.column_roles(df, target)
    return [c for c in cleaning.drop_target_columns(roles.numeric) if c not in exclude]


def supervised_frame(
    df: DataFrame, panel: Panel, target: str,
    lags: Sequence[int] = BOOSTED_LAGS, windows: Sequence[int] = BOOSTED_WINDOWS,
) -> tuple[DataFrame, list[str], DataFrame]:
    """(scaled features with target, feature names, scaler parameters), fitted on all rows."""
    made = add_boosted_features(df, panel, target, lags, windows)
    names = feature_names(made, target, exclude=[panel.pos, *panel.keys])
    params = cleaning.fit_scaler(made, names)
    return cleaning.scale(made, params, names), names, params


def supervised_split(
    df: DataFrame, panel: Panel, target: str, fraction: float = 0.8,
    lags: Sequence[int] = BOOSTED_LAGS, windows: Sequence[int] = BOOSTED_WINDOWS,
) -> tuple[DataFrame, list[str], DataFrame]:
    """Train and test rows (column ``split``) with features made for each side on its own.

    The split is part of the window key, so no window reaches across it; the scaler sees training
    rows only; rows with any missing feature or target are dropped.
    """
    sides = folds.split_by_fraction(df, panel, fraction)
    inner = panel.with_keys(*panel.keys, "split")
    made = add_boosted_features(sides, inner, target, lags, windows)
    names = feature_names(made, target, exclude=[panel.pos, *panel.keys])
    params = cleaning.fit_scaler(made.filter(F.col("split") == "train"), names)
    scaled = cleaning.scale(made, params, names)
    return cleaning.drop_incomplete(scaled, [*names, target]), names, params


def add_sequences(df: DataFrame, panel: Panel, column: str, lookback: int = 24) -> DataFrame:
    """Array of the ``lookback`` previous values; rows with a shorter past are dropped."""

    def past(w):
        frame = w.rowsBetween(-lookback, -1)
        # Frames follow the window order, so the list needs no sort; NULLs are kept as elements.
        return F.collect_list(F.struct(column)).over(frame)

    out = over_chunks(df, panel, {"_past": past}, lookback=lookback)
    return (
        out.filter(F.size("_past") == lookback)
        .withColumn("sequence", F.col("_past")[column])
        .drop("_past")
    )


def sequence_split(
    df: DataFrame, panel: Panel, target: str, fraction: float = 0.8, lookback: int = 24
) -> tuple[DataFrame, DataFrame]:
    """Sequences per side, scaled with the training mean and deviation; also returns those."""
    sides = folds.split_by_fraction(df, panel, fraction)
    params = cleaning.fit_scaler(sides.filter(F.col("split") == "train"), [target], by=panel.keys)
    scaled = cleaning.scale(sides, params, [target], by=panel.keys)
    inner = panel.with_keys(*panel.keys, "split")
    return add_sequences(scaled, inner, target, lookback), params
