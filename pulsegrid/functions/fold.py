"""Ordered per-group folds as a streaming ``mapInPandas`` pass.

Rows are hash-partitioned on the group columns and sorted within each partition by (group, order); the fold
then walks each partition's Arrow batches once, resetting its state whenever the group changes. Compared with
``groupBy().applyInPandas`` there is no per-group DataFrame to build; a fold over rows needs one Arrow batch and its
state. ``whole_groups`` serves folds that need a group's rows together: it holds the group that a batch border cuts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sorted_fold(df: DataFrame, group: Sequence[str], order_by: Sequence[str],
                run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """Apply ``run`` to every partition of ``df`` hash-partitioned by ``group`` and sorted by group + order."""
    parts = df.repartition(*[F.col(g) for g in group]).sortWithinPartitions(*group, *order_by)
    return parts.mapInPandas(run, schema)


def group_starts(keys: list[np.ndarray], carry: tuple | None) -> np.ndarray:
    """Boolean array: row i starts a new group (its key differs from row i-1, or from ``carry`` for row 0)."""
    n = len(keys[0])
    start = np.zeros(n, dtype=bool)
    if n == 0:
        return start
    for k in keys:
        start[1:] |= k[1:] != k[:-1]
    first = tuple(k[0] for k in keys)
    start[0] = carry is None or first != carry
    return start


def whole_groups(batches: Iterator[pd.DataFrame], key_cols: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Frames of complete groups (consecutive rows with equal keys, any number of groups a frame) from sorted Arrow
    batches. Only the group that a batch border cuts is held back, as a list of its pieces."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if len(pdf) == 0:
            continue
        carry = tuple(held[-1][c].iat[-1] for c in key_cols) if held else None
        starts = np.flatnonzero(group_starts([pdf[c].to_numpy() for c in key_cols], carry))
        if len(starts) == 0:
            held.append(pdf)
            continue
        cut = int(starts[-1])
        done = [*held, pdf.iloc[:cut]] if cut else held
        held = [pdf.iloc[cut:]]
        if done:
            yield pd.concat(done, ignore_index=True)
    if held:
        yield pd.concat(held, ignore_index=True)
