"""Token bucket levels over time slices, by composed maps.

The bucket's level is counted in whole milliseconds of refill: a token is ``interval``, a full bucket
``capacity x interval``, so every level is an exact integer. What the requests of one (key, slice) do to the level is a
function of the level that the slice is entered with. That function is a few pieces, each either "entry + c" or a
constant, however many requests the slice holds: a refill shifts the pieces and flattens what would overflow, a
request cuts the piece that one token divides. The maps are made for all slices at once; a walk over one map per slice
and key gives every slice its entry level; a last pass then decides the requests of each slice on its own. So no task
needs the requests of a key in order beyond one slice, and nothing is assumed about pauses.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame

from pulsegrid.functions.fold import group_starts, sorted_fold

MAP_COLUMNS = "first_ms bigint, last_ms bigint, lows array<bigint>, adds array<bigint>, fixed array<boolean>"


class LevelMap:
    """Entry level -> level. Piece i holds from ``lows[i]`` to the next piece: ``adds[i]``, plus the entry unless fixed."""

    def __init__(self, interval: int, capacity: int):
        self.interval, self.full = interval, capacity * interval
        self.pieces: list[tuple[int, int, bool]] = [(0, 0, False)]

    def _put(self, pieces: list[tuple[int, int, bool]]) -> None:
        self.pieces = [p for i, p in enumerate(pieces) if not i or p[1:] != pieces[i - 1][1:]]

    def refill(self, elapsed: int) -> None:
        """``elapsed`` ms without a request; never above full."""
        if elapsed <= 0:
            return
        out = []
        for (low, add, fixed), high in zip(self.pieces, self._highs(), strict=True):
            if fixed:
                out.append((low, min(self.full, add + elapsed), True))
                continue
            over = self.full - add - elapsed  # entries from here on are full
            if low < over:
                out.append((low, add + elapsed, False))
            if high >= over:
                out.append((max(low, over), self.full, True))
        self._put(out)

    def take(self) -> None:
        """A request: it takes one token where there is one."""
        out = []
        for (low, add, fixed), high in zip(self.pieces, self._highs(), strict=True):
            if fixed:
                out.append((low, add - self.interval if add >= self.interval else add, True))
                continue
            enough = self.interval - add
            if low < enough:
                out.append((low, add, False))
            if high >= enough:
                out.append((max(low, enough), add - self.interval, False))
        self._put(out)

    def _highs(self) -> list[int]:
        return [p[0] - 1 for p in self.pieces[1:]] + [self.full]


def applied(lows: Sequence[int], adds: Sequence[int], fixed: Sequence[bool], level: int) -> int:
    i = bisect_right(lows, level) - 1
    return int(adds[i]) if fixed[i] else int(level + adds[i])


def _maps(keys: list[str], interval: int, capacity: int):
    names = [*keys, "_slice", "first_ms", "last_ms", "lows", "adds", "fixed"]
    full = capacity * interval

    def run(batches):
        carry, held, level, first, last = None, None, None, 0, 0

        def closed():
            low, add, fixed = (list(x) for x in zip(*level.pieces, strict=True))
            return (*held, first, last, low, add, fixed)

        for pdf in batches:
            rows = []
            cols = [pdf[c].to_numpy() for c in [*keys, "_slice"]]
            starts = group_starts(cols, carry).tolist()
            for i, (now, takes) in enumerate(zip(pdf["_ms"].tolist(), pdf["_takes"].tolist(), strict=True)):
                if starts[i]:
                    if held is not None:
                        rows.append(closed())
                    held, level, first, last = tuple(c[i] for c in cols), LevelMap(interval, capacity), now, now
                if len(level.pieces) == 1 and level.pieces[0][2]:  # the entry no longer matters: plain numbers
                    there = min(full, level.pieces[0][1] + now - last)
                    level.pieces = [(0, there - interval if takes and there >= interval else there, True)]
                else:
                    level.refill(now - last)
                    if takes:
                        level.take()
                last = now
            if len(pdf):
                carry = tuple(c[-1] for c in cols)
            yield pd.DataFrame(rows, columns=names)
        if held is not None:
            yield pd.DataFrame([closed()], columns=names)

    return run


def _walk(keys: list[str], capacity_ms: int):
    """Per key, slices in order: the level at each slice's first request, before it takes."""
    def run(batches):
        carry, level, since = None, capacity_ms, 0
        for pdf in batches:
            starts = group_starts([pdf[k].to_numpy() for k in keys], carry).tolist()
            entries = []
            for i, (first, last, lows, adds, fixed) in enumerate(zip(pdf["first_ms"].tolist(), pdf["last_ms"].tolist(), pdf["lows"], pdf["adds"], pdf["fixed"],
                                                                     strict=True)):
                entry = capacity_ms if starts[i] else min(capacity_ms, level + first - since)
                entries.append(entry)
                level, since = applied(lows, adds, fixed, entry), last
            if len(pdf):
                carry = tuple(pdf[k].iloc[-1] for k in keys)
            out = pdf[[*keys, "_slice", "first_ms"]].copy()
            out["entry"] = entries
            yield out

    return run


def slice_entries(requests: DataFrame, keys: Sequence[str], tie: str, interval: int, capacity: int) -> DataFrame:
    """``(keys, _slice, first_ms, entry)``: of every (key, slice) its first request's time and the level before it.

    ``requests`` has the keys, ``_slice`` (a time slice of ``_ms``, the request's time), ``_takes`` (does it ask for a
    token?) and ``tie``, the order of requests at one time. A key's bucket is full before its first request.
    """
    keys = list(keys)
    types = dict(requests.dtypes)
    head = ", ".join(f"`{k}` {types[k]}" for k in keys)
    maps = sorted_fold(requests.select(*keys, "_slice", "_ms", "_takes", tie), [*keys, "_slice"], ["_ms", tie],
                       _maps(keys, interval, capacity), f"{head}, _slice bigint, {MAP_COLUMNS}")
    return sorted_fold(maps, keys, ["_slice"], _walk(keys, capacity * interval), f"{head}, _slice bigint, first_ms bigint, entry bigint")
