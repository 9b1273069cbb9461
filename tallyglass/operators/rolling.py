"""Order statistics of moving windows: a series in a task, one sorted window going along it.

A series of a ticker is bounded by the calendar (a few thousand bars). Built-in
windows would gather and sort a list for every bar; here a bar enters and one leaves
a sorted window, and medians are looked up where they are asked for.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


class SortedWindow:
    """Values in order; NaN is no value."""

    def __init__(self, values=()):
        self.values = sorted(v for v in values if v == v)

    def __len__(self) -> int:
        return len(self.values)

    def add(self, value: float) -> None:
        if value == value:
            insort(self.values, value)

    def remove(self, value: float) -> None:
        if value == value:
            del self.values[bisect_left(self.values, value)]

    def lower_median(self) -> float:
        return self.values[(len(self.values) - 1) // 2]

    def median(self) -> float:
        """The true median; 0 without values."""
        n = len(self.values)
        return (self.values[(n - 1) // 2] + self.values[n // 2]) / 2 if n else 0.0


def lower_medians(values: np.ndarray, window: int, least: int = 1) -> np.ndarray:
    """The lower median of the last ``window`` places up to each; NaN where fewer than ``least`` of them have a value."""
    plain, held, out = values.tolist(), SortedWindow(), np.full(len(values), np.nan)
    for i, v in enumerate(plain):
        if i >= window:
            held.remove(plain[i - window])
        held.add(v)
        if len(held) >= least:
            out[i] = held.lower_median()
    return out


def spikes(adj: np.ndarray, vol: np.ndarray, window: int = 30, limit: float = 3.0) -> tuple[np.ndarray, np.ndarray]:
    """Whether each bar is a spike, and the median of its neighbours (NaN where it was not tested).

    See ``series.spike_candidates``. The mean log of the neighbours is a difference of
    running sums; medians are for the few bars that are far from it.
    """
    n = len(adj)
    out, middle = np.zeros(n, bool), np.full(n, np.nan)
    if n < 5:
        return out, middle
    ln = np.zeros(n)
    ln[adj > 0] = np.log(adj[adj > 0])
    total, at = np.concatenate([[0.0], np.cumsum(ln)]), np.arange(n)
    lo, hi = np.maximum(0, at - window), np.minimum(n - 1, at + window)
    far = np.abs(ln - (total[hi + 1] - total[lo] - ln) / np.maximum(hi - lo, 1)) >= log(1.25)
    tested = far & (at - lo >= 3) & (hi - at >= 3)
    prices, volumes = adj.tolist(), np.where(vol > 0, vol, np.nan).tolist()
    for i in np.flatnonzero(tested).tolist():
        a, b = int(lo[i]), int(hi[i]) + 1
        left, right = SortedWindow(prices[a:i]), SortedWindow(prices[i + 1 : b])
        m = middle[i] = SortedWindow(left.values + right.values).median()
        if not m > 0:
            continue
        before, after = left.median(), right.median()
        if before > 0 and after > 0 and max(before, after) / min(before, after) > limit:
            continue  # a new level
        off = max(prices[i] / m, m / prices[i]) if prices[i] > 0 else np.inf
        if off > limit:
            usual = SortedWindow(volumes[a:i] + volumes[i + 1 : b]).median() if off < 10 else 0.0
            out[i] = not (usual > 0 and volumes[i] > 1.5 * usual)
    return out, middle


def without_spikes(adj: np.ndarray, vol: np.ndarray, window: int = 30, limit: float = 3.0, passes: int = 3) -> np.ndarray:
    """The places of the bars that stay after some passes: a spike beside another shows once that is gone."""
    left = np.arange(len(adj))
    for _ in range(passes):
        gone, _ = spikes(adj[left], vol[left], window, limit)
        if not gone.any():
            break
        left = left[~gone]
    return left


def numbers(table: pa.Table, name: str) -> np.ndarray:
    """A column as doubles; null is NaN."""
    return table[name].cast(pa.float64()).to_numpy(zero_copy_only=False) if table[name].null_count else table[name].to_numpy()


def by_series(bars: DataFrame, f: Callable[[pa.Table], pa.Table], schema: StructType | str, by: str = "ticker", day: str = "d") -> DataFrame:
    """``f`` of each series, its rows in order of day."""
    return bars.groupBy(by).applyInArrow(lambda rows: f(rows.sort_by(day)), schema)
