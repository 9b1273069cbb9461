"""The repair of a series as plain loops over numpy arrays: what the joins and windows are held against."""

from __future__ import annotations

from dataclasses import dataclass, field
from math import log

import numpy as np

from tallyglass.operators.rolling import without_spikes


@dataclass
class Bars:
    """One series in order of day; ``day`` counts from 1970-01-01."""

    day: np.ndarray
    close: np.ndarray
    adj: np.ndarray
    vol: np.ndarray
    counts: dict = field(default_factory=dict)

    def take(self, which) -> Bars:
        return Bars(self.day[which], self.close[which], self.adj[which], self.vol[which], self.counts)

    def count(self, name: str, n: int) -> None:
        self.counts[name] = self.counts.get(name, 0) + int(n)

    def __len__(self) -> int:
        return len(self.day)


def _lower_median(x: np.ndarray) -> float:
    return float(np.sort(x)[(len(x) - 1) // 2]) if len(x) else 0.0


def _positive(x: np.ndarray) -> np.ndarray:
    return x[x > 0]


def drop_spikes(s: Bars, window: int = 30, limit: float = 3.0, passes: int = 3) -> Bars:
    """Remove bars far from their neighbours, in up to three passes; see ``series.spike_candidates``."""
    left = without_spikes(s.adj, s.vol, window, limit, passes)
    if len(left) < len(s):
        s.count("spikes", len(s) - len(left))
    return s.take(left)


def apply_missed_splits(s: Bars, splits: list[tuple[int, float]], tolerance: float = 0.25, around: int = 3) -> Bars:
    """Rescale what lies before a split that the series was not adjusted for.

    A split matters if its ratio is at most a half or at least two. Among the
    bars around its day the step that best undoes it is sought; the ratio itself
    is used where it fits, else the step.
    """
    if not len(s):
        return s
    close, adj, vol = s.close.copy(), s.adj.copy(), s.vol.copy()
    for day, k in sorted(splits):
        at = int(np.searchsorted(s.day, day))
        if not k > 0 or 0.5 < k < 2 or at == 0 or at == len(s):
            continue
        near = np.arange(max(1, at - around), min(len(s) - 1, at + around) + 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            step = adj[near] / adj[near - 1]
        near, step = near[step > 0], step[step > 0]
        if not len(near):
            continue
        miss = np.abs(np.log(step * k))
        j = int(np.argmin(miss))
        if miss[j] > log(2) or abs(log(step[j])) < log(1.8):
            continue
        f = k if miss[j] <= tolerance else 1 / step[j]
        old = slice(0, near[j])
        close[old] = np.floor(close[old] / f * 1e4 + 0.5) / 1e4
        adj[old] = np.floor(adj[old] / f * 1e4 + 0.5) / 1e4
        vol[old] = np.floor(vol[old] * f + 0.5)
        s.count("splits", 1)
    return Bars(s.day, close, adj, vol, s.counts)


def clip_to_holder(s: Bars, start: int | None, end: int | None, gap: int = 30, jump: float = 2.0, overhang: int = 90) -> Bars:
    """Keep what belongs to the present holder of the symbol, whose interval is given (None: unknown)."""
    if not len(s) or start is None:
        return s
    if end < s.day[-1] - overhang:
        keep = s.day <= end
        s.count("tail", (~keep).sum())
        s = s.take(keep)
    b = int(np.searchsorted(s.day, start))
    if 0 < b < len(s):
        a, c = s.adj[b - 1], s.adj[b]
        moved = max(a / c, c / a) if a > 0 and c > 0 else 1.0
        if s.day[b] - s.day[b - 1] >= gap or moved >= jump:
            s.count("head", b)
            s = s.take(slice(b, None))
    return s


def cut_at_break(s: Bars, split_days: set[int], step: float = 5.0, level: float = 4.0, volume: float = 1.5) -> Bars:
    """Drop all before the last upward break: a step of five times that the level keeps, without a surge in volume."""
    if len(s) < 60:
        return s
    start = 0
    with np.errstate(divide="ignore", invalid="ignore"):
        steps = s.adj[1:] / s.adj[:-1]
    for i in np.flatnonzero(steps >= step) + 1:
        if i < 30 or i >= len(s) - 10 or int(s.day[i]) in split_days:
            continue
        left, right = slice(max(start, i - 30), i), slice(i, i + 30)
        if i - left.start < 10:
            continue
        a, b = _lower_median(s.adj[left]), _lower_median(s.adj[right])
        if not (a > 0 and b > 0 and b / a >= level):
            continue
        va, vb = _lower_median(_positive(s.vol[left])), _lower_median(_positive(s.vol[right]))
        if not (va > 0 and vb > 0 and vb / va > volume):
            start = int(i)
    if start:
        s.count("break", start)
        s = s.take(slice(start, None))
    return s


def trim_frozen_tail(s: Bars, least: int = 5) -> Bars:
    """Cut a tail of one repeated price and almost no volume back to its first bar."""
    if len(s) < least + 20:
        return s
    moved = np.flatnonzero(s.adj[:-1] != s.adj[-1])
    first = int(moved[-1]) + 1 if len(moved) else 0
    run = len(s) - first
    usual = _positive(s.vol[max(0, first - 60) : first])
    if run < least or not len(usual) or _positive(s.vol[first + 1 :]).sum() > 0.01 * _lower_median(usual) * run:
        return s
    s.count("frozen", run - 1)
    return s.take(slice(0, first + 1))


def repair(s: Bars, splits: list[tuple[int, float]], start: int | None, end: int | None) -> Bars:
    """All steps in order; of breaks none lies on the day of a known split."""
    s = clip_to_holder(apply_missed_splits(drop_spikes(s), splits), start, end)
    return trim_frozen_tail(cut_at_break(s, {d for d, _ in splits}))
