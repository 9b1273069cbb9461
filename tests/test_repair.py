"""The repair chain on Spark against plain loops, on series that need every step."""

import datetime as dt
import random

import numpy as np
import pytest

from tallyglass.operators import repair
from tests import folds

DAY = dt.date(1970, 1, 1)
BARS, SPLITS, HOLDERS = "ticker string, d date, close double, adj double, vol double", "ticker string, d date, ratio double", "ticker string, start date, end date"
day = lambda n: None if n is None else DAY + dt.timedelta(days=int(n))


def broken_series(r):
    """A random walk with splits that were missed, a change of holder, breaks, spikes and a frozen tail."""
    n = r.choice([1, 3, 24, 59, 60, 90, 200, 320])
    d = np.cumsum([r.choice([1, 1, 1, 3, r.choice([1, 40])]) for _ in range(n)])
    price = 20 * np.exp(np.cumsum([r.gauss(0, 0.02) for _ in range(n)]))
    vol = np.array([float(r.randrange(0, 2000)) for _ in range(n)])
    splits, start, end = [], None, None
    for _ in range(r.randrange(0, 5)):
        at, k = r.randrange(n), r.choice([0.02, 0.5, 2.0, 3.0, 0.7, 10.0])
        shift = r.choice([0, 0, 1, -2, 3])
        if r.random() < 0.8:
            price[:at] *= k * r.choice([1, 1, 1.1, 1.5])
        splits.append((int(d[at]) + shift, k))
    for _ in range(r.randrange(0, 3)):
        at = r.randrange(n)
        price[at:] *= r.choice([6, 8, 30])
        if r.random() < 0.4:
            vol[at:] *= 4
    if r.random() < 0.3:
        price[r.randrange(n)] *= 400
    if r.random() < 0.5:
        start = int(d[r.randrange(n)]) + r.choice([0, -1])
        end = int(d[-1]) - r.choice([0, 90, 91, 150, 10**4])
        end = max(end, start)
        if r.random() < 0.5:
            price[d >= start] *= 3
    if r.random() < 0.5 and n > 30:
        tail = r.choice([2, 5, 30])
        price[-tail:], vol[-tail:] = price[-tail], r.choice([0.0, 0.0, 900.0])
    return folds.Bars(d, np.round(price * 1.1, 4), np.round(price, 4), vol), splits, start, end


def run(spark, series, parts=3):
    bars, splits, holders = [], [], []
    for name, (s, marks, start, end) in series.items():
        bars += [(name, day(s.day[i]), float(s.close[i]), float(s.adj[i]), float(s.vol[i])) for i in range(len(s))]
        splits += [(name, day(a), float(k)) for a, k in marks]
        holders += [(name, day(start), day(end))] if start is not None else []
    random.Random(0).shuffle(bars)
    return repair.repair(spark.createDataFrame(bars, BARS).repartition(parts), spark.createDataFrame(splits, SPLITS), spark.createDataFrame(holders, HOLDERS))


def test_chain_against_loops(spark):
    r = random.Random(5)
    series = {f"T{k}": broken_series(r) for k in range(400)}
    got = {}
    for x in run(spark, series).collect():
        got.setdefault(x.ticker, []).append(x)
    steps = dict.fromkeys(repair.COUNTS, 0)
    for name, (s, marks, start, end) in series.items():
        want = folds.repair(s, marks, start, end)
        rows = sorted(got.get(name, []), key=lambda x: x.d)
        assert [(x.d, x.close, x.adj, x.vol) for x in rows] == [(day(a), *map(float, b)) for a, *b in zip(want.day, want.close, want.adj, want.vol)], name
        if rows:
            assert [rows[0][f"n_{c}"] for c in repair.COUNTS] == [want.counts.get(c, 0) for c in repair.COUNTS], name
        for c in repair.COUNTS:
            steps[c] += bool(want.counts.get(c))
    assert all(n >= 5 for n in steps.values()), steps


@pytest.mark.parametrize(
    "prices, vols, splits, holder, first, counts",
    [
        ([5.6] * 10 + [255] * 10, [500_000] * 20, [(10, 0.02)], None, (280, 10000), {"splits": 1}),
        ([50] * 20, None, [(10, 0.5)], None, (50, 1000), {}),
        ([0.12] * 60 + [31] * 60, None, [], (60, 10**6), (31, 1000), {"head": 60}),
        ([30] * 120, None, [], (60, 10**6), (30, 1000), {}),
        ([0.33] * 45 + [23] * 45, None, [], None, (23, 1000), {"break": 45}),
        ([17] * 45 + [102] * 45, [1000] * 45 + [20000] * 45, [], None, (17, 1000), {}),
        ([0.33] * 45 + [23] * 45, None, [(45, 1.0)], None, (0.33, 1000), {}),
        (list(range(100, 140)) + [139] * 30, [1000] * 40 + [0] * 30, [], None, (100, 1000), {"frozen": 30}),
    ],
)
def test_steps(spark, prices, vols, splits, holder, first, counts):
    x = np.array(prices, float)
    s = folds.Bars(np.arange(len(x)), x, x.copy(), np.array(vols or [1000] * len(x), float))
    rows = sorted(run(spark, {"A": (s, splits, *(holder or (None, None)))}).collect(), key=lambda x: x.d)
    assert (rows[0].adj, rows[0].vol) == first
    assert {c: rows[0][f"n_{c}"] for c in repair.COUNTS if rows[0][f"n_{c}"]} == counts


def test_odd_rows(spark):
    ok = [("A", day(i), 10.0 + i % 3, 10.0 + i % 3, 100.0) for i in range(40)]
    odd = [(None, day(1), 1.0, 1.0, 1.0), ("A", None, 1.0, 1.0, 1.0), ("A", day(5), 1.0, None, 1.0), ("A", day(6), 1.0, float("nan"), 1.0), ("B", day(1), None, 7.0, None), ("C", day(1), 2.0, 3.0, 1.0), ("C", day(1), 2.0, 2.0, 1.0)]
    splits = [("A", None, 2.0), ("A", day(3), None), ("A", day(3), -1.0), (None, day(3), 2.0), ("Z", day(3), 2.0)]
    holders = [("A", None, day(3)), ("A", day(0), None), (None, day(0), day(1)), ("B", day(-9), day(-5))]
    extra = spark.createDataFrame([(*x, "z") for x in ok + odd], BARS + ", i string")
    out = repair.repair(extra, spark.createDataFrame(splits, SPLITS), spark.createDataFrame(holders, HOLDERS))
    assert out.columns == ["ticker", "d", "close", "adj", "vol", *[f"n_{c}" for c in repair.COUNTS]]
    got = sorted(((x.ticker, x.d, x.close, x.adj, x.vol) for x in out.collect()), key=str)
    assert got == sorted([*ok, ("B", day(1), None, 7.0, 0.0), ("C", day(1), 2.0, 2.0, 1.0), ("C", day(1), 2.0, 3.0, 1.0)], key=str)
    assert repair.repair(extra.limit(0), spark.createDataFrame(splits, SPLITS), spark.createDataFrame(holders, HOLDERS)).count() == 0
