"""Small fixtures with known results for what the star schema can't exercise."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyglass.functions import scalars as S
from tallyglass.operators import filings, gates, owners, panel, positions, published, repair, series, slices, stats
from tallyglass.operators.components import connected_components
from tests import folds
from tests.folds import Bars

DAY = dt.date(2020, 1, 1)


def bars(prices, vols=None, start=0):
    n = len(prices)
    x = np.array(prices, float)
    return Bars(np.arange(start, start + n), x, x.copy(), np.array(vols if vols is not None else [1000] * n, float))


# --- repair ------------------------------------------------------------------------------------------------------


def test_spikes():
    assert len(folds.drop_spikes(bars([10] * 5 + [8000] + [10] * 6))) == 11
    assert len(folds.drop_spikes(bars([10] * 6 + [60] * 6))) == 12  # a new level
    block = bars([40] * 50 + [15000] * 16 + [40] * 54, [500] * 120)
    assert len(folds.drop_spikes(block)) == 104
    for price, vol, gone in ((70, 2e7, 0), (70, 5e5, 1), (2800, 2e6, 1)):
        v = [1e6] * 60
        v[30] = vol
        assert len(folds.drop_spikes(bars([10] * 30 + [price] + [10] * 29, v))) == 60 - gone


def test_splits():
    s = folds.apply_missed_splits(bars([5.6] * 10 + [255] * 10, [500_000] * 20), [(10, 0.02)])
    assert (s.adj[0], s.vol[0], s.counts["splits"]) == (280, 10000, 1)
    assert not folds.apply_missed_splits(bars([50] * 20), [(10, 0.5)]).counts
    late = folds.apply_missed_splits(bars([0.112] * 10 + [10.8] * 10), [(12, 0.0067)])
    assert late.counts["splits"] == 1 and abs(late.adj[0] - 10.8) < 6.1


def test_clip_break_frozen():
    assert folds.clip_to_holder(bars([0.12] * 60 + [31] * 60), 60, 10**6).counts["head"] == 60
    assert not folds.clip_to_holder(bars([30] * 120), 60, 10**6).counts
    assert folds.clip_to_holder(bars([30] * 300), 0, 100).counts["tail"] > 0
    assert folds.cut_at_break(bars([0.33] * 45 + [23] * 45), set()).counts["break"] == 45
    assert not folds.cut_at_break(bars([17] * 45 + [102] * 45, [1000] * 45 + [20000] * 45), set()).counts
    assert not folds.cut_at_break(bars([10] * 45 + [1.5] * 45), set()).counts
    assert not folds.cut_at_break(bars([0.33] * 45 + [23] * 45), {45}).counts
    rising = list(range(100, 140)) + [139] * 30
    assert folds.trim_frozen_tail(bars(rising, [1000] * 40 + [0] * 30)).counts["frozen"] == 30
    assert not folds.trim_frozen_tail(bars([139] * 10)).counts


def test_repair_does_not_depend_on_row_order(spark):
    r = random.Random(1)
    rows = [(t, DAY + dt.timedelta(days=i), *(2 * [10.0 + r.random() + (9000 if i == 70 else 0)]), 1000.0) for t in (1, 2) for i in range(150)]
    schema = "ticker long, d date, close double, adj double, vol double"
    outs = []
    for parts in (1, 7):
        r.shuffle(rows)
        outs.append(sorted(map(tuple, repair.repair(spark.createDataFrame(rows, schema).repartition(parts)).collect())))
    assert outs[0] == outs[1] and len(outs[0]) == 298 and outs[0][0][5] == 1
    again = repair.repair(spark.createDataFrame([x[:5] for x in outs[0]], schema)).collect()
    assert len(again) == 298 and all(x.n_spikes == 0 for x in again)


def test_splice_and_guard(spark):
    schema = "ticker string, d date, adj double"
    old = spark.createDataFrame([("A", DAY + dt.timedelta(days=i), 1.0) for i in range(3)] + [("B", DAY, 1.0)] * 4, schema)
    new = spark.createDataFrame([("A", DAY + dt.timedelta(days=i), 2.0) for i in (1, 3)] + [("B", DAY, 2.0)], schema)
    assert sorted(x.adj for x in repair.splice(old.where("ticker = 'A'"), new.where("ticker = 'A'")).collect()) == [1, 2, 2]
    assert sorted((x.ticker, x.adj) for x in repair.guarded(old, new).collect()) == [("A", 2), ("A", 2)] + [("B", 1)] * 4


# --- scalars, owners, gates --------------------------------------------------------------------------------------


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_scalars(spark):
    day = lambda s: F.lit(s).cast("date")
    r = one(
        spark, a=S.rnd(F.lit(-2.5), 0), b=S.filing_date(F.lit("27-DEC-2024")), c=S.iso_date(F.lit("2026-06-31")), d=S.to_number(F.lit("Infinity")), e=S.to_number(F.lit("1.5")),
        f=S.to_number(F.lit("")), g=S.business_days(day("2024-03-01"), day("2024-03-05")), h=S.business_days(day("2024-03-05"), day("2024-03-01")), i=S.iso_week(day("2021-01-03")),
        j=S.role_letters(F.lit("Officer"), F.lit("Chief Financial Officer")), k=S.role_letters(F.lit("TenPercentOwner"), F.lit("")), m=S.role_letters(F.lit(""), F.lit("")),
        n=S.footnote_ids(F.lit("F1, F2"), F.lit("F2 F3"), F.lit(None).cast("string")), o=S.quote_symbols(F.lit(" b,A,a,!!,B "), 5), p=S.iso_date(F.lit("2026-6-1")),
        q=S.plausible_ticker(F.lit(None).cast("string")), r=S.csv_symbol(F.lit("BRK.B")), s=S.chart_symbol(F.lit("BRK.B")), t=S.adv_bucket(F.lit(None).cast("double")),
        u=S.drawdown_label(F.lit(-0.05)), v=S.file_name(F.lit("A/B")),
    )
    assert (r.a, str(r.b), r.c, r.d, r.e, r.f, r.g, r.h, r.i) == (-2, "2024-12-27", None, None, 1.5, None, 2, 0, "2020-W53")
    assert (r.j, r.k, r.m, r.n, r.o, r.p, r.q, r.r, r.s, r.t, r.u, r.v) == ("OF", "T", "X", ["F1", "F2", "F3"], ["A", "B"], None, False, "brk-b.us", "BRK-B", "н/д", "high", "A_B")


@pytest.mark.parametrize(
    "text, flag, want",
    [
        ("shares bought in a private placement", "offering", True), ("bought at the market price", "offering", False), ("at-the-market offering", "offering", True),
        ("The Reporting Person is not an underwriter of the offering", "offering", False), ("Rule 10b5-1 plan", "b5", True), ("dividend reinvestment", "drip", True),
        ("the ESPP", "espp", True), ("margin call", "forced", True), ("pledged shares", "pledge", True), ("prices ranging from 1 to 2", "wavg", True), ("by his wife", "trust", True),
    ],
)
def test_footnotes(spark, text, flag, want):
    assert one(spark, x=S.footnote_flags(F.lit(text))[flag]).x is want


def test_owner_names_and_growth(spark):
    people = lambda *names: F.array(*[F.struct(F.lit(n).alias("name"), F.lit("D").alias("rel")) for n in names])
    r = one(spark, a=S.fund_only(people("Alpha Capital LP", "Beta LLC")), b=S.fund_only(people("Alpha Capital LP", "Doe Jane")), c=S.primary_owner(people("Fund I LP", "Doe Jane"))["name"], d=S.top_role(people("x")))
    assert (r.a, r.b, r.c, r.d) == (True, False, "Doe Jane", "D")
    n = lambda x: F.lit(x).cast("double")
    cases = [((100, 1100, False, None, None), 0.1), ((100, 100, False, None, None), 9.99), ((500, None, True, 100, 1100), 0.1), ((100, 50, False, None, None), None), ((100, None, False, None, None), None)]
    for (sh, own, mixed, shd, ownd), want in cases:
        assert one(spark, x=S.ownership_growth(n(sh), n(own), F.lit(mixed), n(shd), n(ownd))).x == want


def test_behaviour(spark):
    d = dt.date.fromisoformat

    def rows(history, day):
        trades = [(1, 1, d(x), c, v) for x, c, v in history] + [(1, 1, d(day), "P", 7.0)]
        df = spark.createDataFrame(trades, "owner long, ticker long, tdate date, code string, val double")
        asked = df.where(F.col("val") == 7.0)
        x = owners.with_regular(owners.with_past(df)).where(F.col("val") == 7.0).first()
        return x, owners.typical_purchase(asked, df).first().typical

    r, typical = rows([(f"{y}-03-05", "P", 100.0) for y in (2017, 2018, 2019)], "2020-03-20")
    assert (r.routine, r["first"], typical) == (True, None, 100)
    assert rows([("2017-03-05", "P", 1.0), ("2018-04-05", "P", 1.0), ("2019-03-05", "P", 1.0)], "2020-03-20")[0].routine is False
    assert rows([("2019-03-05", "P", 1.0)], "2020-03-20")[0].routine is None and rows([], "2020-03-20")[0].routine is None
    assert rows([(f"2020-0{m}-10", "P", 1.0) for m in (1, 2, 3, 4)], "2020-05-10")[0].regular is True
    assert rows([("2020-01-10", "P", 1.0), ("2020-01-12", "P", 1.0), ("2020-04-10", "P", 1.0)], "2020-05-10")[0].regular is False
    assert rows([(f"2020-0{m}-10", "P", 1.0) for m in (1, 2, 2, 3, 4)], "2020-05-10")[0].regular is False  # twice on a day
    assert rows([("2016-01-10", "P", 1.0), ("2019-12-10", "S", 1.0)], "2020-05-10")[0]["first"] == "first-in-3y"
    assert rows([("2019-12-10", "S", 1.0)], "2020-05-10")[0]["first"] == "first-ever" and rows([], "2020-05-10")[0]["first"] is None


def test_past_of_null_keys_and_one_huge_owner(spark):
    none = spark.createDataFrame([(None, 1, dt.date(2020, 1, 1), "P"), (1, 1, None, "P")], "owner long, ticker long, tdate date, code string")
    assert [(r.routine, r["first"], r.regular) for r in owners.with_regular(owners.with_past(none)).collect()] == [(None, None, False)] * 2
    day = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 7000).cast("int"))
    huge = spark.range(200_000).select(F.lit(1).alias("owner"), (F.col("id") % 5).alias("ticker"), day.alias("tdate"), F.lit("P").alias("code"))
    x = owners.with_regular(owners.with_past(huge))
    assert x.agg(F.count("*"), F.count_if("routine"), F.count_if("regular"), F.max("first")).first() == (200_000, x.where(F.year("tdate") >= 2003).count(), 0, None)


def test_sync_of_owner_groups(spark):
    rows = [(o, "A", DAY, p) for o, p in ((1, 5.0), (2, 5.0), (3, 5.0), (4, 6.0), (5, None), (6, 0.0))]
    t = spark.createDataFrame(rows, "owner long, ticker string, tdate date, px double")
    groups = spark.createDataFrame([(1, 1), (2, 1)], "node long, component long")
    sync = lambda g: {r.owner: r.sync for r in owners.sync_count(t, g).collect()}
    assert sync(None) == {1: 3, 2: 3, 3: 3, 4: 1, 5: 1, 6: 1} and sync(groups) == {1: 2, 2: 2, 3: 2, 4: 1, 5: 1, 6: 1}


def slow_spikes(adj, vol, window=30, limit=3.0):
    """One pass by the definition: medians of lists of neighbours."""
    n, gone = len(adj), set()
    for i in range(n if n >= 5 else 0):
        left, right = adj[max(0, i - window) : i], adj[i + 1 : i + 1 + window]
        volumes = [v for v in (*vol[max(0, i - window) : i], *vol[i + 1 : i + 1 + window]) if v > 0]
        log = lambda x: np.log(x) if x > 0 else 0.0
        if min(len(left), len(right)) < 3 or abs(log(adj[i]) - np.mean([log(x) for x in (*left, *right)])) < np.log(1.25):
            continue
        a, b, m = np.median(left), np.median(right), np.median([*left, *right])
        if (min(a, b) > 0 and max(a, b) / min(a, b) > limit) or not m > 0:
            continue
        off = max(adj[i] / m, m / adj[i]) if adj[i] > 0 else np.inf
        usual = np.median(volumes) if volumes else 0.0
        if off > limit and not (off < 10 and usual > 0 and vol[i] > 1.5 * usual):
            gone.add(i)
    return gone


def test_spike_passes_against_the_definition(spark):
    r = np.random.default_rng(4)
    rows = []
    for t in range(4):
        p = 40 * np.exp(np.cumsum(r.normal(0, 0.02, 200)))
        p[r.integers(0, 200, 25)] *= r.choice([0.05, 8, 50], 25)
        p[r.integers(0, 200, 2)] = 0
        rows += [(t, DAY + dt.timedelta(days=i), float(x), float(x), float(v)) for i, (x, v) in enumerate(zip(p, r.integers(0, 3000, 200)))]
    rows += [(9, DAY + dt.timedelta(days=i), 1.0, 1.0 + 99 * (i == 2), None) for i in range(4)]
    df = spark.createDataFrame(rows, "ticker long, d date, close double, adj double, vol double")
    kept = {(x.ticker, x.d) for x in series.drop_spikes(df).collect()}
    once = {(x.ticker, x.d) for x in series.spike_candidates(df).where("spike").collect()}
    want, first = set(), set()
    for t in (0, 1, 2, 3, 9):
        own = [x for x in rows if x[0] == t]
        for turn in range(3):
            gone = slow_spikes([x[3] for x in own], [x[4] or 0.0 for x in own])
            first |= {(t, own[i][1]) for i in gone} if not turn else set()
            own = [x for i, x in enumerate(own) if i not in gone]
        want |= {(t, x[1]) for x in own}
    assert kept == want and len(kept) < 790 and once == first


def test_moving_windows_against_lists(spark):
    from tallyglass.operators import rolling

    r = np.random.default_rng(6)
    values = r.integers(0, 9, 300).astype(float)
    values[r.integers(0, 300, 80)] = np.nan
    for window, least in ((1, 1), (7, 3), (60, 15), (400, 1)):
        got = rolling.lower_medians(values, window, least)
        for i in range(300):
            own = sorted(v for v in values[max(0, i - window + 1) : i + 1] if v == v)
            assert np.isnan(got[i]) if len(own) < least else got[i] == own[(len(own) - 1) // 2]
    days = np.cumsum(r.integers(1, 40, 600))
    close = [None if i % 50 == 7 else float(x) for i, x in enumerate(r.integers(1, 500, 600))]
    bars_ = spark.createDataFrame([(t, DAY + dt.timedelta(days=int(d)), c, i) for t in "AB" for i, (d, c) in enumerate(zip(days, close))], "ticker string, d date, close double, i int")
    high = lambda lo, hi: max((c for c in close[lo:hi] if c is not None), default=None)
    dd = lambda c, h, i: None if i < 30 or not c or not h else float(np.floor((c / h - 1) * 1e4 + 0.5) / 1e4)
    got = {(x.ticker, x.i): x.dd for x in series.drawdown_bars(bars_).collect()}
    assert got == {(t, i): dd(close[i], high(max(0, i - 251), i + 1), i) for t in "AB" for i in range(600)}
    asked = sorted({int(x) for x in r.integers(-50, days[-1] + 500, 400)} | {int(days[40]) + 365, int(days[40]) + 366, 0})
    probes = spark.createDataFrame([("A", DAY + dt.timedelta(days=x)) for x in asked] + [("C", DAY)], "ticker string, tdate date")
    got = {(x.ticker, x.tdate): x.dd for x in series.drawdown_calendar(bars_, probes).collect()}
    for x in asked:
        last = int(np.searchsorted(days, x, "right")) - 1
        lo = int(np.searchsorted(days, x - 365))
        want = dd(close[last], high(lo, last + 1), last) if last >= 0 else None
        assert got["A", DAY + dt.timedelta(days=x)] == want, x
    assert got["C", DAY] is None


def test_interval_containment(spark):
    from tallyglass.operators import asof

    d = lambda n: DAY + dt.timedelta(days=n)
    spans = spark.createDataFrame([("A", d(0), d(10)), ("A", d(5), d(7)), ("A", d(12), d(20)), ("A", d(12), d(14))], "ticker string, start date, end date")
    probes = [("A", 0, 10), ("A", 6, 9), ("A", 6, 12), ("A", 12, 20), ("A", -1, 3), ("A", 21, 22), ("B", 1, 2)]
    p = spark.createDataFrame([(t, d(a), d(b)) for t, a, b in probes], "ticker string, a date, b date")
    got = {(r.ticker, (r.a - DAY).days, (r.b - DAY).days): r.covered for r in asof.covers(p, spans, "a", "b").collect()}
    assert [got[x] for x in probes] == [True, True, False, True, False, False, None]


def test_benchmark_by_bucket(spark):
    d = lambda n: DAY + dt.timedelta(days=n)
    b = spark.createDataFrame([(t, d(n), 100.0 + n, 100.0 + n, 1.0, n) for t in "AB" for n in range(80)], "ticker string, d date, close double, adj double, vol double, i int")
    t = spark.createDataFrame([("A", d(0), "small"), ("B", d(0), "large"), ("B", d(-30), "small")], "ticker string, fdate date, bucket string")
    bench, small = (spark.createDataFrame([(d(n), 100.0 + k * n) for n in range(80)], "d date, adj double") for k in (0.0, 1.0))
    out = {(r.ticker, r.bucket): r for r in series.forward_returns(t, b, bench, F.lit(d(80)), small=small).collect()}
    a, c, gone = out["A", "small"], out["B", "large"], out["B", "small"]
    assert a.r3 == a.x3 == c.e3 == pytest.approx(164 / 101 - 1, abs=1e-4) and a.e3 == 0.0 and a.s3 == "c" and a.s6 == "o" and a.matured is None
    assert gone.no_entry and gone.r3 is None and "e3" not in series.forward_returns(t, b, bench, F.lit(d(80))).columns


def test_writing_by_year(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *x: spark.createDataFrame([(a, dt.date(y, 5, 1) if y else None, v) for a, y, v in x], "acc string, tdate date, val int")
    have = lambda: sorted((r.acc, r.year, r.val) for r in published.stored(spark, path).collect())
    published.write_by_year(rows(("a", 2019, 1), ("b", 2020, 1), ("b", 2020, 1), ("old", 2009, 1), ("far", 2030, 1), ("none", None, 1)), path, ["acc"], last_year=2024)
    published.write_by_year(rows(("b", 2020, 2), ("c", 2020, 2)), path, ["acc"])
    assert have() == [("a", 2019, 1), ("b", 2020, 1), ("c", 2020, 2)]
    published.write_by_year(rows(("b", 2020, 3), ("d", 2021, 3)), path, ["acc"], replace=True)
    assert have() == [("a", 2019, 1), ("b", 2020, 3), ("c", 2020, 2), ("d", 2021, 3)]
    published.write_by_year(rows(), path, ["acc"])
    assert len(have()) == 4


def test_readers_see_a_change_whole_or_not(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = lambda *x: spark.createDataFrame([(a, dt.date(y, 5, 1), v) for a, y, v in x], "acc string, tdate date, val int")
    have = lambda: sorted((r.acc, r.year, r.val) for r in published.stored(spark, path).collect())
    assert published.stored(spark, path) is None and published.current(spark, path) == (0, {})
    published.write_by_year(rows(("a", 2019, 1), ("b", 2020, 1), ("c", 2021, 1)), path, ["acc"])
    before, held = have(), published.stored(spark, path)
    switch = published._switch

    def fail(*_):
        raise OSError("lost before the switch")

    monkeypatch.setattr(published, "_switch", fail)
    for change in (lambda: published.write_by_year(rows(("b", 2020, 2), ("d", 2021, 2)), path, ["acc"], replace=True), lambda: published.write_by_year(rows(("e", 2022, 2)), path, ["acc"]), lambda: published.purge(spark, path, F.col("val") > 5)):
        with pytest.raises(OSError):
            change()
        assert have() == before  # all was written, nothing shows
    monkeypatch.setattr(published, "_switch", switch)
    published.write_by_year(rows(("b", 2020, 2), ("d", 2021, 2)), path, ["acc"], replace=True)
    assert have() == [("a", 2019, 1), ("b", 2020, 2), ("c", 2021, 1), ("d", 2021, 2)]
    assert sorted((r.acc, r.year, r.val) for r in held.collect()) == before  # a reader that began before goes on
    assert [r.acc for r in published.stored(spark, path, [2020]).collect()] == ["b"]
    published.purge(spark, path, F.col("tdate") >= "2021-01-01")
    assert have() == [("c", 2021, 1), ("d", 2021, 2)]
    number, _ = published.current(spark, path)
    with pytest.raises(RuntimeError, match="meanwhile"):  # two writers
        published._switch(spark, path, number, {"years": {}})
    published.vacuum(spark, path)
    assert have() == [("c", 2021, 1), ("d", 2021, 2)] and published._numbers(spark, path) == [number]
    assert len(list((tmp_path / "t").glob("year=*/version=*"))) == 1
    published.purge(spark, path, F.lit(False))
    assert published.stored(spark, path) is None
    published.write_by_year(rows(("z", 2019, 9)), path, ["acc"])
    assert have() == [("z", 2019, 9)]


def test_pages_by_key_join_up(spark, tmp_path):
    r = random.Random(2)
    rows = [(r.choice([None, "a", "b", "c"]), r.choice([None, 1.0, 2.0, -3.0]), r.randrange(3)) for _ in range(157)]
    df = spark.createDataFrame(rows, "t string, v double, n long")
    for order in ([("v", True), ("t", False), ("n", False)], [("t", True), ("n", True), ("v", False)], [("n", False), ("t", False), ("v", True)]):
        table = slices.sorted_table(df, str(tmp_path / order[0][0]), order)
        want = [tuple(x) for x in df.orderBy(*slices.by_order(order)).collect()]
        for first, later in ((10, 20), (1, 50), (200, 1)):
            found, cursor = [], None
            while True:
                got = slices.page_after(table, order, first if cursor is None else later, cursor).collect()
                if not got:
                    break
                found += map(tuple, got)
                cursor = slices.cursor(got, order, cursor)
            assert found == want
    plan = slices.page_after(table, order, 5, {"key": (2, "b", 1.0), "seen": 1})._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "GreaterThanOrEqual(n,2)" in plan and "Exchange" not in plan


def test_tables_sorted_by_any_column(spark):
    df = spark.createDataFrame([("x", 2.0), ("y", None), ("z", -5.0)], "dim string, v double").withColumns({"grp": F.col("dim"), "hold": F.lit(3)})
    ids = lambda *a: "".join(r.dim for r in slices.sorted_by(df, *a, [F.desc("dim")]).collect())
    assert (ids("v", "desc"), ids("v", "asc"), ids("v", None), ids("dim", "asc")) == ("xzy", "yzx", "zyx", "xyz")
    same = df.withColumn("dim", F.lit("d"))
    assert "".join(r.grp for r in slices.ordered(same).collect()) == "xyz" and "".join(r.grp for r in slices.ordered(same, "v").collect()) == "xzy"


def test_queue_leaves_out_what_failed_often(spark):
    t = spark.createDataFrame([(c, "P", 10.0, DAY) for c in "ABC"], "ticker string, code string, val double, tdate date")
    failed = spark.createDataFrame([("A", 3), ("B", 2)], "ticker string, tries int")
    assert [r.ticker for r in slices.refresh_queue(t, t.limit(0).select("ticker"), 9, failed=failed).collect()] == ["B", "C"]


def test_gate_order(spark):
    base = {"code": "P", "px": 10.0, "val": 1000.0, "sh": 100.0, "sec": "Common", "di": "D", "close": 10.0, "hist_days": 500, "adv": 1e7, "sync": 1, "routine": False}
    flags = ["cancelled", "reassigned", "fn_offering", "fn_drip", "fn_wavg", "fund_only", "planned", "regular", "units", "no_liquidity", "no_price"]
    cases = [
        ({}, None), ({"reassigned": True, "sync": 5, "planned": True}, "reassigned"), ({"px": 2e5, "close": 2e5}, "badvalue"), ({"sec": "Series A Preferred"}, "security"),
        ({"fn_offering": True, "units": True}, "offering"), ({"hist_days": 19}, "newlisting"), ({"hist_days": None}, None), ({"val": 1e9, "adv": 1e6}, "capacity"), ({"px": 0.5}, "outlier"),
        ({"px": 9.1}, "discount"), ({"px": 9.1, "fn_wavg": True}, None), ({"px": 9.1, "code": "S"}, None), ({"px": 0.0}, None), ({"sync": 3}, "sync"), ({"fund_only": True, "planned": True}, "fund"),
        ({"planned": True, "routine": True}, "planned"), ({"routine": True, "regular": True}, "routine"), ({"regular": True}, "regular"), ({"cancelled": True, "px": 2e5}, "cancelled"), ({"no_liquidity": True}, "noliq"),
    ]
    schema = "i int, code string, px double, val double, sh double, sec string, di string, close double, hist_days int, adv double, sync int, routine boolean, " + ", ".join(f"{f} boolean" for f in flags)
    data = [(i, *[({**base, **dict.fromkeys(flags, False)} | c)[k] for k in [*base, *flags]]) for i, (c, _) in enumerate(cases)]
    out = {r.i: r for r in gates.apply_gates(spark.createDataFrame(data, schema)).collect()}
    assert {i: r.drop for i, r in out.items()} == {i: w for i, (_, w) in enumerate(cases)}
    bare = gates.apply_gates(spark.createDataFrame([("I", 10.0)], "di string, px double")).first()
    assert bare.ok and bare.tags == ["indirect", "no-history"] and out[1].tags == []


def test_co_filers(spark):
    f = lambda *o: ([{"cik": c, "name": n} for c, n in o],)
    rows = [f((1, "Ann A"), (2, "Bob B"), (10, "Fund LP")), f((10, "Fund LP"), (11, "GP LLC"), (3, "Cat C")), f((2, "Bob B"), (4, "Dan D")), f((None, "x"), (5, "Eve E"))]
    out = owners.owner_groups(spark.createDataFrame(rows, "owners array<struct<cik:long,name:string>>"))
    assert {r.node: r.component for r in out.collect()} == {1: 1, 2: 1, 4: 1, 10: 10, 11: 10}


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(1, 80)] + [(None, 3), (7, 7)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    out = connected_components(spark.createDataFrame(edges, "src long, dst long"))
    assert {x.node: x.component for x in out.collect()} == {n: find(n) for n in root}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_dedup_and_upserts(spark):
    cols = "acc string, form string, fdate string, owner long, val double"
    rows = [("A2", "4", "2020-02-05", 1, 5.0), ("A2R", "4/A", "2020-02-06", 1, 6.0), ("B", "4", "2020-02-07", 2, 7.0), ("B", "4", "2020-02-07", 2, 8.0)]
    out = filings.deduplicate(spark.createDataFrame(rows, cols), ["acc"], ["owner"], F.col("val")).collect()
    assert sorted((r.acc, r.val, r.versions) for r in out) == [("A2R", 6, 2), ("B", 7, 1)]
    old, new = spark.createDataFrame([("k", 1)], "k string, v int"), spark.createDataFrame([("k", 2), ("m", 3), ("m", 3)], "k string, v int")
    assert [r.v for r in filings.insert_absent(old, new, ["k"]).collect()] == [3]
    assert sorted(r.v for r in filings.replace_present(old, new, ["k"]).collect()) == [2, 3]


# --- panel and statistics ----------------------------------------------------------------------------------------


def test_portfolio(spark):
    ms = [f"2020-{m:02d}" for m in range(1, 5)]
    rows = [(t, m, 100.0 * g**i, dv) for t, g, dv in (("A", 1.1, 5e6), ("B", 0.9, 5e6), ("THIN", 3.0, 10.0)) for i, m in enumerate(ms)]
    rets = panel.with_returns(spark.createDataFrame(rows, "ticker string, m string, px double, dv double"))
    sig = spark.createDataFrame([(t, "2020-01") for t in ("A", "B", "THIN")], "ticker string, m string")
    out = panel.portfolio(rets, sig, 12, 1e6, 2).orderBy("m").collect()
    assert [(r.m, r.n) for r in out] == [("2020-02", 2), ("2020-03", 2), ("2020-04", 2)] and abs(out[0].r) < 1e-12
    assert panel.portfolio(rets, sig, 1, 1e6, 2).count() == 1
    gap = panel.with_returns(spark.createDataFrame([("A", "2020-01", 1.0, 1.0), ("B", "2020-02", 1.0, 1.0), ("A", "2020-03", 2.0, 1.0)], "ticker string, m string, px double, dv double"))
    assert all(r.ret is None for r in gap.collect())  # a missing month is no return


def test_turnover_of_alternating_names(spark):
    ms = [f"20{y:02d}-{m:02d}" for y in (18, 19) for m in range(1, 13)]
    rets = panel.with_returns(spark.createDataFrame([(t, m, 10.0, 1e7) for t in "AB" for m in ms], "ticker string, m string, px double, dv double"))
    sig = spark.createDataFrame([("AB"[i % 2], m) for i, m in enumerate(ms)], "ticker string, m string")
    assert panel.turnover(rets, sig, 1).first().turnover == 2.0


def test_statistics(spark):
    r = np.random.default_rng(5)
    n = 60
    market, size, mom = (r.normal(0.01, 0.04, n) for _ in range(3))
    ms = [f"{2015 + i // 12}-{i % 12 + 1:02d}" for i in range(n)]
    ret = market + 0.005
    rows = [(m, i, float(x), 10) for i, (m, x) in enumerate(zip(ms, ret))]
    s = spark.createDataFrame(rows, "m string, k int, r double, n int")
    f = spark.createDataFrame([(m, float(a), float(b), float(c)) for m, a, b, c in zip(ms, market, size, mom)], "m string, market double, size double, momentum double")
    a = stats.factor_alpha(s, f, ["market", "size", "momentum"]).first()
    assert abs(a.beta_market - 1) < 0.02 and abs(a.alpha - 0.005) < 0.0005 and a.months == 60
    b = stats.one_factor_alpha(s, f.select("m", F.col("market").alias("r"))).first()
    assert abs(b.beta - 1) < 1e-6 and abs(b.alpha - 0.005) < 1e-6
    v = stats.versus(s, f.select("m", F.col("market").alias("r"))).first()
    assert abs(v.ex - 0.005) < 1e-9 and v.ir > 100
    t = stats.newey_west(s).first()
    e = ret - ret.mean()
    mean, want = ret.mean(), ret.mean() / np.sqrt((e @ e / n + sum(2 * (1 - i / 4) * (e[i:] @ e[:-i]) / n for i in (1, 2, 3))) / n)
    assert t.mean == pytest.approx(mean) and t.t == pytest.approx(want)
    assert stats.newey_west(s.where("k < 11")).first().t is None
    p = stats.path(s).first()
    eq = np.cumprod(1 + ret)
    assert p.cagr == pytest.approx(eq[-1] ** (12 / n) - 1) and p.vol == pytest.approx(ret.std(ddof=1) * 12**0.5)
    assert p.dd == pytest.approx(min(0, (eq / np.maximum(1, np.maximum.accumulate(eq)) - 1).min())) and p.avg_n == 10
    assert stats.factor_alpha(s.where("k < 20"), f, ["market"]).count() == 0


def test_regression_by_normal_equations(spark):
    """Against least squares of another library, by group; factors that depend on each other give no row."""
    r = np.random.default_rng(8)
    rows, want = [], {}
    for g, n in (("a", 40), ("b", 200), ("few", 29), ("flat", 50)):
        x = r.normal(0, 0.05, (n, 3)) + [1, 0, -2]
        if g == "flat":
            x[:, 2] = 3 * x[:, 0] - x[:, 1]
        y = 0.3 + x @ [0.5, -2.0, 1.5] + r.normal(0, 0.01, n)
        rows += [(g, *map(float, v), float(w)) for v, w in zip(x, y)]
        if g in "ab":
            want[g] = np.linalg.lstsq(np.column_stack([np.ones(n), x]), y, rcond=None)[0][1:]
    df = spark.createDataFrame(rows, "g string, x1 double, x2 double, x3 double, y double")
    found = {v.g: v for v in stats.regression(df, "y", ["x1", "x2", "x3"], ["g"]).collect()}
    assert set(found) == {"a", "b"} and found["b"].n == 200
    for g, b in want.items():
        assert [found[g][f"beta_x{i}"] for i in (1, 2, 3)] == pytest.approx(b, rel=1e-6)
    one = stats.regression(df.where("g = 'b'"), "y", ["x1"]).first()
    assert one.beta_x1 == pytest.approx(df.where("g = 'b'").agg(F.regr_slope("y", "x1")).first()[0])
    plan = stats.regression(df, "y", ["x1", "x2", "x3"], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Pandas" not in plan


# --- series and positions ----------------------------------------------------------------------------------------


def test_islands(spark):
    d = lambda s: dt.date.fromisoformat(s)
    rows = [("M", d("2010-01-01"), d("2012-01-01")), ("M", d("2012-01-20"), d("2015-01-01")), ("M", d("2011-01-01"), d("2011-02-01")), ("L", d("2007-01-12"), d("2019-06-28")), ("L", d("2024-09-26"), d("2026-01-01"))]
    out = series.islands(spark.createDataFrame(rows, "ticker string, start date, end date"))
    assert sorted((r.ticker, str(r.start), str(r.end), r.n) for r in out.collect()) == [("L", "2007-01-12", "2019-06-28", 1), ("L", "2024-09-26", "2026-01-01", 1), ("M", "2010-01-01", "2015-01-01", 3)]
    assert {r.ticker: str(r.start) for r in series.latest_island(out).collect()} == {"L": "2024-09-26", "M": "2010-01-01"}


def test_nominal_factor(spark):
    splits = F.array(F.struct(F.lit("2024-06-01").cast("date").alias("d"), F.lit(0.05).alias("ratio")))
    f = lambda s: one(spark, x=series.nominal_factor(splits, F.lit(s).cast("date"))).x
    assert (f("2023-01-01"), f("2025-01-01")) == (0.05, 1.0)


def test_closes_as_quoted_beyond_the_range_of_a_long(spark):
    day = lambda n: DAY + dt.timedelta(days=n)
    b = spark.createDataFrame([("A", day(0), 1634.3633), ("A", day(9), 2.00005)], "ticker string, d date, close double")
    splits = spark.createDataFrame([("A", day(5), 2.0)] * 60, "ticker string, d date, ratio double")
    got = {r.d: r.nominal for r in series.nominal_closes(b, splits).collect()}
    assert got == {day(0): (1634.3633 * 2.0**60 * 1e4 + 0.5) / 1e4, day(9): 2.0001}
    x = one(spark, a=S.rnd(F.lit(-1e300)), b=S.rnd(F.lit(2.0**52 + 2), 0), c=S.rnd(F.lit(None).cast("double")), d=S.rnd(F.lit(float("inf"))))
    assert tuple(x) == (-1e300, 2.0**52 + 2, None, float("inf"))


def test_positions_are_anchored(spark):
    days = [0, 60, 100, 195, 400]
    rows = [("T", DAY + dt.timedelta(days=i), 1.0) for i in days]
    out = positions.positions(spark.createDataFrame(rows, "t string, d date, v double"), "t", "d", F.col("v")).orderBy("first").collect()
    assert [((r.first - DAY).days, (r.last - DAY).days, r.n) for r in out] == [(0, 60, 2), (100, 100, 1), (195, 195, 1), (400, 400, 1)]
    s = lambda n: one(spark, x=positions.status(F.lit(DAY), F.lit(DAY + dt.timedelta(days=n)))).x
    assert [s(n) for n in (0, 25, 60, 92)] == ["new", "fresh", "held", "closed"]


def test_feed(spark):
    rows = [(1, True, "C", 100.0, None, True, "Alpha"), (2, True, "D", None, 0.5, False, "Beta"), (3, False, "C", 50.0, 0.1, False, None)]
    df = spark.createDataFrame(rows, "ticker int, ok boolean, role string, val double, growth double, in_set boolean, name string")
    ids = lambda **k: [r.ticker for r in slices.feed_filter(df, **k).orderBy("ticker").collect()]
    assert ids() == [1, 2] and ids(gate="dropped") == [3] and ids(gate="all") == [1, 2, 3] and ids(gate="all", val=(60, None)) == [1]
    assert ids(growth=(None, 0.6)) == [2] and ids(roles=["C"]) == [1] and ids(set_only=True) == [1] and ids(text="BET") == [2]
    assert [r.ticker for r in slices.page(df, [F.col("ticker")], 2, 1).collect()] == [3]


def test_as_of_edges(spark):
    from tallyglass.operators import asof

    d = lambda n: DAY + dt.timedelta(days=n)
    b = spark.createDataFrame([("A", d(1), 1.0, 0), ("A", d(5), 2.0, 1), ("B", d(30), 3.0, 0)], "ticker string, d date, close double, i int")
    rows = [("A", d(0)), ("A", d(1)), ("A", d(4)), ("A", d(4)), ("A", d(9)), ("B", d(25)), ("B", d(1)), ("C", d(1)), (None, d(1)), ("A", None)]
    p = spark.createDataFrame([(*r, "x", 7) for r in rows], "ticker string, day date, d string, close int")
    got = sorted(((r.ticker, r.day, r.bar and r.bar.close) for r in asof.as_of(p, b, "day").collect()), key=str)
    assert got == sorted([("A", d(0), None), ("A", d(1), 1), ("A", d(4), 1), ("A", d(4), 1), ("A", d(9), 2), ("B", d(25), None), ("B", d(1), None), ("C", d(1), None), (None, d(1), None), ("A", None, None)], key=str)
    got = sorted(((r.ticker, r.day, r.entry and r.entry.d) for r in asof.entry_after(p, b, "day").where("ticker in ('A', 'B') and day is not null").distinct().collect()), key=str)
    assert got == sorted([("A", d(0), d(1)), ("A", d(1), d(5)), ("A", d(4), d(5)), ("A", d(9), None), ("B", d(25), d(30)), ("B", d(1), None)], key=str)
    spans = spark.createDataFrame([("A", d(0), d(4)), ("A", d(4), d(4)), ("B", d(1), d(2))], "ticker string, start date, end date")
    hits = {(r.ticker, r.day): r.hits for r in asof.interval_lookup(p, spans, "day").collect()}
    assert (hits["A", d(0)], hits["A", d(4)], hits["A", d(9)], hits["B", d(1)], hits["C", d(1)], hits[None, d(1)]) == (1, 2, 0, 1, 0, 0)
