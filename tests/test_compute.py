import datetime as dt
import json

from pyspark.sql import functions as F

from tallyglass.operators import gates, repair, series
from tallyglass.plans import compute as C
from tallyglass.sources import prices

DAY = dt.date(2020, 1, 1)


def test_batch_job_end_to_end(spark, tmp_path):
    days = [DAY + dt.timedelta(days=i) for i in range(400) if (DAY + dt.timedelta(days=i)).weekday() < 5]
    bars = [("A", d, 100.0 + i / 10, 100.0 + i / 10, 1e6, i) for i, d in enumerate(days)]
    bars = spark.createDataFrame(bars, "ticker string, d date, close double, adj double, vol double, i int")
    d = lambda n: days[n]
    rows = [
        ("A", 1, d(200), d(198), "P", 5000.0, 119.8, 6e5, False), ("A", 1, d(10), d(9), "P", 10.0, 100.9, 1009.0, False), ("A", 2, d(210), d(209), "P", 10.0, 90.0, 900.0, False),
        ("A", 3, d(220), d(219), "P", 10.0, 121.9, 1219.0, True), ("B", 4, d(220), d(219), "P", 10.0, 5.0, 50.0, False),
    ]
    trades = spark.createDataFrame(rows, "ticker string, owner long, fdate date, tdate date, code string, sh double, px double, val double, planned boolean")
    out = C.features(trades, bars)
    got = {(r.ticker, r.owner, r.px): r for r in out.collect()}
    assert got["A", 1, 119.8].ok and got["A", 1, 119.8].in_set and got["A", 1, 119.8].entry_day == d(201)
    assert got["A", 1, 100.9].drop == "newlisting" and got["A", 2, 90.0].drop == "discount" and got["A", 3, 121.9].drop == "planned"
    assert got["B", 4, 5.0].ok and got["B", 4, 5.0].tags == ["no-price", "no-history"] and not got["B", 4, 5.0].in_set
    C.write_payloads(out, str(tmp_path), F.lit(d(230)))
    feed = [json.loads(x) for f in (tmp_path / "feed").glob("*.json") for x in f.read_text().splitlines()]
    assert len(feed) == 4 and {x["age"] for x in feed} == {(d(230) - d(n)).days for n in (200, 210, 220)}
    assert spark.read.json(f"{tmp_path}/tickers").where("ticker = 'A'").first().passed == 1
    assert spark.read.json(f"{tmp_path}/meta").first().rows == 5
    assert C.marks(out).where("at_high").count() >= 1


def test_reassigned_symbols(spark):
    t = spark.createDataFrame([("L", 1, dt.date(2018, 1, 1)), ("L", 2, dt.date(2018, 1, 1)), ("L", 1, dt.date(2025, 1, 1)), ("Q", 1, DAY)], "ticker string, cik long, tdate date")
    latest = spark.createDataFrame([("L", dt.date(2024, 9, 26), dt.date(2026, 1, 1))], "ticker string, start date, end date")
    out = C.reassigned(t, latest, spark.createDataFrame([(2,)], "cik long"))
    assert sorted(((r.ticker, r.cik, r.tdate.year, r.same) for r in out.collect()), key=str) == [("L", 1, 2018, False), ("L", 1, 2025, True), ("L", 2, 2018, None), ("Q", 1, 2020, None)]
    bars = spark.createDataFrame([("L", DAY, 1.0, 1.0, 1.0, 0)], "ticker string, d date, close double, adj double, vol double, i int")
    rows = spark.createDataFrame([("L", 1, DAY, DAY, "P", 1.0, 1.0, 1.0, True)], "ticker string, owner long, fdate date, tdate date, code string, sh double, px double, val double, reassigned boolean")
    r = C.features(rows, bars).first()
    assert r.drop == "reassigned" and r.close is None


def test_serving(spark):
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    q = spark.createDataFrame([("A", 1.0, at(0)), ("B", 1.0, at(0))], "symbol string, p double, at timestamp")
    new = spark.createDataFrame([("A", 2.0, at(59))], "symbol string, p double, at timestamp")
    out = {r.symbol: (r.p, r.state) for r in C.snapshot(q, new, F.lit(at(59))).collect()}
    assert out == {"A": (2.0, "fresh"), "B": (1.0, "stale")}
    want = spark.createDataFrame([(s,) for s in "ABCDE"], "symbol string")
    r = C.covered(q, want).first()
    assert (r.wanted, r.found, r.missing, r.ok) == (5, 2, ["C", "D", "E"], False) and C.covered(q, want.limit(4)).first().ok
    assert not C.covered(q.limit(0), want.limit(0)).first().ok
    gap = lambda a, b: spark.range(1).select(C.missed_days(F.lit(a).cast("date"), F.lit(b).cast("date"))).first()[0]
    assert (gap("2024-03-01", "2024-03-04"), gap("2024-03-01", "2024-03-06"), gap("2024-03-04", "2024-03-04")) == (0, 2, 0)
    rows = spark.createDataFrame([(DAY, 5.0, None, "D"), (DAY, 5.0, 5.0, "D"), (DAY, None, None, "D")], "fdate date, own double, own_d double, di string")
    assert C.needs_replay(rows).first().n == 1 and C.needs_replay(rows, 1).count() == 0


def test_costs(spark):
    cell = spark.createDataFrame([(0.08,)], "ex double")
    r = C.net_of_costs(cell, spark.createDataFrame([(0.6,)], "turnover double")).first()
    assert (r.turnover, r.cost, r.net) == (7.2, 0.018, 0.062)
    s = spark.createDataFrame([("2020-01", 0.1), ("2020-02", 0.2), ("2021-01", 0.3)], "m string, r double")
    out = C.by_year(s, spark.createDataFrame([("2020-01", 0.0), ("2020-02", 0.1), ("2021-01", 0.3)], "m string, r double"))
    assert {r.year: r.ex for r in out.collect()} == {"2020": 0.2, "2021": 0.0}
    assert gates.Limits().set_val == 5e4


def test_prices_before_a_split_are_as_quoted(spark):
    """Bars of a 1:20 reverse split are multiplied for the days before it; trades carry what was paid."""
    days = [DAY + dt.timedelta(days=i) for i in range(200)]
    bars = spark.createDataFrame([("A", d, 100.0, 100.0, 1e6, i) for i, d in enumerate(days)], "ticker string, d date, close double, adj double, vol double, i int")
    splits = spark.createDataFrame([("A", days[150], 0.05), ("A", days[50], 2.0), ("Z", days[10], 3.0)], "ticker string, d date, ratio double")
    rows = [("A", 1, days[n], days[n], "P", 10.0, px, 10 * px) for n, px in ((40, 10.0), (100, 5.0), (149, 5.0), (150, 100.0), (180, 100.0))]
    trades = spark.createDataFrame(rows, "ticker string, owner long, fdate date, tdate date, code string, sh double, px double, val double")
    out = {r.tdate: r for r in C.features(trades, bars, splits=splits).collect()}
    assert [(out[days[n]].close, out[days[n]].entry_px, out[days[n]].px_adj) for n in (40, 100, 149, 150, 180)] == [(10, 10, 100), (5, 5, 100), (5, 100, 100), (100, 100, 100), (100, 100, 100)]
    assert all(r.drop not in ("outlier", "discount", "units") for r in out.values())
    without = {r.tdate: r.drop for r in C.features(trades, bars).collect()}
    assert without[days[100]] == "outlier"
    shown = C.chart_marks(C.features(trades, bars, splits=splits), F.lit(days[199]), "1y")
    assert {r.shown for r in shown.collect()} == {100.0}


def test_planned_by_box_or_footnote(spark):
    df = spark.createDataFrame([(1, True, None), (2, False, True), (3, None, False), (4, None, None)], "i int, plan_box boolean, fn_b5 boolean")
    assert {r.i: r.planned for r in C.planned(df).collect()} == {1: True, 2: True, 3: False, 4: False}
    assert C.planned(df.select("i")).first().planned is False


def test_two_companies_end_to_end(spark):
    """A company that is delisted after two years and one that still trades, with flat benchmarks, so that excess is the return itself."""
    weekdays = lambda a, b: [d for i in range((b - a).days + 1) if (d := a + dt.timedelta(days=i)).weekday() < 5]
    gone_days, live_days, today = weekdays(dt.date(2019, 6, 3), dt.date(2021, 6, 30)), weekdays(dt.date(2024, 1, 2), dt.date(2024, 12, 31)), dt.date(2024, 12, 31)
    series_ = {"GONE": [(d, round(100 * 1.001**i, 4), 2e5) for i, d in enumerate(gone_days)], "LIVE": [(d, round(50 * 1.0005**i, 4), 1e6) for i, d in enumerate(live_days)]}
    bars = spark.createDataFrame([(t, d, p, p, v, i) for t, x in series_.items() for i, (d, p, v) in enumerate(x)], "ticker string, d date, close double, adj double, vol double, i int")
    price = lambda t, d: [p for q, p, _ in series_[t] if q <= d][-1]
    day = lambda m, n: dt.date(2020, m, n)
    rows = [
        ("GONE", 900, day(2, 5), day(2, 3), price("GONE", day(2, 3)), 1e5, False, False), ("GONE", 901, day(2, 13), day(2, 11), price("GONE", day(2, 11)), 2.02e5, False, False),
        ("GONE", 950, day(3, 5), day(3, 3), price("GONE", day(3, 3)) * 0.85, 9e6, True, False), ("GONE", 900, day(4, 7), day(4, 3), price("GONE", day(4, 3)), 1.1e4, False, True),
        ("LIVE", 902, today - dt.timedelta(days=6), today - dt.timedelta(days=7), price("LIVE", today - dt.timedelta(days=7)), 2.75e5, False, False),
    ]
    trades = spark.createDataFrame([(*r[:4], "P", r[5] / r[4], *r[4:]) for r in rows], "ticker string, owner long, fdate date, tdate date, code string, sh double, px double, val double, fn_offering boolean, fn_b5 boolean")
    x = C.features(trades, bars)
    out = {(r.owner, r.fdate): r for r in x.collect()}
    assert [out[r[1], r[2]].drop for r in rows] == [None, None, "offering", "planned", None]
    assert out[900, day(2, 5)].bucket == "small" and out[900, day(2, 5)].hist_days == 176 and out[900, day(2, 5)].entry_day == day(2, 6)
    assert out[902, today - dt.timedelta(days=6)].in_set
    flat = spark.createDataFrame([(d, 100.0) for d in weekdays(dt.date(2015, 1, 1), today)], "d date, adj double")
    r = {(y.owner, y.fdate): y for y in series.forward_returns(x.drop("entry_day"), bars, flat, F.lit(today), small=flat).collect()}
    first = r[900, day(2, 5)]
    assert (first.s3, first.s6, first.s12, first.s24) == ("c", "c", "c", "d") and first.r3 == first.e3 == first.x3 == 0.065 and first.r12 == round(1.001**252 - 1, 4)
    assert first.matured == gone_days[gone_days.index(day(2, 6)) + 126] and r[902, today - dt.timedelta(days=6)].s3 == "o"


def test_payloads_with_cells_and_series(spark, tmp_path):
    days = [DAY + dt.timedelta(days=i) for i in range(500)]
    bars = spark.createDataFrame([("A", d, 10.0, 10.0, 1.0, i) for i, d in enumerate(days)], "ticker string, d date, close double, adj double, vol double, i int")
    rows = spark.createDataFrame([("A", 1, days[450], days[449], "P", 1.0, 10.0, 10.0)], "ticker string, owner long, fdate date, tdate date, code string, sh double, px double, val double")
    cells = spark.createDataFrame([("b", "x", 3, 0.1), ("a", "y", 3, None)], "dim string, grp string, hold int, ex double")
    counts = spark.createDataFrame([("A", 9, 2, 0), ("B", 9, 0, 0)], "ticker string, bars long, n_spikes long, n_splits long")
    C.write_payloads(C.features(rows, bars), str(tmp_path), F.lit(days[499]), bars, cells, counts)
    read = lambda name: [json.loads(x) for f in sorted((tmp_path / name).glob("*.json")) for x in f.read_text().splitlines()]
    card = read("tickers")[0]
    assert len(card["daily"]) == 371 and len(card["weekly"]) == 72 and read("backtest-index") == [{"year": 2021, "n": 1, "passed": 1}] and read("tickers-index")[0]["trades"] == 1
    assert [x["dim"] for x in read("stats")] == ["a", "b"]
    meta = read("meta")[0]
    assert (meta["rows"], meta["n_spikes"], meta["series_repaired"], meta["reassigned"]) == (1, 2, 1, 0)


def test_price_cache(spark, tmp_path):
    import gzip

    for name, text in (("AB", "2020-01-02,10,9.5,100\n2020-01-03,11,10.5,\nbroken\n2020-13-01,1,1,1\n2020-01-06,-1,1,1\n"), ("C.D", "2020-01-02,5,5,7\n")):
        (tmp_path / f"{name}.csv.gz").write_bytes(gzip.compress(text.encode()))
    got = sorted((r.ticker, r.d.day, r.close, r.adj, r.vol) for r in prices.price_cache(spark, str(tmp_path)).collect())
    assert got == [("AB", 2, 10.0, 9.5, 100.0), ("AB", 3, 11.0, 10.5, 0.0), ("C.D", 2, 5.0, 5.0, 7.0)]
    (tmp_path / "E.csv.gz").write_bytes(b"never opened")
    assert sorted(r.ticker for r in prices.cached_tickers(spark, str(tmp_path)).collect()) == ["AB", "C.D", "E"]
    (tmp_path / "E.csv.gz").unlink()
    out = repair.counters(repair.repair(prices.price_cache(spark, str(tmp_path)))).orderBy("ticker").collect()
    assert [(r.ticker, r.bars, r.n_spikes) for r in out] == [("AB", 2, 0), ("C.D", 1, 0)]
    (tmp_path / "doc.json").write_text('{"a": 1}')
    (tmp_path / "doc.json.gz").write_bytes(gzip.compress(b'{"a": 2}'))
    (tmp_path / "bad.json").write_text("<html>")
    read = lambda n, **k: sorted(r.a for r in prices.json_documents(spark, str(tmp_path / n), "a int", **k).collect())
    spare = {"fallback": {"a": 9}}
    assert read("doc.json", **spare) == [1] and read("doc.json.gz", **spare) == [2] and read("bad.json", **spare) == [9] and read("bad.json") == []
    (tmp_path / "many.json").write_text('[{"a": 4}, {"a": 5}]')
    (tmp_path / "cut.json").write_text('[{"a": 6}, {"a"')
    assert read("*.json*", **spare) == [1, 2, 4, 5, 9, 9] and read("*.json*") == [1, 2, 4, 5]  # each broken one has its own
