"""The library's queries over the star-schema tables, each with DuckDB SQL for the same rows.

Published figures are rounded half up to four places in both; ``order by`` is
left to the reader unless a limit needs it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyglass.functions import scalars as S
from tallyglass.functions.scalars import ratio, rnd
from tallyglass.operators import asof, filings, gates, owners, panel, positions, repair, series, slices, stats
from tallyglass.plans import compute
from tallyglass.operators.components import connected_components
from tallyglass.sources import tpch
from tallyglass.sources.tpch import SQL_BARS, SQL_BENCH, SQL_TRADES, table
from tallyglass.storage import cut, scratch, shuffles_freed, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

MIN_DV, HOLD, MIN_NAMES, BIG = 1e4, 3, 5, 90_000
AS_OF = "1998-12-31"


def query(sql: str | None = None, *tables: str):
    """Register a query under its function's name, with SQL over the named common table expressions."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = ("WITH " + ",".join(tables) + "\n" if tables else "") + sql
        return f

    return put


def r4(x: str) -> str:
    return f"(floor(({x}) * 1e4 + 0.5) / 1e4)"


# --- bars, panel and series as SQL -------------------------------------------------------------------------------

SQL_DAILY = f"""
hi AS (SELECT *, max(close) OVER (PARTITION BY ticker ORDER BY d ROWS 251 PRECEDING) AS hi,
  lag(adj, 252) OVER (PARTITION BY ticker ORDER BY d) AS a, lag(adj, 21) OVER (PARTITION BY ticker ORDER BY d) AS b FROM bars),
daily AS (SELECT *, strftime(d, '%Y-%m') AS m, CASE WHEN i >= 30 AND hi > 0 AND close > 0 THEN {r4('close / hi - 1')} END AS dd,
  CASE WHEN a > 0 AND b > 0 THEN {r4('b / a - 1')} END AS mom FROM hi)"""
SQL_PANEL = """
panel AS (SELECT ticker, m, max_by(adj, d) AS px, floor(quantile_disc(CASE WHEN close > 0 AND vol > 0 THEN close * vol END, 0.5) + 0.5) AS dv,
  arg_max_null(dd, d) AS dd, max(dd) AS dd_hi, min(dd) AS dd_lo, arg_max_null(mom, d) AS mom FROM daily GROUP BY ticker, m)"""
SQL_RETS = """
mon AS (SELECT m, row_number() OVER (ORDER BY m) - 1 AS k FROM (SELECT DISTINCT m FROM panel)),
pk AS (SELECT panel.*, k FROM panel JOIN mon USING (m)),
rr AS (SELECT a.*, CASE WHEN b.px > 0 AND a.px > 0 THEN a.px / b.px - 1 END AS ret FROM pk a LEFT JOIN pk b ON a.ticker = b.ticker AND b.k = a.k - 1),
rets AS (SELECT a.*, b.ret AS next_ret FROM rr a LEFT JOIN rr b ON a.ticker = b.ticker AND b.k = a.k + 1)"""
SQL_SIGNALS = """
sig AS (SELECT DISTINCT l_suppkey AS ticker, strftime(l_shipdate, '%Y-%m') AS m FROM lineitem WHERE l_returnflag = 'R' AND l_extendedprice >= 90000)"""


def sql_portfolio(name: str, held: str, least: int, more: str = "") -> str:
    """A portfolio's monthly series from a subquery ``ticker, k`` of what is held."""
    return f"""
{name} AS (SELECT m, k, n, r FROM (SELECT k + 1 AS k, count(*) AS n, avg(next_ret) AS r FROM rets
  WHERE dv >= {MIN_DV} AND next_ret IS NOT NULL {more} AND (ticker, k) IN ({held}) GROUP BY k HAVING count(*) >= {least}) JOIN mon USING (k))"""


def sql_held(hold: int, sig: str = "sig", lag: int = 0) -> str:
    return f"SELECT ticker, unnest(range(k + {lag}, k + {lag + hold})) FROM {sig} JOIN mon USING (m)"


PANEL = (SQL_BARS, SQL_DAILY, SQL_PANEL, SQL_RETS)
EW = (*PANEL, SQL_SIGNALS, sql_portfolio("ew", sql_held(HOLD), MIN_NAMES))
ALL = f"SELECT ticker, k FROM rets WHERE dv >= {MIN_DV}"
UNIVERSE = sql_portfolio("uni", ALL, 1)


def _bars(spark, d):
    return tpch.numbered(tpch.bars(spark, d))


def _stored_bars(spark, d):
    """Bars as a table, where a query reads them several times."""
    return cut(_bars(spark, d), "bars")


def _rets(spark, d):
    return panel.with_returns(panel.monthly(_bars(spark, d)))


def _signals(spark, d, least: float = BIG):
    rows = table(spark, d, "lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_extendedprice") >= least))
    return rows.select(F.col("l_suppkey").alias("ticker"), S.month("l_shipdate").alias("m")).distinct()


def _ew(spark, d):
    rets = _rets(spark, d)
    return rets, panel.portfolio(rets, _signals(spark, d), HOLD, MIN_DV, MIN_NAMES)


# --- bars and folds ----------------------------------------------------------------------------------------------


@query("SELECT ticker, d, close, adj, vol FROM bars", SQL_BARS)
def daily_bars(spark, d):
    """Daily bars of every supplier."""
    return tpch.bars(spark, d)


@query(
    f"""SELECT acc, ticker, code, tdate, sum(sh) AS sh, {r4('floor(sum(sh * px) + 0.5) / sum(sh)')} AS px, floor(sum(sh * px) + 0.5) AS val, count(*) AS fills
FROM (SELECT acc, ticker, code, tdate, sh, px FROM trades) GROUP BY acc, ticker, code, tdate""",
    SQL_TRADES,
)
def fill_vwap(spark, d):
    """Fills of one filing, kind and day as one trade."""
    x = filings.fold_fills(tpch.trades(spark, d), ["acc", "ticker", "code", "tdate"])
    return x.withColumn("px", rnd(ratio("val", "sh")))


@query(
    """SELECT acc, code, sum(sh) AS sh, CASE WHEN count(DISTINCT di) = 2 THEN 'M' ELSE min(di) END AS di,
  CASE WHEN count(DISTINCT di) = 2 THEN NULL WHEN code = 'S' THEN min(val) ELSE max(val) END AS own,
  CASE WHEN code = 'S' THEN min(val) FILTER (di = 'D') ELSE max(val) FILTER (di = 'D') END AS own_d, sum(sh) FILTER (di = 'D') AS sh_d
FROM (SELECT *, CASE WHEN form = '4' THEN 'D' ELSE 'I' END AS di FROM trades) GROUP BY acc, code""",
    SQL_TRADES,
)
def ownership_fold(spark, d):
    """Holdings by form of ownership; the line status stands for the form."""
    x = tpch.trades(spark, d).withColumn("di", F.when(F.col("form") == "4", "D").otherwise("I"))
    return filings.fold_ownership(x, ["acc", "code"], own="val")


@query(
    """SELECT ticker, owner, tdate, code, sec, form, fdate, acc, line, sh, val, versions FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker, owner, tdate, code, sec ORDER BY form DESC, fdate DESC, acc, line, sh, val) AS r2,
    count(*) OVER (PARTITION BY ticker, owner, tdate, code, sec) AS versions FROM (
    SELECT *, row_number() OVER (PARTITION BY acc, code, tdate, sec ORDER BY acc, line, sh, val, ticker) AS r FROM trades) WHERE r = 1) WHERE r2 = 1""",
    SQL_TRADES,
)
def dedup_amendments(spark, d):
    """Two-stage deduplication: by row key, then by content with amendments first."""
    tie = [F.col(c) for c in ("line", "sh", "val", "ticker")]
    x = filings.deduplicate(tpch.trades(spark, d), ["acc", "code", "tdate", "sec"], ["ticker", "owner", "tdate", "code", "sec"], F.col("acc"), tie)
    return x.select("ticker", "owner", "tdate", "code", "sec", "form", "fdate", "acc", "line", "sh", "val", "versions")


# --- scalars and predicates --------------------------------------------------------------------------------------


@query(
    """SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN ex IN ('PINK') THEN 'otc' WHEN ex IS NULL THEN 'unknown' WHEN NOT (regexp_matches(t, '^[A-Z][A-Z0-9.-]{0,9}$') AND t <> 'NA') THEN 'ticker'
    ELSE 'in' END AS reason
  FROM (SELECT CASE r_name WHEN 'ASIA' THEN 'NYSE' WHEN 'EUROPE' THEN 'AMEX' WHEN 'AMERICA' THEN 'NASDAQ' WHEN 'AFRICA' THEN 'PINK' END AS ex,
      CASE WHEN l_suppkey % 7 = 0 THEN 'NA' ELSE upper(substr(n_name, 1, 3)) || CAST(l_suppkey AS VARCHAR) END AS t
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)) GROUP BY reason"""
)
def universe_filter(spark, d):
    """Rows by why they are in or out of the universe: exchange first, then the ticker."""
    names = {"ASIA": "NYSE", "EUROPE": "AMEX", "AMERICA": "NASDAQ", "AFRICA": "PINK"}
    places = table(spark, d, "supplier").join(F.broadcast(table(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    places = places.join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    exchange = F.try_element_at(F.create_map(*[F.lit(x) for p in names.items() for x in p]), F.col("r_name"))
    ticker = F.when(F.col("s_suppkey") % 7 == 0, "NA").otherwise(F.concat(F.upper(F.substring("n_name", 1, 3)), F.col("s_suppkey").cast("string")))
    places = places.select("s_suppkey", S.exchange_kind(exchange).alias("kind"), ticker.alias("t"))
    x = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n")).join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    reason = F.when(F.col("kind") == "otc", "otc").when(F.col("kind").isNull(), "unknown").when(~S.plausible_ticker("t"), "ticker").otherwise("in")
    return x.groupBy(reason.alias("reason")).agg(F.sum("n").alias("n"))


@query(
    """SELECT TRY_CAST(s AS DATE) IS NOT NULL AS valid, count(*) AS n FROM (
  SELECT strftime(o_orderdate, '%Y-%m-') || lpad(CAST(o_orderkey % 33 AS VARCHAR), 2, '0') AS s FROM orders) GROUP BY valid"""
)
def valid_dates(spark, d):
    """Days that exist in the calendar and days that do not."""
    s = F.concat(F.date_format("o_orderdate", "yyyy-MM-"), F.lpad((F.col("o_orderkey") % 33).cast("string"), 2, "0"))
    return table(spark, d, "orders").groupBy(S.iso_date(s).isNotNull().alias("valid")).agg(F.count("*").alias("n"))


@query(
    """SELECT p_partkey, t, regexp_matches(t, '^[A-Z][A-Z0-9.-]{0,9}$') AND t NOT IN ('NONE', 'N/A', 'NA') AS ok
FROM (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN upper(substr(p_name, 1, 6)) WHEN 1 THEN 'NA' WHEN 2 THEN p_brand WHEN 3 THEN upper(p_type) ELSE '9X' END AS t FROM part)"""
)
def ticker_plausible(spark, d):
    """Which strings may be tickers."""
    k = F.col("p_size") % 5
    t = F.when(k == 0, F.upper(F.substring("p_name", 1, 6))).when(k == 1, "NA").when(k == 2, F.col("p_brand")).when(k == 3, F.upper("p_type")).otherwise("9X")
    return table(spark, d, "part").select("p_partkey", t.alias("t"), S.plausible_ticker(t).alias("ok"))


@query(
    """SELECT o_orderkey, a, b, CASE WHEN a < b THEN len(list_filter(range(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY),
  lambda x: isodow(x) < 6)) ELSE 0 END AS days
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_custkey % 40 - 5 AS INTEGER) AS b FROM orders)"""
)
def bus_days(spark, d):
    """Weekdays between two days."""
    a = F.col("o_orderdate").cast("date")
    x = table(spark, d, "orders").select("o_orderkey", a.alias("a"), F.date_add(a, (F.col("o_custkey") % 40 - 5).cast("int")).alias("b"))
    return x.withColumn("days", S.business_days("a", "b").cast("long"))


@query("SELECT strftime(o_orderdate, '%G-W%V') AS week, count(*) AS n FROM orders GROUP BY week")
def iso_week(spark, d):
    """Orders by ISO week."""
    return table(spark, d, "orders").groupBy(S.iso_week(F.col("o_orderdate").cast("date")).alias("week")).agg(F.count("*").alias("n"))


_FN_SQL = ", ".join(f"regexp_matches(text, '(?i){p}') AS {k}" for k, p in S.FOOTNOTE_PATTERNS.items())


@query(f"SELECT conv_id, turn, {_FN_SQL} FROM (SELECT conv_id, turn, text || ' rights offering'[: 17 * CAST(turn % 2 AS INTEGER)] || ' weighted average'[: 17 * CAST(conv_id % 2 AS INTEGER)] AS text FROM conversations)")
def footnote_flags(spark, d):
    """Classes of notes in free text."""
    extra = lambda s, c: F.substring(F.lit(s), F.lit(1), (17 * (F.col(c) % 2)).cast("int"))
    text = F.concat("text", extra(" rights offering", "turn"), extra(" weighted average", "conv_id"))
    x = table(spark, d, "conversations").select("conv_id", "turn", text.alias("text"))
    return x.select("conv_id", "turn", *[c.alias(k) for k, c in S.footnote_flags("text").items()])


@query("SELECT event_type, count(*) AS n, sum(k) AS total, min(k) AS low, max(k) AS high FROM (SELECT event_type, CAST(props ->> 'k' AS BIGINT) AS k FROM events) GROUP BY event_type")
def json_props(spark, d):
    """Numbers from JSON properties by kind of event."""
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("total"), F.min(k).alias("low"), F.max(k).alias("high"))


# --- as-of joins and intervals -----------------------------------------------------------------------------------


@query(
    "SELECT acc, line, trades.ticker, tdate, val, bars.d, bars.close, CAST(bars.i AS INTEGER) AS i FROM trades ASOF LEFT JOIN bars ON trades.ticker = bars.ticker AND trades.tdate >= bars.d",
    SQL_BARS, SQL_TRADES,
)
def asof_close(spark, d):
    """The last bar at or before the trade."""
    x = asof.as_of(tpch.trades(spark, d), _bars(spark, d), "tdate")
    return x.select("acc", "line", "ticker", "tdate", "val", "bar.d", "bar.close", F.col("bar.i").cast("int").alias("i"))


SQL_ENTRY = """
ent AS (SELECT t.*, b.i AS at_i, CASE WHEN b.i IS NULL THEN (SELECT 0 FROM bars f WHERE f.ticker = t.ticker AND f.i = 0 AND f.d <= t.fdate + 10) ELSE b.i + 1 END AS ei
  FROM trades t ASOF LEFT JOIN bars b ON t.ticker = b.ticker AND t.fdate >= b.d)"""


@query(
    "SELECT acc, line, ent.ticker, fdate, val, e.d AS entry_day, e.close AS entry_px FROM ent LEFT JOIN bars e ON e.ticker = ent.ticker AND e.i = ent.ei",
    SQL_BARS, SQL_TRADES, SQL_ENTRY,
)
def entry_after_filing(spark, d):
    """The first bar after the filing."""
    x = asof.entry_after(tpch.trades(spark, d), _bars(spark, d), "fdate")
    return x.select("acc", "line", "ticker", "fdate", "val", F.col("entry.d").alias("entry_day"), F.col("entry.close").alias("entry_px"))


def _sql_forward() -> str:
    last = "(SELECT ticker, max(i) AS li, max(d) AS ld, max_by(adj, i) AS la FROM bars GROUP BY ticker)"
    out = []
    for m, h in series.HORIZONS.items():
        out.append(f"""f{m} AS (SELECT x.*, CASE WHEN ei0 IS NULL THEN 'o' WHEN b.i IS NOT NULL THEN 'c' WHEN ld < DATE '{AS_OF}' - 14 AND li > ei0 THEN 'd' ELSE 'o' END AS s{m},
  CASE WHEN b.i IS NOT NULL THEN b.d WHEN ld < DATE '{AS_OF}' - 14 AND li > ei0 THEN ld END AS xd{m}, CASE WHEN b.i IS NOT NULL THEN b.adj WHEN ld < DATE '{AS_OF}' - 14 AND li > ei0 THEN la END AS xa{m}
  FROM {'f0' if m == '3' else 'f' + str(list(series.HORIZONS)[list(series.HORIZONS).index(m) - 1])} x LEFT JOIN bars b ON b.ticker = x.ticker AND b.i = x.ei0 + {h})""")
    cols = []
    for m in series.HORIZONS:
        move = f"coalesce((SELECT CASE WHEN q.d > p.d THEN q.adj / p.adj - 1 END FROM bl p, bl q WHERE p.day = f24.ed AND q.day = f24.xd{m}), 0)"
        cols += [f"{r4(f'xa{m} / ea - 1')} AS r{m}", f"{r4(f'xa{m} / ea - 1 - {move}')} AS x{m}", f"s{m}"]
    for n, h in series.SHORT_COLUMNS.items():
        cols.append(f"{r4(f'(SELECT b.adj FROM bars b WHERE b.ticker = f24.ticker AND b.i = f24.ei0 + {h}) / ea - 1')} AS {n}")
    return (
        f"f0 AS (SELECT ent.*, e.i AS ei0, e.d AS ed, e.adj AS ea, li, ld, la FROM ent LEFT JOIN bars e ON e.ticker = ent.ticker AND e.i = ent.ei LEFT JOIN {last} l ON l.ticker = ent.ticker), "
        + ", ".join(out)
        + ", days AS (SELECT DISTINCT ed AS day FROM f24 UNION SELECT DISTINCT unnest([xd3, xd6, xd12, xd24]) FROM f24), bl AS (SELECT day, bench.d, bench.adj FROM days ASOF JOIN bench ON days.day >= bench.d)\n"
        + f"SELECT acc, line, ticker, val, ed AS entry_day, {', '.join(cols)}, ei0 IS NULL AND at_i IS NULL AS no_entry FROM f24"
    )


@query(None)
def forward_returns(spark, d):
    """Returns after the filing at 3, 6, 12 and 24 months, over the benchmark, with status, and short columns."""
    x = series.forward_returns(cut(tpch.trades(spark, d).where("code = 'P'"), "trades"), _stored_bars(spark, d), tpch.benchmark(spark, d), F.lit(AS_OF).cast("date"))
    figures = [f"{p}{m}" for m in series.HORIZONS for p in "rxs"]
    return x.select("acc", "line", "ticker", "val", "entry_day", *figures, *series.SHORT_COLUMNS, "no_entry")


ORACLE_SQL["forward_returns"] = "WITH " + ",".join([SQL_BARS, SQL_BENCH, SQL_TRADES.replace("IN ('R', 'N')", "= 'R'"), SQL_ENTRY, _sql_forward()])

SQL_SPANS = """
spans AS (SELECT user_id AS ticker, CAST(min(ts) AS DATE) AS "start", CAST(max(ts) AS DATE) AS "end" FROM events GROUP BY user_id, event_type, CAST(floor(value / 40) AS BIGINT))"""


def _spans(spark, d):
    x = table(spark, d, "events").groupBy(F.col("user_id").alias("ticker"), "event_type", F.floor(F.col("value") / 40).alias("g"))
    return x.agg(F.min("ts").cast("date").alias("start"), F.max("ts").cast("date").alias("end")).select("ticker", "start", "end")


@query(
    """SELECT event_id, ticker, d, (SELECT count(*) FROM spans s WHERE s.ticker = p.ticker AND p.d BETWEEN s."start" AND s."end") AS hits
FROM (SELECT event_id, user_id AS ticker, CAST(ts AS DATE) + CAST(event_id % 9 - 4 AS INTEGER) AS d FROM events) p""",
    SQL_SPANS,
)
def interval_exchange(spark, d):
    """In how many listing intervals of its ticker a day lies."""
    day = F.date_add(F.col("ts").cast("date"), (F.col("event_id") % 9 - 4).cast("int"))
    probes = table(spark, d, "events").select("event_id", F.col("user_id").alias("ticker"), day.alias("d"))
    return asof.interval_lookup(probes, _spans(spark, d), "d").withColumn("hits", F.col("hits").cast("long"))


SQL_ISLANDS = """
days AS (SELECT DISTINCT user_id AS ticker, CAST(ts AS DATE) AS "start", CAST(ts AS DATE) AS "end" FROM events),
flagged AS (SELECT *, CASE WHEN "start" > max("end") OVER (PARTITION BY ticker ORDER BY "start" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1
  OR row_number() OVER (PARTITION BY ticker ORDER BY "start") = 1 THEN 1 ELSE 0 END AS f FROM days),
isl AS (SELECT ticker, min("start") AS "start", max("end") AS "end", count(*) AS n FROM (
  SELECT *, sum(f) OVER (PARTITION BY ticker ORDER BY "start" ROWS UNBOUNDED PRECEDING) AS g FROM flagged) GROUP BY ticker, g)"""


def _islands(spark, d):
    days = table(spark, d, "events").select(F.col("user_id").alias("ticker"), F.col("ts").cast("date").alias("start")).distinct()
    return series.islands(days.withColumn("end", F.col("start")), gap_days=1)


@query('SELECT ticker, "start", "end", n FROM isl', SQL_ISLANDS)
def symbol_islands(spark, d):
    """Runs of active days, merged over gaps."""
    return _islands(spark, d)


@query('SELECT ticker, max_by("start", "end") AS "start", max("end") AS "end" FROM isl GROUP BY ticker', SQL_ISLANDS)
def listed_through(spark, d):
    """The last run of each ticker."""
    return series.latest_island(_islands(spark, d))


# --- windows -----------------------------------------------------------------------------------------------------


@query(
    f"""SELECT acc, line, ticker, tdate, val, CASE WHEN i >= 30 AND hi > 0 AND close > 0 THEN {r4('close / hi - 1')} END AS dd FROM (
  SELECT t.*, b.i, b.close, (SELECT max(close) FROM bars x WHERE x.ticker = t.ticker AND x.d BETWEEN t.tdate - 365 AND t.tdate) AS hi
  FROM trades t ASOF LEFT JOIN bars b ON t.ticker = b.ticker AND t.tdate >= b.d)""",
    SQL_BARS, SQL_TRADES,
)
def drawdown_365d(spark, d):
    """Close against the high of the 365 days before the trade."""
    return series.drawdown_calendar(_bars(spark, d), tpch.trades(spark, d)).select("acc", "line", "ticker", "tdate", "val", "dd")


@query("SELECT ticker, d, dd FROM daily", SQL_BARS, SQL_DAILY)
def drawdown_252bars(spark, d):
    """Close against the high of the last 252 bars."""
    return series.drawdown_bars(_bars(spark, d)).select("ticker", "d", "dd")


@query("SELECT ticker, d, mom FROM daily", SQL_BARS, SQL_DAILY)
def momentum_12_1(spark, d):
    """Price a month ago against a year ago."""
    return series.momentum(_bars(spark, d)).select("ticker", "d", "mom")


SQL_ADV = """
advs AS (SELECT ticker, d, i, CASE WHEN i >= 20 AND len(v) >= 15 THEN floor(list_sort(v)[(len(v) - 1) // 2 + 1] + 0.5) END AS adv FROM (
  SELECT ticker, d, i, list(close * vol) FILTER (vol > 0) OVER (PARTITION BY ticker ORDER BY d ROWS 59 PRECEDING) AS v FROM bars))"""


@query("SELECT ticker, d, adv FROM advs", SQL_BARS, SQL_ADV)
def adv_60(spark, d):
    """Lower median of traded value over 60 bars."""
    return series.adv(_bars(spark, d)).select("ticker", "d", "adv")


@query(
    "SELECT CASE WHEN adv IS NULL THEN 'н/д' WHEN adv < 3e6 THEN 'micro' WHEN adv < 3e7 THEN 'small' WHEN adv < 3e8 THEN 'mid' ELSE 'large' END AS bucket, count(*) AS n FROM advs GROUP BY bucket",
    SQL_BARS, SQL_ADV,
)
def size_bucket(spark, d):
    """Bars by bucket of traded value."""
    return series.adv(_bars(spark, d)).groupBy("bucket").agg(F.count("*").alias("n"))


@query(
    """SELECT ticker, d, adj, n >= 5 AND nb >= 3 AND na >= 3 AND NOT (abs(ln(adj) - (s - ln(adj)) / (nb + na)) < ln(1.25))
  AND NOT (mb > 0 AND ma > 0 AND greatest(mb, ma) / least(mb, ma) > 3) AND m > 0 AND greatest(adj / m, m / adj) > 3
  AND NOT (greatest(adj / m, m / adj) < 10 AND coalesce(mv, 0) > 0 AND vol > coalesce(mv, 0) * 1.5) AS spike
FROM (SELECT *, count(*) OVER (PARTITION BY ticker) AS n, sum(ln(adj)) OVER e + 0 AS s0, sum(ln(adj)) OVER f AS s, count(*) OVER b AS nb, count(*) OVER a AS na, coalesce(median(adj) OVER b, 0) AS mb,
    coalesce(median(adj) OVER a, 0) AS ma, median(adj) OVER e AS m, median(vol) FILTER (vol > 0) OVER e AS mv FROM bars
  WINDOW b AS (PARTITION BY ticker ORDER BY d ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), a AS (PARTITION BY ticker ORDER BY d ROWS BETWEEN 1 FOLLOWING AND 30 FOLLOWING),
    e AS (PARTITION BY ticker ORDER BY d ROWS BETWEEN 30 PRECEDING AND 30 FOLLOWING EXCLUDE CURRENT ROW), f AS (PARTITION BY ticker ORDER BY d ROWS BETWEEN 30 PRECEDING AND 30 FOLLOWING))""",
    SQL_BARS,
)
def spike_candidates(spark, d):
    """One pass of the spike test."""
    return series.spike_candidates(_bars(spark, d)).select("ticker", "d", "adj", "spike")


def sql_spike_pass(name: str, source: str) -> str:
    """``source`` without the spikes of one pass."""
    return f"""
{name} AS (SELECT ticker, d, adj, vol FROM (
  SELECT *, count(*) OVER (PARTITION BY ticker) AS n, sum(ln(adj)) OVER f AS s, count(*) OVER b AS nb, count(*) OVER a AS na, coalesce(median(adj) OVER b, 0) AS mb,
    coalesce(median(adj) OVER a, 0) AS ma, median(adj) OVER e AS m, median(vol) FILTER (vol > 0) OVER e AS mv FROM {source}
  WINDOW b AS (PARTITION BY ticker ORDER BY d ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), a AS (PARTITION BY ticker ORDER BY d ROWS BETWEEN 1 FOLLOWING AND 30 FOLLOWING),
    e AS (PARTITION BY ticker ORDER BY d ROWS BETWEEN 30 PRECEDING AND 30 FOLLOWING EXCLUDE CURRENT ROW), f AS (PARTITION BY ticker ORDER BY d ROWS BETWEEN 30 PRECEDING AND 30 FOLLOWING))
WHERE NOT coalesce(n >= 5 AND nb >= 3 AND na >= 3 AND NOT (abs(ln(adj) - (s - ln(adj)) / (nb + na)) < ln(1.25))
  AND NOT (mb > 0 AND ma > 0 AND greatest(mb, ma) / least(mb, ma) > 3) AND m > 0 AND greatest(adj / m, m / adj) > 3
  AND NOT (greatest(adj / m, m / adj) < 10 AND coalesce(mv, 0) > 0 AND vol > coalesce(mv, 0) * 1.5), false))"""


@query("SELECT ticker, d, adj FROM p3", SQL_BARS, sql_spike_pass("p1", "bars"), sql_spike_pass("p2", "p1"), sql_spike_pass("p3", "p2"))
def spikes_dropped(spark, d):
    """Bars without spikes, in three passes."""
    return series.drop_spikes(tpch.bars(spark, d)).select("ticker", "d", "adj")


SQL_REPAIR = (
    "RECURSIVE one AS (SELECT 1)", SQL_BARS, sql_spike_pass("p1", "bars"), sql_spike_pass("p2", "p1"), sql_spike_pass("p3", "p2"),
    """
s0 AS MATERIALIZED (SELECT ticker, d, close, p3.adj, p3.vol, row_number() OVER (PARTITION BY ticker ORDER BY d) - 1 AS i, count(*) OVER (PARTITION BY ticker) AS n FROM p3 JOIN bars USING (ticker, d)),
sp AS (SELECT p_partkey % 100 + 1 AS ticker, DATE '1993-01-01' + CAST(p_partkey % 2000 AS INTEGER) AS d, CASE WHEN p_size % 2 = 0 THEN 2.4::DOUBLE ELSE 0.6::DOUBLE END AS ratio FROM part WHERE p_size >= 45),
placed AS (SELECT sp.ticker, sp.d, ratio, count(*) FILTER (s0.d < sp.d) AS pos, any_value(n) AS n FROM (SELECT *, row_number() OVER () AS id FROM sp WHERE ratio <= 0.5 OR ratio >= 2) sp JOIN s0 USING (ticker) GROUP BY sp.ticker, sp.d, ratio, id),
marks AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY d, ratio) AS k FROM placed WHERE pos > 0 AND pos < n),
folded AS (
  SELECT 0 AS k, ticker, d, i, close, adj, vol, 0 AS splits FROM s0
  UNION ALL
  SELECT r.k + 1, r.ticker, r.d, r.i, CASE WHEN r.i < p THEN floor(close / f * 1e4 + 0.5) / 1e4 ELSE close END, CASE WHEN r.i < p THEN floor(adj / f * 1e4 + 0.5) / 1e4 ELSE adj END,
    CASE WHEN r.i < p THEN floor(vol * f + 0.5) ELSE vol END, splits + CASE WHEN p IS NULL THEN 0 ELSE 1 END
  FROM folded r LEFT JOIN (
    SELECT ticker, b.i AS p, CASE WHEN b.miss <= 0.25 THEN ratio ELSE 1 / b.step END AS f FROM (
      SELECT m.ticker, any_value(ratio) AS ratio, min(struct_pack(miss := abs(ln(y.adj / x.adj * ratio)), i := y.i, step := y.adj / x.adj)) AS b
      FROM marks m JOIN folded y ON y.ticker = m.ticker AND y.k + 1 = m.k AND y.i BETWEEN pos - 3 AND pos + 3 JOIN folded x ON x.ticker = y.ticker AND x.i = y.i - 1
      WHERE x.adj > 0 AND y.adj > 0 GROUP BY m.ticker)
    WHERE b.miss <= ln(2) AND abs(ln(b.step)) >= ln(1.8)) e ON e.ticker = r.ticker
  WHERE r.k < (SELECT coalesce(max(k), 0) FROM marks)),
s1 AS MATERIALIZED (SELECT * EXCLUDE (k) FROM folded WHERE k = (SELECT coalesce(max(k), 0) FROM marks)),
holder AS (SELECT s_suppkey AS ticker, DATE '1992-01-01' + CAST(s_suppkey % 1461 AS INTEGER) AS a, CASE WHEN s_suppkey % 3 = 0 THEN DATE '1997-06-30' ELSE DATE '2002-12-31' END AS z FROM supplier),
s2 AS (SELECT *, lag(adj) OVER w AS before, lag(d) OVER w AS day_before, count(*) OVER (PARTITION BY ticker) AS n FROM (
  SELECT s1.*, a, count(*) OVER (PARTITION BY ticker) AS n1 FROM s1 LEFT JOIN holder USING (ticker) QUALIFY z IS NULL OR NOT z < max(d) OVER (PARTITION BY ticker) - 90 OR d <= z)
  WINDOW w AS (PARTITION BY ticker ORDER BY d)),
heads AS (SELECT ticker, i AS lo FROM s2 WHERE d >= a AND day_before < a
  AND (d - day_before >= 30 OR (before > 0 AND adj > 0 AND greatest(before / adj, adj / before) >= 2))),
s3 AS MATERIALIZED (SELECT s2.* EXCLUDE (n), n1 - n AS tail, coalesce(lo, 0) AS head, i - coalesce(lo, 0) AS j, n - coalesce(lo, 0) AS n FROM s2 LEFT JOIN heads USING (ticker) WHERE i >= coalesce(lo, 0)),
steps AS MATERIALIZED (SELECT ticker, j, row_number() OVER (PARTITION BY ticker ORDER BY j) AS k FROM s3
  WHERE n >= 60 AND j >= 30 AND j < n - 10 AND CASE WHEN before > 0 THEN adj / before >= 5 ELSE before = 0 AND adj > 0 END AND (ticker, d) NOT IN (SELECT ticker, d FROM sp)),
breaks AS (
  SELECT 0 AS k, ticker, CAST(0 AS BIGINT) AS start FROM (SELECT DISTINCT ticker FROM steps)
  UNION ALL
  SELECT k, ticker, CASE WHEN l >= 10 AND pa > 0 AND pb > 0 AND pb / pa >= 4 AND NOT (coalesce(va, 0) > 0 AND coalesce(vb, 0) > 0 AND vb / va > 1.5) THEN j ELSE start END FROM (
    SELECT c.k, c.ticker, c.j, b.start, count(*) FILTER (x.j < c.j) AS l, quantile_disc(adj, 0.5) FILTER (x.j < c.j) AS pa, quantile_disc(adj, 0.5) FILTER (x.j >= c.j) AS pb,
      quantile_disc(vol, 0.5) FILTER (x.j < c.j AND vol > 0) AS va, quantile_disc(vol, 0.5) FILTER (x.j >= c.j AND vol > 0) AS vb
    FROM breaks b JOIN steps c ON c.ticker = b.ticker AND c.k = b.k + 1 JOIN s3 x ON x.ticker = c.ticker AND x.j >= greatest(b.start, c.j - 30) AND x.j < c.j + 30 GROUP BY ALL)),
s4 AS MATERIALIZED (SELECT s3.*, coalesce(start, 0) AS broken, count(*) OVER (PARTITION BY ticker) AS left_n FROM s3 LEFT JOIN (SELECT ticker, max(start) AS start FROM breaks GROUP BY ticker) USING (ticker) WHERE j >= coalesce(start, 0)),
flat AS (SELECT ticker, any_value(left_n) AS left_n, max(n) AS n, max_by(adj, j) AS price, min(j) AS least FROM s4 GROUP BY ticker),
turn AS (SELECT ticker, coalesce(max(j) FILTER (adj <> price) + 1, any_value(least)) AS first, any_value(f.n) AS n, any_value(f.left_n) AS left_n FROM s4 JOIN flat f USING (ticker) GROUP BY ticker),
ends AS (SELECT ticker, first FROM s4 JOIN turn t USING (ticker) WHERE t.left_n >= 25 AND t.n - first >= 5 GROUP BY ticker, first, t.n
  HAVING coalesce(sum(vol) FILTER (vol > 0 AND j > first), 0) <= 0.01 * quantile_disc(vol, 0.5) FILTER (vol > 0 AND j < first AND j >= first - 60) * (t.n - first)),
repaired AS (SELECT s4.ticker, s4.d, close, adj, vol, (SELECT count(*) FROM bars b WHERE b.ticker = s4.ticker) - (SELECT any_value(n) FROM s0 WHERE s0.ticker = s4.ticker) AS n_spikes,
  CAST(splits AS BIGINT) AS n_splits, head AS n_head, tail AS n_tail, broken AS n_break, CASE WHEN first IS NULL THEN 0 ELSE n - first - 1 END AS n_frozen
  FROM s4 LEFT JOIN ends USING (ticker) WHERE first IS NULL OR j <= first)""",
)


@query("SELECT * FROM repaired", *SQL_REPAIR)
def repaired_bars(spark, d):
    """The chain of repairs over all series, with counters; present holders have had their symbols for one to four years."""
    b = tpch.bars(spark, d)
    k = F.col("s_suppkey")
    start = F.date_add(F.lit("1992-01-01").cast("date"), (k % 1461).cast("int"))
    holders = table(spark, d, "supplier").select(k.alias("ticker"), start.alias("start"), F.when(k % 3 == 0, F.lit("1997-06-30")).otherwise(F.lit("2002-12-31")).cast("date").alias("end"))
    splits = _splits(spark, d).withColumn("ratio", F.col("ratio") * F.lit(1.2))
    return repair.repair(b, splits, holders)


@query("SELECT ticker, count(*) AS bars, max(n_spikes) AS n_spikes, max(n_splits) AS n_splits, max(n_head) AS n_head, max(n_tail) AS n_tail, max(n_break) AS n_break, max(n_frozen) AS n_frozen FROM repaired GROUP BY ticker", *SQL_REPAIR)
def repair_counts(spark, d):
    """What the repairs did to each series, told once."""
    return repair.counters(repaired_bars(spark, d))


@query(
    f"""SELECT ticker, b.d, close, {r4('close * coalesce((SELECT product(ratio) FROM sp WHERE sp.ticker = b.ticker AND sp.d > b.d), 1)')} AS nominal FROM bars b
""",
    SQL_BARS,
    "sp AS (SELECT p_partkey % 100 + 1 AS ticker, DATE '1993-01-01' + CAST(p_partkey % 2000 AS INTEGER) AS d, CASE WHEN p_size % 2 = 0 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END AS ratio FROM part WHERE p_size >= 45)",
)
def nominal_factor(spark, d):
    """Prices as they were quoted, by the splits after each day."""
    return series.nominal_closes(tpch.bars(spark, d), _splits(spark, d)).select("ticker", "d", "close", "nominal")


@query("SELECT ticker, CAST(isoyear(d) AS INTEGER) AS year, CAST(weekofyear(d) AS INTEGER) AS week, max(d) AS d, max_by(close, d) AS close FROM bars GROUP BY ALL", SQL_BARS)
def weekly_close(spark, d):
    """The last close of each ISO week."""
    return series.weekly_close(tpch.bars(spark, d))


# --- panel and portfolios ----------------------------------------------------------------------------------------


@query("SELECT * FROM panel", SQL_BARS, SQL_DAILY, SQL_PANEL)
def monthly_panel(spark, d):
    """The monthly panel."""
    return panel.monthly(_bars(spark, d))


@query(f"SELECT ticker, m, {r4('ret')} AS ret FROM rets", *PANEL)
def monthly_returns(spark, d):
    """Monthly returns over the panel's months."""
    return _rets(spark, d).select("ticker", "m", rnd("ret").alias("ret"))


@query(f"SELECT m, n, {r4('r')} AS r FROM ew", *EW)
def portfolio_ew(spark, d):
    """Equal-weight portfolio of the signals of the last three months."""
    return _ew(spark, d)[1].select("m", "n", rnd("r").alias("r"))


@query(f"SELECT m, n, {r4('r')} AS r FROM uni", *PANEL, UNIVERSE)
def portfolio_universe(spark, d):
    """All liquid names."""
    return panel.universe(_rets(spark, d), 1, MIN_DV).select("m", "n", rnd("r").alias("r"))


CONTROL = sql_portfolio("ctl", sql_held(HOLD, f"(SELECT ticker, m FROM panel WHERE dv >= {MIN_DV} AND dd_hi >= -0.5)"), 1)


def _control(rets):
    return panel.universe(rets, HOLD, MIN_DV, F.col("dd_hi") >= -0.5)


@query(f"SELECT m, n, {r4('r')} AS r FROM ctl", *PANEL, CONTROL)
def portfolio_control(spark, d):
    """Names in the same price context, with or without a signal."""
    return _control(_rets(spark, d)).select("m", "n", rnd("r").alias("r"))


SQL_FACTORS = f"""
fac AS (SELECT f.fac AS fac, m, spread FROM (
  SELECT fac, k + 1 AS k, CASE WHEN fac = 'dv' THEN 1 ELSE -1 END * (avg(next_ret) FILTER (r <= n // 3) - avg(next_ret) FILTER (r > n - n // 3)) AS spread
  FROM (SELECT *, row_number() OVER (PARTITION BY fac, k ORDER BY x, ticker) AS r, count(*) OVER (PARTITION BY fac, k) AS n FROM (
    SELECT 'dv' AS fac, dv AS x, ticker, k, next_ret FROM rets WHERE dv >= {MIN_DV} UNION ALL SELECT 'mom', mom, ticker, k, next_ret FROM rets WHERE dv >= {MIN_DV} AND mom IS NOT NULL))
  WHERE n // 3 >= 5 AND next_ret IS NOT NULL GROUP BY fac, k
  HAVING count(*) FILTER (r <= n // 3) >= 5 AND count(*) FILTER (r > n - n // 3) >= 5) f JOIN mon USING (k))"""


@query(f"SELECT fac, m, {r4('spread')} AS spread FROM fac", *PANEL, SQL_FACTORS)
def factor_terciles(spark, d):
    """Size and momentum spreads between outer thirds."""
    rets = _rets(spark, d)
    each = [panel.tercile_spread(rets, by, by == "dv", MIN_DV).select(F.lit(by).alias("fac"), "m", rnd("spread").alias("spread")) for by in ("dv", "mom")]
    return each[0].unionByName(each[1])


# --- statistics --------------------------------------------------------------------------------------------------


def sql_nw(of: str, value: str) -> str:
    """Mean, Newey-West t and number of a series in SQL."""
    return f"""(SELECT avg(v) AS mean, count(*) AS n, avg(v) / sqrt(greatest((sum(e * e) + 1.5 * coalesce(sum(e * e1), 0) + 1.0 * coalesce(sum(e * e2), 0) + 0.5 * coalesce(sum(e * e3), 0)) / count(*), 1e-15) / count(*)) AS t
  FROM (SELECT v, e, lag(e, 1) OVER (ORDER BY k) AS e1, lag(e, 2) OVER (ORDER BY k) AS e2, lag(e, 3) OVER (ORDER BY k) AS e3 FROM (SELECT k, {value} AS v, {value} - avg({value}) OVER () AS e FROM {of})))"""


@query(f"SELECT {r4('mean')} AS mean, CASE WHEN n >= 12 THEN {r4('t')} END AS t, n FROM {sql_nw('ew', 'r')}", *EW)
def newey_west(spark, d):
    """Mean and Newey-West t of the portfolio."""
    return stats.newey_west(_ew(spark, d)[1]).select(rnd("mean").alias("mean"), rnd("t").alias("t"), "n")


RF_SQL = "(CASE substr(m, 1, 4) " + " ".join(f"WHEN '{y}' THEN {v}" for y, v in stats.RISK_FREE.items()) + f" ELSE {stats.RISK_FREE_ELSE} END::DOUBLE / 12)"
BOTH = "xs AS (SELECT m, ew.k AS k, ew.r AS r, uni.r AS u, ew.r - uni.r AS d FROM ew JOIN uni USING (m))"


@query(
    f"SELECT {r4('w.mean')} AS ex, {r4('w.t')} AS t, {r4('ir')} AS ir, {r4('sharpe')} AS sharpe, months FROM {sql_nw('xs', 'd')} w, "
    f"(SELECT avg(d) * 12 / sqrt(12 * var_pop(d)) AS ir, avg(r - {RF_SQL}) * 12 / sqrt(12 * var_pop(r)) AS sharpe, count(*) AS months FROM xs) WHERE months >= 24",
    *EW, UNIVERSE, BOTH,
)
def vs_benchmark(spark, d):
    """The portfolio against the universe."""
    rets, ew = _ew(spark, d)
    x = stats.versus(ew, panel.universe(rets, 1, MIN_DV))
    return x.select(*[rnd(c).alias(c) for c in ("ex", "t", "ir", "sharpe")], "months")


@query(f"SELECT {r4('mean')} AS ex, {r4('t')} AS t, n AS months FROM {sql_nw('cs', 'd')} WHERE n >= 24", *EW, CONTROL, "cs AS (SELECT ew.k AS k, ew.r - ctl.r AS d FROM ew JOIN ctl USING (m))")
def paired_diff(spark, d):
    """The portfolio against its price context, month by month."""
    rets, ew = _ew(spark, d)
    return stats.paired(ew, _control(rets)).select(rnd("ex").alias("ex"), rnd("t").alias("t"), "months")


@query(
    f"""SELECT {r4('pow(max(eq_last), 12.0 / count(*)) - 1')} AS cagr, {r4('stddev_samp(r) * sqrt(12)')} AS vol, {r4('least(0, min(eq / greatest(1, pk) - 1))')} AS dd, floor(avg(n) + 0.5) AS avg_n
FROM (SELECT *, max(eq) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS pk, last_value(eq) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS eq_last
  FROM (SELECT *, product(1 + r) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS eq FROM (SELECT k, n, r / 100 AS r FROM ew)))""",
    *EW,
)
def path_stats(spark, d):
    """Growth, volatility and deepest fall (of a hundredth of the noisy returns)."""
    ew = _ew(spark, d)[1].withColumn("r", F.col("r") / 100)
    return stats.path(ew).select(*[rnd(c).alias(c) for c in ("cagr", "vol", "dd")], F.col("avg_n").cast("double").alias("avg_n"))


@query(
    f"""SELECT {r4('avg((a.n + b.n - 2 * coalesce(s.both_n, 0)) / greatest(a.n, b.n))')} AS turnover, count(*) AS months
FROM hs a JOIN hs b ON b.k = a.k - 1 LEFT JOIN (SELECT x.k, count(*) AS both_n FROM h x JOIN h y ON x.ticker = y.ticker AND y.k = x.k - 1 GROUP BY x.k) s ON s.k = a.k""",
    *PANEL, SQL_SIGNALS, f"h AS (SELECT ticker, k FROM rets WHERE dv >= {MIN_DV} AND k < (SELECT max(k) FROM mon) AND (ticker, k) IN ({sql_held(HOLD)}))", "hs AS (SELECT k, count(*) AS n FROM h GROUP BY k)",
)
def turnover(spark, d):
    """Names that change from month to month."""
    rets = _rets(spark, d)
    return panel.turnover(rets, _signals(spark, d), HOLD, MIN_DV).select(rnd("turnover").alias("turnover"), "months")


@query(
    f"SELECT {r4('w.mean')} AS alpha, {r4('w.t')} AS t, {r4('beta')} AS beta, w.n AS months FROM {sql_nw('res', 'v')} w, fit WHERE w.n >= 30",
    *EW, UNIVERSE, f"ab AS (SELECT ew.k AS k, ew.r - {RF_SQL} AS y, uni.r - {RF_SQL} AS x FROM ew JOIN uni USING (m))",
    "fit AS (SELECT regr_slope(y, x) AS beta FROM ab)", "res AS (SELECT k, y - beta * x AS v FROM ab, fit)",
)
def factor_alpha(spark, d):
    """Alpha on the universe."""
    rets, ew = _ew(spark, d)
    x = stats.one_factor_alpha(ew, panel.universe(rets, 1, MIN_DV))
    return x.select(*[rnd(c).alias(c) for c in ("alpha", "t", "beta")], "months")


def sql_alpha(name: str, of: str, by: str = "one") -> str:
    """``by, alpha_mean, alpha_t, beta_market, beta_size, beta_momentum, n`` by Cramer's rule on the covariances of a series ``by, k, m, r``."""
    det = "(aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac))"
    return f"""
{name}_x AS (SELECT {by}, g.k, g.r - {RF_SQL.replace("substr(m", "substr(g.m")} AS y, uni.r - {RF_SQL.replace("substr(m", "substr(g.m")} AS a, s.spread AS b, c.spread AS c
  FROM {of} g JOIN uni ON uni.m = g.m JOIN fac s ON s.m = g.m AND s.fac = 'dv' JOIN fac c ON c.m = g.m AND c.fac = 'mom'),
{name}_c AS (SELECT {by}, var_pop(a) AS aa, var_pop(b) AS bb, var_pop(c) AS cc, covar_pop(a, b) AS ab, covar_pop(a, c) AS ac, covar_pop(b, c) AS bc, covar_pop(y, a) AS ya, covar_pop(y, b) AS yb,
  covar_pop(y, c) AS yc, count(*) AS n FROM {name}_x GROUP BY {by}),
{name}_f AS (SELECT {by}, n, (ya * (bb * cc - bc * bc) - ab * (yb * cc - bc * yc) + ac * (yb * bc - bb * yc)) / {det} AS b1,
  (aa * (yb * cc - bc * yc) - ya * (ab * cc - bc * ac) + ac * (ab * yc - yb * ac)) / {det} AS b2, (aa * (bb * yc - yb * bc) - ab * (ab * yc - yb * ac) + ya * (ab * bc - bb * ac)) / {det} AS b3 FROM {name}_c),
{name}_g AS (SELECT {by}, k, y - b1 * a - b2 * b - b3 * c AS r FROM {name}_x JOIN {name}_f USING ({by}) WHERE n >= 30),
{name}_z AS (SELECT DISTINCT k, 0.0::DOUBLE AS r FROM {name}_g),
{name} AS (SELECT {by}, ex_mean AS alpha_mean, ex_t AS alpha_t, b1 AS beta_market, b2 AS beta_size, b3 AS beta_momentum, n FROM {sql_excess(by, f"{name}_g", f"{name}_z")} JOIN {name}_f USING ({by}))"""


def sql_excess(by: str, grid: str = "grid", bench: str = "uni") -> str:
    """``by, ex_months, ex_mean, ex_t`` of a grid over a benchmark series."""
    return f"""(SELECT {by}, count(*) AS ex_months, avg(v) AS ex_mean,
    avg(v) / sqrt(greatest((sum(e * e) + 1.5 * coalesce(sum(e * e1), 0) + 1.0 * coalesce(sum(e * e2), 0) + 0.5 * coalesce(sum(e * e3), 0)) / count(*), 1e-15) / count(*)) AS ex_t
  FROM (SELECT *, lag(e, 1) OVER w AS e1, lag(e, 2) OVER w AS e2, lag(e, 3) OVER w AS e3 FROM (
    SELECT g.*, g.r - u.r AS v, g.r - u.r - avg(g.r - u.r) OVER (PARTITION BY {", ".join("g." + c for c in by.split(", "))}) AS e FROM {grid} g JOIN {bench} u ON u.k = g.k)
    WINDOW w AS (PARTITION BY {by} ORDER BY k)) GROUP BY {by})"""


@query(
    f"SELECT {r4('alpha_mean')} AS alpha, {r4('alpha_t')} AS t, {r4('beta_market')} AS beta_market, {r4('beta_size')} AS beta_size, {r4('beta_momentum')} AS beta_momentum, n AS months FROM al",
    *EW, UNIVERSE, SQL_FACTORS, "ew1 AS (SELECT 1 AS one, * FROM ew)", sql_alpha("al", "ew1"),
)
def factor_alpha_3(spark, d):
    """Alpha on market, size and momentum."""
    rets, ew = _ew(spark, d)
    f = panel.universe(rets, 1, MIN_DV).select("m", F.col("r").alias("market"))
    for by, name in (("dv", "size"), ("mom", "momentum")):
        f = f.join(panel.tercile_spread(rets, by, by == "dv", MIN_DV).select("m", F.col("spread").alias(name)), "m", "left")
    x = stats.factor_alpha(ew, f, ["market", "size", "momentum"])
    return x.select(*[rnd(c).alias(c) for c in x.columns if c != "months"], "months")


# --- slices ------------------------------------------------------------------------------------------------------

@query(
    "\nUNION ALL ".join(f"SELECT {i} AS lag, count(*) AS months, {r4('avg(r)')} AS mean FROM l{i}" for i in range(3)),
    *PANEL, SQL_SIGNALS, "mx AS (SELECT max(k) AS mk FROM mon)",
    *[sql_portfolio(f"l{i}", f"SELECT ticker, unnest(range(k + {i}, k + {i} + {HOLD})) FROM sig JOIN mon USING (m), mx WHERE k + {i} <= mk", MIN_NAMES) for i in range(3)],
)
def entry_lag(spark, d):
    """The portfolio when signals are taken 0, 1 or 2 months late."""
    rets, sig = _rets(spark, d), _signals(spark, d)
    out = None
    for i in range(3):
        p = panel.portfolio(rets, panel.shifted(sig, rets, i), HOLD, MIN_DV, MIN_NAMES)
        row = p.agg(F.lit(i).alias("lag"), F.count("*").alias("months"), rnd(F.avg("r")).alias("mean"))
        out = row if out is None else out.unionByName(row)
    return out


STEPS = (50_000, 70_000, 90_000)


@query(
    "\nUNION ALL ".join(f"SELECT {v} AS least, count(*) AS months, {r4('avg(r)')} AS mean FROM t{v}" for v in STEPS),
    *PANEL,
    *[f"g{v} AS (SELECT DISTINCT l_suppkey AS ticker, strftime(l_shipdate, '%Y-%m') AS m FROM lineitem WHERE l_returnflag = 'R' AND l_extendedprice >= {v})," + sql_portfolio(f"t{v}", sql_held(HOLD, f"g{v}"), MIN_NAMES) for v in STEPS],
)
def threshold_ladder(spark, d):
    """The portfolio by the least size of a purchase."""
    rets, out = _rets(spark, d), None
    for v in STEPS:
        p = panel.portfolio(rets, _signals(spark, d, v), HOLD, MIN_DV, MIN_NAMES)
        row = p.agg(F.lit(v).alias("least"), F.count("*").alias("months"), rnd(F.avg("r")).alias("mean"))
        out = row if out is None else out.unionByName(row)
    return out


# --- owners and gates --------------------------------------------------------------------------------------------


@query("SELECT owner, count(*) AS n, min(tdate) AS first, max(tdate) AS last, count(*) FILTER (code = 'P') AS buys FROM trades GROUP BY owner", SQL_TRADES)
def owner_history(spark, d):
    """What an owner has traded."""
    return owners.summary(tpch.trades(spark, d))


ROW = ["acc", "line", "ticker", "owner", "tdate", "code", "val"]


@query(
    """SELECT acc, line, ticker, owner, tdate, code, val, CASE WHEN year(tdate) - year(first) >= 3 THEN
  list_contains(ms, strftime(tdate - INTERVAL 1 YEAR, '%Y-') || strftime(tdate, '%m')) AND list_contains(ms, CAST(year(tdate) - 2 AS VARCHAR) || strftime(tdate, '-%m'))
  AND list_contains(ms, CAST(year(tdate) - 3 AS VARCHAR) || strftime(tdate, '-%m')) END AS routine
FROM trades JOIN (SELECT owner, min(tdate) AS first, list(DISTINCT strftime(tdate, '%Y-%m')) AS ms FROM trades GROUP BY owner) USING (owner)""",
    SQL_TRADES,
)
def cmp_routine(spark, d):
    """Traded in the same month of each of the three years before."""
    return owners.with_past(tpch.trades(spark, d)).select(*ROW, "routine")


def sql_regular(name: str, key: str, rows: str = "trades") -> str:
    """The days of each key on which a trade is regular: its last four earlier trades by their running numbers."""
    return f"""
{name}_n AS (SELECT {key}, tdate, row_number() OVER (PARTITION BY {key} ORDER BY tdate) AS rn FROM {rows}),
{name}_d AS (SELECT {key}, tdate, min(rn) - 1 AS p FROM {name}_n GROUP BY {key}, tdate),
{name}_s AS (SELECT {key}, d.tdate, n.tdate AS before FROM {name}_d d JOIN {name}_n n USING ({key}) WHERE n.rn BETWEEN d.p - 3 AND d.p),
{name}_g AS (SELECT {key}, tdate, len(ds) AS n, list_transform(range(1, len(ds)), lambda i: CAST(ds[i + 1] - ds[i] AS DOUBLE)) AS g FROM (
  SELECT {key}, tdate, list_append(list_sort(list(before)), tdate) AS ds FROM {name}_s GROUP BY {key}, tdate)),
{name} AS (SELECT {key}, tdate, n >= 4 AND list_min(g) > 0 AND list_max(g) <= 200 AND list_avg(g) >= 20 AND list_stddev_pop(g) / list_avg(g) < 0.25 AS regular FROM {name}_g)"""


@query(
    "SELECT ticker, code, tdate, coalesce(regular, false) AS regular FROM reg_d LEFT JOIN reg USING (ticker, code, tdate)",
    SQL_TRADES, "st0 AS (SELECT owner % 40 AS ticker, tdate, code FROM trades)", sql_regular("reg", "ticker, code", "st0"),
)
def regular_series(spark, d):
    """Trades at even distances; forty pooled owners, so that series are long."""
    x = tpch.trades(spark, d).select((F.col("owner") % 40).alias("ticker"), "tdate", "code")
    return owners.with_regular(x, ("ticker", "code")).select("ticker", "tdate", "code", "regular").distinct()


@query(ORACLE_SQL["regular_series"])
def regular_series_all(spark, d):
    """``regular_series``, which reads all trades itself; the name is kept."""
    return regular_series(spark, d)


@query(
    """SELECT acc, line, ticker, owner, tdate, code, val, CASE WHEN first IS NULL THEN NULL WHEN buys = 0 THEN 'first-ever' WHEN tdate - first >= 1095 AND recent = 0 THEN 'first-in-3y' END AS inflection
FROM (SELECT t.*, (SELECT min(h.tdate) FROM trades h WHERE h.owner = t.owner AND h.tdate < t.tdate) AS first,
  (SELECT count(*) FROM trades h WHERE h.owner = t.owner AND h.tdate < t.tdate AND h.code = 'P') AS buys,
  (SELECT count(*) FROM trades h WHERE h.owner = t.owner AND h.tdate < t.tdate AND h.code = 'P' AND h.tdate >= t.tdate - 1095) AS recent FROM trades t)""",
    SQL_TRADES,
)
def inflection(spark, d):
    """First purchase ever or in three years."""
    return owners.with_past(tpch.trades(spark, d)).select(*ROW, F.col("first").alias("inflection"))


SQL_GROUPS = "grp AS (SELECT c_custkey AS owner, c_custkey - c_custkey % 7 AS g FROM customer WHERE c_custkey % 2 = 0)"
SQL_SYNC = "sy AS (SELECT ticker, tdate, px, count(DISTINCT coalesce(g, owner)) AS sync FROM trades LEFT JOIN grp USING (owner) GROUP BY ALL)"


def _groups(spark, d):
    """Half the customers in groups of owners who file together."""
    c = F.col("c_custkey")
    return table(spark, d, "customer").where(c % 2 == 0).select(c.alias("node"), (c - c % 7).alias("component"))


@query("SELECT acc, line, t.ticker, t.tdate, t.px, sync FROM trades t JOIN sy USING (ticker, tdate, px)", SQL_TRADES, SQL_GROUPS, SQL_SYNC)
def sync_filings(spark, d):
    """How many owner groups traded a ticker on a day at exactly one price."""
    return owners.sync_count(tpch.trades(spark, d), _groups(spark, d)).select("acc", "line", "ticker", "tdate", "px", "sync")


@query("SELECT day, orderpriority, sum(sync) AS sync, count(*) AS n FROM (SELECT o.day, o.orderpriority, s.sync FROM o JOIN (SELECT day, orderpriority, price, count(DISTINCT coalesce(g, owner)) AS sync FROM o LEFT JOIN grp USING (owner) GROUP BY ALL) s USING (day, orderpriority, price)) GROUP BY ALL",
    "o AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS orderpriority, floor(o_totalprice / 100000) AS price, o_custkey AS owner FROM orders)", SQL_GROUPS)
def sync_orders(spark, d):
    """The same of orders by day and priority, whose prices are coarse, so that many meet."""
    x = table(spark, d, "orders").select(F.col("o_orderpriority").alias("ticker"), F.col("o_orderdate").cast("date").alias("tdate"), (F.floor(F.col("o_totalprice") / 100000) + 1).cast("double").alias("px"), F.col("o_custkey").alias("owner"))
    x = owners.sync_count(x, _groups(spark, d))
    return x.groupBy(F.col("tdate").alias("day"), F.col("ticker").alias("orderpriority")).agg(F.sum("sync").alias("sync"), F.count("*").alias("n"))


@query(
    f"""SELECT ticker, CAST(n AS INTEGER) AS n, {r4('med')} AS med, {r4('iqr')} AS iqr, abs(med - 1) > 0.15 AND iqr < 0.1 AS mismatch FROM (
  SELECT ticker, n, s[least(n, n // 2 + 1)] AS med, (s[least(n, CAST(floor(0.75 * n) AS BIGINT) + 1)] - s[least(n, CAST(floor(0.25 * n) AS BIGINT) + 1)]) / s[least(n, n // 2 + 1)] AS iqr
  FROM (SELECT t.ticker, count(*) AS n, list_sort(list(px / close)) AS s FROM (SELECT * FROM trades WHERE code = 'P') t ASOF JOIN bars b ON t.ticker = b.ticker AND t.tdate >= b.d WHERE px > 0 AND close > 0 GROUP BY t.ticker HAVING count(*) >= 5))""",
    SQL_BARS, SQL_TRADES,
)
def units_mismatch(spark, d):
    """Tickers whose purchase prices are off by one factor."""
    x = asof.as_of(tpch.trades(spark, d), _bars(spark, d), "tdate").withColumn("close", F.col("bar.close"))
    return owners.units_mismatch(x).select("ticker", "n", rnd("med").alias("med"), rnd("iqr").alias("iqr"), "mismatch")


@query(
    """, e AS (SELECT a, b FROM ed UNION SELECT b, a FROM ed), reach(a, b) AS (SELECT a, a FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a), comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT size, count(*) AS groups FROM (SELECT c, count(*) AS size FROM comp GROUP BY c) GROUP BY size""",
    "RECURSIVE mb AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS kind, o_orderkey % 5 AS part, o_custkey AS c FROM orders)",
    "ed AS (SELECT DISTINCT a, c AS b FROM (SELECT c, min(c) OVER (PARTITION BY day, kind, part) AS a FROM mb) WHERE a <> c)",
)
def owner_groups(spark, d):
    """Sizes of components of owners who filed together: every member of every group of orders, linked to the group's smallest."""
    keys = [F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderpriority").alias("kind"), (F.col("o_orderkey") % 5).alias("part")]
    x = table(spark, d, "orders").select("o_custkey", *keys).distinct()
    least = x.groupBy("day", "kind", "part").agg(F.min("o_custkey").alias("a"))
    edges = x.join(least, ["day", "kind", "part"]).where("a <> o_custkey").select("a", F.col("o_custkey").alias("b"))
    found = connected_components(edges, "a", "b")
    return found.groupBy("component").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("groups"))


@query(ORACLE_SQL["owner_groups"])
def owner_groups_all(spark, d):
    """``owner_groups``, which links every member itself; the name is kept."""
    return owner_groups(spark, d)


SQL_SPLITS = "sp AS (SELECT p_partkey % 100 + 1 AS ticker, DATE '1993-01-01' + CAST(p_partkey % 2000 AS INTEGER) AS d, CASE WHEN p_size % 2 = 0 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END AS ratio FROM part WHERE p_size >= 45)"


def _splits(spark, d):
    """Splits of half the tickers' histories, made of the larger parts."""
    return table(spark, d, "part").where("p_size >= 45").select(
        (F.col("p_partkey") % 100 + 1).alias("ticker"), F.date_add(F.lit("1993-01-01").cast("date"), (F.col("p_partkey") % 2000).cast("int")).alias("d"), F.when(F.col("p_size") % 2 == 0, 2.0).otherwise(0.5).alias("ratio")
    )


#: Verdicts are made for so many order lines at once, tickers by their hash: all but an owner's past stays within a ticker.
#: Trades and bars of so many parts are taken from the tables in one go.
LINES_A_PART, PARTS_A_ROUND = 8_000_000, 4


def _flagged(x):
    """Trades with the flags that a filing carries, a role, and a form of ownership."""
    return x.withColumns({
        "plan_box": F.col("acc") % 10 == 0, "fn_b5": (F.col("acc") % 7 == 0) & (F.col("line") == 3), "fn_wavg": F.col("line") == 1, "fund_only": F.col("owner") % 50 == 0,
        "di": F.when(F.col("line") == 2, "I").otherwise("D"), "role": F.substring(F.lit("FCDOTX"), (F.col("line") % 6 + 1).cast("int"), F.lit(1)),
    })


#: Prices here are noise without a memory: a bar lies far below its yearly high, so the working set's limits are lower than for companies.
LIMITS = gates.Limits(set_dd=-0.95, set_adv=1e4)
DEPTHS = (-0.8, -0.9, -0.95, -0.97, -0.99)


def _in_parts(spark, d, rows, monthly: bool = False):
    """``rows`` (of a part's verdicts and bars) as a table, made part by part so that the shuffles and tables of one part are on disk at a time; with ``monthly``, also the panel of all bars with returns."""
    parts = max(1, -(-table(spark, d, "lineitem").count() // LINES_A_PART))
    part = F.pmod(F.xxhash64("ticker"), F.lit(parts)).cast("int")
    made = {"rows": [], "panel": []}
    with shuffles_freed(spark), scratch(spark) as kept:
        past = cut(owners.owner_days(tpch.trades(spark, d), part=part), "past")
        for first in range(0, parts, PARTS_A_ROUND):
            last = min(parts, first + PARTS_A_ROUND) - 1
            with scratch(spark) as keep:
                those = lambda x: x.where(part.between(first, last)).withColumn("part", part)  # noqa: E731, B023
                bars = written(those(tpch.numbered(tpch.bars(spark, d))), "bars", by=("part",))[0]
                trades = written(those(_flagged(tpch.trades(spark, d))), "trades", by=("part",))[0]
                for j in range(first, last + 1):
                    with scratch(spark) as own:
                        b, t = (x.where(F.col("part") == j).drop("part") for x in (bars, trades))
                        x = compute.verdicts(t, b, LIMITS, _splits(spark, d).where(part == j), _groups(spark, d), past=past.where(F.col("part") == j))
                        for name, df in ({"rows": rows(x, b)} | ({"panel": panel.monthly(b)} if monthly else {})).items():
                            found, path = written(df, name)
                            made[name].append((found.schema, path))
                            keep.add(path)
                            own.add(path)
        kept.update(path for _, path in made["rows"])
        whole = lambda name: spark.read.schema(made[name][0][0]).parquet(*[path for _, path in made[name]])
        if not monthly:
            return whole("rows")
        rets, path = written(panel.with_returns(whole("panel")), "returns")
        kept.add(path)
        return whole("rows"), rets


SQL_VERDICTS = f"""
adv0 AS (SELECT ticker, d, i, close, adv FROM bars JOIN advs USING (ticker, d, i)),
fl AS (SELECT *, acc % 10 = 0 OR (acc % 7 = 0 AND line = 3) AS planned, line = 1 AS fn_wavg, owner % 50 = 0 AS fund_only, CASE WHEN line = 2 THEN 'I' ELSE 'D' END AS di,
  substr('FCDOTX', CAST(line % 6 + 1 AS BIGINT), 1) AS role FROM trades),
dy AS (SELECT ticker, tdate, coalesce((SELECT product(ratio) FROM sp WHERE sp.ticker = q.ticker AND sp.d > q.tdate), 1) AS f,
  (SELECT max(close) FROM bars x WHERE x.ticker = q.ticker AND x.d BETWEEN q.tdate - 365 AND q.tdate) AS hi FROM (SELECT DISTINCT ticker, tdate FROM trades) q),
ctx AS (SELECT t.*, {r4("b.close * dy.f")} AS close, b.adv, coalesce(b.i + 1, 0) AS hist_days, CASE WHEN b.i >= 30 AND hi > 0 AND b.close > 0 THEN {r4("b.close / hi - 1")} END AS dd
  FROM fl t JOIN dy ON dy.ticker = t.ticker AND dy.tdate = t.tdate ASOF LEFT JOIN adv0 b ON t.ticker = b.ticker AND t.tdate >= b.d),
oh AS (SELECT owner, min(tdate) AS began, list(DISTINCT strftime(tdate, '%Y-%m')) AS ms FROM trades GROUP BY owner),
od AS (SELECT owner, tdate, max(code = 'P') AS b FROM trades GROUP BY owner, tdate),
pa AS (SELECT *, (SELECT min(h.tdate) FROM od h WHERE h.owner = q.owner AND h.tdate < q.tdate) AS f0, (SELECT max(h.tdate) FROM od h WHERE h.owner = q.owner AND h.tdate < q.tdate AND h.b) AS l0 FROM od q),
un AS (SELECT ticker, abs(med - 1) > 0.15 AND (hi - lo) / med < 0.1 AS units FROM (
  SELECT ticker, s[least(n, n // 2 + 1)] AS med, s[least(n, CAST(floor(0.75 * n) AS BIGINT) + 1)] AS hi, s[least(n, CAST(floor(0.25 * n) AS BIGINT) + 1)] AS lo
  FROM (SELECT ticker, count(*) AS n, list_sort(list(px / close)) AS s FROM ctx WHERE code = 'P' AND px > 0 AND close > 0 GROUP BY ticker HAVING count(*) >= 5))),
c2 AS (SELECT ctx.*, sync, coalesce(regular, false) AS regular, coalesce(units, false) AS units,
  CASE WHEN year(tdate) - year(began) >= 3 THEN list_contains(ms, CAST(year(tdate) - 1 AS VARCHAR) || strftime(tdate, '-%m'))
    AND list_contains(ms, CAST(year(tdate) - 2 AS VARCHAR) || strftime(tdate, '-%m')) AND list_contains(ms, CAST(year(tdate) - 3 AS VARCHAR) || strftime(tdate, '-%m')) END AS routine,
  CASE WHEN f0 IS NULL THEN NULL WHEN l0 IS NULL THEN 'first-ever' WHEN tdate - f0 >= 1095 AND l0 < tdate - 1095 THEN 'first-in-3y' END AS first
  FROM ctx JOIN sy USING (ticker, tdate, px) JOIN oh USING (owner) JOIN pa USING (owner, tdate) LEFT JOIN own USING (owner, ticker, code, tdate) LEFT JOIN un USING (ticker)),
gated AS (SELECT *, CASE WHEN (px > 0 AND (px < 1e-4 OR px > 1e5)) OR val > 1e10 OR sh > 3e9 THEN 'badvalue'
  WHEN regexp_matches(sec, '{S.NON_COMMON_PATTERN}') THEN 'security' WHEN units THEN 'units' WHEN hist_days < 20 THEN 'newlisting' WHEN close IS NOT NULL AND adv IS NULL THEN 'noliq'
  WHEN adv > 0 AND val > adv * 300 THEN 'capacity' WHEN close <> 0 AND px <> 0 AND (px / close < 0.1 OR px / close > 10) THEN 'outlier'
  WHEN close <> 0 AND px <> 0 AND code = 'P' AND px / close < 1 - CASE WHEN fn_wavg THEN 0.15 ELSE 0.08 END::DOUBLE THEN 'discount'
  WHEN sync >= 3 THEN 'sync' WHEN fund_only THEN 'fund' WHEN planned THEN 'planned' WHEN routine THEN 'routine' WHEN regular THEN 'regular' END AS "drop" FROM c2),
feat AS (SELECT *, "drop" IS NULL AS ok, CASE WHEN "drop" IS NULL THEN first END AS inflection,
  CASE WHEN adv IS NULL THEN 'н/д' WHEN adv < 3e6 THEN 'micro' WHEN adv < 3e7 THEN 'small' WHEN adv < 3e8 THEN 'mid' ELSE 'large' END AS bucket,
  coalesce("drop" IS NULL AND dd >= -0.95 AND val >= 5e4 AND adv >= 1e4, false) AS in_set FROM gated)"""
GATES = (SQL_BARS, SQL_ADV, SQL_TRADES, SQL_SPLITS, SQL_GROUPS, SQL_SYNC, sql_regular("own", "owner, ticker, code"), SQL_VERDICTS)


@query(
    """SELECT acc, line, ticker, owner, tdate, code, val, "drop", "drop" IS NULL AS ok,
  CASE WHEN "drop" IS NULL THEN concat_ws(',', CASE WHEN close IS NULL THEN 'no-price' END, CASE WHEN line = 2 THEN 'indirect' END, CASE WHEN routine IS NULL THEN 'no-history' END) ELSE '' END AS tags FROM gated""",
    *GATES,
)
def gate_cascade(spark, d):
    """Every trade with its first broken rule and its tags."""
    return _in_parts(spark, d, lambda x, b: x.select(*ROW, "drop", "ok", F.array_join("tags", ",").alias("tags")))


@query("SELECT coalesce(\"drop\", 'ok') AS reason, count(*) AS n FROM gated GROUP BY reason", *GATES)
def gate_drop_counts(spark, d):
    """Trades by reason."""
    return _in_parts(spark, d, lambda x, b: slices.drop_counts(x)).groupBy("reason").agg(F.sum("n").alias("n"))


# --- positions, feed, queues -------------------------------------------------------------------------------------


@query(
    """, days AS (SELECT user_id AS u, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY ALL),
num AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY d) AS i FROM days),
fold AS (SELECT u, d, n, i, d AS first FROM num WHERE i = 1
  UNION ALL SELECT num.u, num.d, num.n, num.i, CASE WHEN num.d - fold.first > 7 THEN num.d ELSE fold.first END FROM fold JOIN num ON num.u = fold.u AND num.i = fold.i + 1)
SELECT u AS user_id, first, max(d) AS last, sum(n)::BIGINT AS n FROM fold GROUP BY u, first""",
    "RECURSIVE one AS (SELECT 1)",
)
def positions_events(spark, d):
    """Positions of seven days, anchored at their first day."""
    x = positions.positions(table(spark, d, "events").withColumn("day", F.col("ts").cast("date")), "user_id", "day", hold_days=7)
    return x.select("user_id", "first", "last", "n")


@query(
    """SELECT acc, line, ticker, tdate, val FROM trades WHERE code = 'P' AND val BETWEEN 50000 AND 250000 AND contains(CAST(ticker AS VARCHAR), '1') AND form IN ('4')""", SQL_TRADES
)
def feed_filter(spark, d):
    """The feed's query: range, role and substring."""
    x = tpch.trades(spark, d).withColumn("ok", F.col("code") == "P").withColumn("role", F.col("form"))
    return slices.feed_filter(x, "ok", ["4"], (5e4, 2.5e5), text="1").select("acc", "line", "ticker", "tdate", "val")


@query("SELECT fdate, val, acc, line, ticker FROM trades ORDER BY fdate DESC, val DESC, acc, line, ticker LIMIT 100", SQL_TRADES)
def feed_topk(spark, d):
    """The first page of the feed."""
    x = tpch.trades(spark, d).select("fdate", "val", "acc", "line", "ticker")
    return slices.page(x, [F.desc("fdate"), F.desc("val"), F.col("acc"), F.col("line"), F.col("ticker")])


@query(
    """SELECT ticker, w, big, first, last, w + big * 1e6 AS pri FROM (
  SELECT ticker, CAST(sum(CAST(least(5e7, val) AS DECIMAL(18,2))) AS DOUBLE) AS w, count(*) FILTER (val >= 2.5e5 AND val < 5e7) AS big, min(tdate) AS first, max(tdate) AS last
  FROM trades WHERE code = 'P' AND ticker NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000) GROUP BY ticker) ORDER BY pri DESC, ticker LIMIT 40""",
    SQL_TRADES,
)
def refresh_queue(spark, d):
    """Tickers without prices, the heaviest first."""
    have = table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("ticker"))
    return slices.refresh_queue(tpch.trades(spark, d), have, 40)


@query(
    f"""SELECT year(tdate) AS year, count(*) AS buys, count(*) FILTER (close IS NULL) AS missing, {r4('count(*) FILTER (close IS NULL) / count(*)')} AS share
FROM (SELECT * FROM trades WHERE code = 'P') t ASOF LEFT JOIN bars b ON t.ticker = b.ticker AND t.tdate >= b.d GROUP BY year""",
    SQL_BARS, SQL_TRADES,
)
def survival_by_year(spark, d):
    """Purchases by year, and how many have no price."""
    x = asof.as_of(tpch.trades(spark, d).where("code = 'P'"), tpch.bars(spark, d), "tdate")
    n, gone = F.count("*"), F.count_if(F.col("bar").isNull())
    return x.groupBy(F.year("tdate").cast("long").alias("year")).agg(n.alias("buys"), gone.alias("missing"), rnd(gone / n).alias("share"))


# --- the batch job -----------------------------------------------------------------------------------------------


@query(
    f"""SELECT acc, line, ent.ticker, tdate, val, CASE WHEN e.i < li THEN {r4('la / e.adj - 1')} END AS chg, {r4('la / b.adj - 1')} AS chg_trade
FROM ent LEFT JOIN bars e ON e.ticker = ent.ticker AND e.i = ent.ei LEFT JOIN (SELECT ticker, max(i) AS li, max_by(adj, i) AS la FROM bars GROUP BY ticker) l ON l.ticker = ent.ticker
ASOF LEFT JOIN bars b ON b.ticker = ent.ticker AND ent.tdate >= b.d""",
    SQL_BARS, SQL_TRADES, SQL_ENTRY,
)
def change_since_entry(spark, d):
    """Change from the entry, and from the trade, to the last bar."""
    return compute.change_since(tpch.trades(spark, d), _bars(spark, d)).select("acc", "line", "ticker", "tdate", "val", "chg", "chg_trade")


@query(
    """SELECT o_orderkey, ticker, day, CASE WHEN fd IS NULL OR day - ld < fd - day THEN ld ELSE fd END AS d, CASE WHEN fd IS NULL OR day - ld < fd - day THEN lc ELSE fc END AS close
FROM (SELECT p.*, a.d AS ld, a.close AS lc FROM p ASOF LEFT JOIN bars a ON a.ticker = p.ticker AND p.day >= a.d)
JOIN (SELECT p.o_orderkey, b.d AS fd, b.close AS fc FROM p ASOF LEFT JOIN bars b ON b.ticker = p.ticker AND p.day <= b.d) USING (o_orderkey) WHERE ld IS NOT NULL OR fd IS NOT NULL""",
    SQL_BARS,
    "p AS (SELECT o_orderkey, o_custkey % 50 + 1 AS ticker, CAST(o_orderdate AS DATE) AS day FROM orders)",
)
def nearest_bar(spark, d):
    """The bar nearest to the day of every order, on either side; of two as near the later."""
    p = table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 50 + 1).alias("ticker"), F.col("o_orderdate").cast("date").alias("day"))
    return compute.nearest(p, _bars(spark, d), "day").where("near is not null").select("o_orderkey", "ticker", "day", "near.d", "near.close")


@query(ORACLE_SQL["nearest_bar"])
def nearest_bar_all(spark, d):
    """``nearest_bar``, which answers every order itself; the name is kept."""
    return nearest_bar(spark, d)


DIMS_SQL = """
st AS (SELECT ticker, strftime(fdate, '%Y-%m') AS m, p.dim AS dim, p.grp AS grp FROM (SELECT *, unnest([
    {'dim': 'set', 'grp': CASE WHEN ok THEN CASE WHEN in_set THEN 'set' ELSE 'outside' END END}, {'dim': 'gate', 'grp': coalesce("drop", 'ok')}, {'dim': 'all', 'grp': CASE WHEN ok THEN 'passed' END},
    {'dim': 'role', 'grp': CASE WHEN ok THEN role END}, {'dim': 'size', 'grp': CASE WHEN ok THEN CASE WHEN val < 5e4 THEN '<50k' WHEN val < 2.5e5 THEN '50k-250k' WHEN val < 1e6 THEN '250k-1m' ELSE '>1m' END END},
    {'dim': 'liquidity', 'grp': CASE WHEN ok THEN bucket END}, {'dim': 'routine', 'grp': CASE WHEN routine THEN 'routine' WHEN NOT routine THEN 'opportunistic' ELSE 'no history' END},
    {'dim': 'inflect', 'grp': CASE WHEN ok THEN coalesce(inflection, 'usual') END},
    {'dim': 'dd', 'grp': CASE WHEN ok THEN CASE WHEN dd IS NULL THEN 'none' WHEN dd <= -0.30 THEN 'deep' WHEN dd <= -0.15 THEN 'mid' WHEN dd >= -0.05 THEN 'high' ELSE 'low' END END},
    {'dim': 'year', 'grp': CASE WHEN ok THEN CAST(year(fdate) AS VARCHAR) END}]) AS p FROM feat WHERE code = 'P') WHERE p.grp IS NOT NULL)"""


def sql_grid(name: str, by: str, source: str, least: int = MIN_NAMES) -> str:
    """Monthly series of each ``by`` from a subquery ``by, ticker, k`` of what is held."""
    keys = ", ".join(f"h.{c}" for c in by.split(", "))
    return f"""
{name} AS (SELECT {keys}, h.k + 1 AS k, count(*) AS n, avg(next_ret) AS r FROM ({source}) h JOIN rets ON rets.ticker = h.ticker AND rets.k = h.k
  WHERE dv >= {MIN_DV} AND next_ret IS NOT NULL GROUP BY {keys}, h.k HAVING count(*) >= {least})"""


GRID = sql_grid("grid", "dim, grp, hold", "SELECT DISTINCT dim, grp, hold, ticker, unnest(range(k, k + hold)) AS k FROM st JOIN mon USING (m), (VALUES (3), (6), (12)) v(hold)")
SLICES = (*PANEL, *GATES[1:], DIMS_SQL, UNIVERSE, GRID)


def _slices(spark, d):
    """The panel with returns and the series of all ten dimensions for three holding periods."""
    st, rets = _in_parts(spark, d, lambda x, b: slices.stacked(x.where("code = 'P'"), compute.dimensions(x)).select("dim", "grp", "ticker", S.month("fdate").alias("m")).distinct(), True)
    return rets, slices.portfolio_grid(rets, st, (3, 6, 12), MIN_DV, MIN_NAMES)


@query(f"SELECT dim, grp, hold, count(*) AS months, {r4('avg(r)')} AS mean, min(n) AS least FROM grid GROUP BY dim, grp, hold", *SLICES)
def slice_grid(spark, d):
    """Portfolios of every slice of ten dimensions and three holding periods in one pass."""
    grid = _slices(spark, d)[1]
    return grid.groupBy("dim", "grp", "hold").agg(F.count("*").alias("months"), rnd(F.avg("r")).alias("mean"), F.min("n").alias("least"))


@query(
    f"""SELECT dim, grp, hold, months, avg_n, {r4('ex_mean')} AS ex_mean, floor(ex_t * 100 + 0.5) / 100 AS ex_t
FROM {sql_excess("dim, grp, hold")} JOIN (SELECT dim, grp, hold, count(*) AS months, floor(avg(n) + 0.5)::BIGINT AS avg_n FROM grid GROUP BY ALL) USING (dim, grp, hold) WHERE months >= 36""",
    *SLICES,
)
def slice_cells(spark, d):
    """Monthly excess over the universe and its t for every slice."""
    rets, grid = _slices(spark, d)
    uni = panel.universe(rets, 1, MIN_DV)
    return compute.cells(grid, uni, uni).select("dim", "grp", "hold", "months", "avg_n", "ex_mean", "ex_t")


def _factors(rets, uni):
    f = uni.select("m", F.col("r").alias("market"))
    for by, name in (("dv", "size"), ("mom", "momentum")):
        f = f.join(panel.tercile_spread(rets, by, by == "dv", MIN_DV).select("m", F.col("spread").alias(name)), "m", "left")
    return f


def two(x: str) -> str:
    return f"(floor(({x}) * 100 + 0.5) / 100)"


def year_of(mean: str) -> str:
    """A monthly mean over a year, rounded."""
    return r4(f"pow(1 + {mean}, 12) - 1")


@query(
    f"""SELECT dim, grp, hold, months, {r4('cagr')} AS cagr, {r4('vol')} AS vol, {r4('least(0, dd)')} AS dd, avg_n, CASE WHEN te > 0 THEN {two('dmean * 12 / te')} END AS ir, CASE WHEN v0 > 0 THEN {two('rmean * 12 / v0')} END AS sharpe,
  CASE WHEN early_n >= 24 THEN {year_of('early_mean')} END AS early, CASE WHEN months - early_n >= 24 THEN {year_of('late_mean')} END AS late, {r4('ex_mean')} AS ex_mean, {year_of('ex_mean')} AS ex, {two('ex_t')} AS ex_t,
  {year_of('ex_mean')} AS over_all, {two('ex_t')} AS over_all_t, {year_of('alpha_mean')} AS alpha, {two('alpha_t')} AS alpha_t, {two('beta_market')} AS beta_market, {two('beta_size')} AS beta_size, {two('beta_momentum')} AS beta_momentum, avg_n < 10 AS thin
FROM (SELECT dim, grp, hold, count(*) AS months, pow(product(1 + r), 12.0 / count(*)) - 1 AS cagr, coalesce(stddev_samp(r), 0) * sqrt(12) AS vol, min(eq / greatest(1, peak) - 1) AS dd, floor(avg(n) + 0.5)::BIGINT AS avg_n,
    sqrt(12 * var_pop(r - u)) AS te, avg(r - u) AS dmean, sqrt(12 * var_pop(r)) AS v0, avg(r - {RF_SQL}) AS rmean, count(*) FILTER (m < '2021-01') AS early_n, avg(r - u) FILTER (m < '2021-01') AS early_mean, avg(r - u) FILTER (m >= '2021-01') AS late_mean
  FROM (SELECT *, max(eq) OVER (PARTITION BY dim, grp, hold ORDER BY k) AS peak FROM (SELECT gm.*, uni.r AS u, product(1 + gm.r) OVER (PARTITION BY dim, grp, hold ORDER BY gm.k) AS eq FROM gm JOIN uni ON uni.k = gm.k)) GROUP BY ALL)
JOIN {sql_excess("dim, grp, hold")} USING (dim, grp, hold) LEFT JOIN al USING (dim, grp, hold) WHERE months >= 36""",
    *SLICES, SQL_FACTORS, "gm AS (SELECT grid.*, m FROM grid JOIN mon USING (k))", sql_alpha("al", "gm", "dim, grp, hold"),
)
def slice_cells_full(spark, d):
    """All statistics of every slice, with three-factor alphas."""
    rets, grid = _slices(spark, d)
    uni = panel.universe(rets, 1, MIN_DV)
    return compute.cells(grid, uni, uni, _factors(rets, uni))


NAMED = (*compute.SET, *compute.AVOID, *compute.REFERENCE)
SQL_NAMED = "nm AS (" + "\nUNION ALL ".join(f"SELECT '{k}' AS key, {h} AS hold, ticker, strftime(fdate, '%Y-%m') AS m FROM feat WHERE code = 'P' AND ({c.replace('drop', chr(34) + 'drop' + chr(34))})" for k, h, c in NAMED) + ")"
SQL_HELD = """
hd AS (SELECT DISTINCT key, hold, ticker, unnest(range(k, k + hold)) AS k FROM nm JOIN mon USING (m)),
hu AS (SELECT * FROM hd UNION ALL SELECT 'universe', 1, ticker, k FROM rets WHERE dv >= 1e4)"""
SQL_TURN = """
ln AS (SELECT hu.* FROM hu JOIN rets USING (ticker, k) WHERE dv >= 1e4 AND k < (SELECT max(k) FROM mon)),
sz AS (SELECT key, hold, k, count(*) AS n FROM ln GROUP BY ALL),
sy2 AS (SELECT a.key, a.hold, a.k, count(*) AS stay FROM ln a JOIN ln b ON a.key = b.key AND a.hold = b.hold AND a.ticker = b.ticker AND b.k = a.k - 1 GROUP BY ALL),
tu AS (SELECT key, hold, avg((a.n + b.n - 2 * coalesce(stay, 0)) / greatest(a.n, b.n)) AS t FROM sz a JOIN (SELECT key, hold, k + 1 AS k, n FROM sz) b USING (key, hold, k) LEFT JOIN sy2 USING (key, hold, k) GROUP BY key, hold)"""


@query(
    f"""SELECT key, hold, months, avg_n, signals, {r4('ex_mean')} AS ex_mean, floor(ex_t * 100 + 0.5) / 100 AS ex_t, {r4('t * 12')} AS turnover, {r4('t / 2 * 12 * 0.005')} AS cost
FROM {sql_excess("key, hold", "g2")} JOIN (SELECT key, hold, count(*) AS months, floor(avg(n) + 0.5)::BIGINT AS avg_n FROM g2 GROUP BY ALL) USING (key, hold)
LEFT JOIN (SELECT key, hold, count(*) AS signals FROM nm GROUP BY ALL) USING (key, hold) LEFT JOIN tu USING (key, hold) WHERE months >= 36
UNION ALL SELECT 'index', 0, count(*), 1, NULL, 0, NULL, NULL, NULL FROM uni""",
    *PANEL, *GATES[1:], UNIVERSE, SQL_NAMED, SQL_HELD, sql_grid("g1", "key, hold", "SELECT * FROM hd"),
    "g2 AS (SELECT * FROM g1 UNION ALL SELECT 'universe', 1, k, n, r FROM uni)", SQL_TURN,
)
def set_cells(spark, d):
    """The working set, the slices to avoid, all that passed, the universe and the index, side by side."""
    named, rets = _in_parts(spark, d, lambda x, b: compute.named_months(x.where("code = 'P'"), NAMED), True)
    uni = panel.universe(rets, 1, MIN_DV)
    x = compute.cells_of_sets(named, rets, uni, None, MIN_DV, MIN_NAMES)
    return x.select("key", "hold", "months", "avg_n", "signals", "ex_mean", "ex_t", "turnover", "cost")


LADDER = [(f"depth {x}", f"val >= 5e4 AND dd >= {x}") for x in DEPTHS] + [(f"size {x}", f"val >= {x} AND dd >= -0.95") for x in compute.SIZES]


@query(
    f"""SELECT string_split(key, ' ')[1] AS ladder, CAST(string_split(key, ' ')[2] AS DOUBLE) AS step, months, {r4('ex_mean')} AS ex_mean, floor(ex_t * 100 + 0.5) / 100 AS ex_t
FROM {sql_excess("key, hold", "g1")} JOIN (SELECT key, hold, count(*) AS months FROM g1 GROUP BY ALL) USING (key, hold) WHERE months >= 36""",
    *PANEL, *GATES[1:], UNIVERSE,
    "nm AS (" + "\nUNION ALL ".join(f"SELECT '{k}' AS key, 3 AS hold, ticker, strftime(fdate, '%Y-%m') AS m FROM feat WHERE code = 'P' AND ok AND adv >= 1e4 AND {c}" for k, c in LADDER) + ")",
    SQL_HELD, sql_grid("g1", "key, hold", "SELECT * FROM hd"),
)
def set_ladders(spark, d):
    """The working set with its depth and its least size moved in steps."""
    named, rets = _in_parts(spark, d, lambda x, b: compute.named_months(x.where("code = 'P'"), compute.steps(LIMITS, depths=DEPTHS)), True)
    x = compute.ladders_of(named, rets, panel.universe(rets, 1, MIN_DV), MIN_DV, MIN_NAMES)
    return x.select("ladder", "step", "months", "ex_mean", "ex_t")


@query(
    """SELECT acc, line, ticker, owner, tdate, code, val, close, CAST(hist_days AS INTEGER) AS hist_days, adv, bucket, dd, sync, routine, regular, CASE WHEN units THEN true END AS units, planned,
  inflection, "drop", ok, in_set, entry_day, entry_px FROM feat JOIN (
    SELECT DISTINCT ent.ticker, ent.fdate, e.d AS entry_day, """
    + r4("e.close * coalesce((SELECT product(ratio) FROM sp WHERE sp.ticker = e.ticker AND sp.d > e.d), 1)")
    + """ AS entry_px FROM ent LEFT JOIN bars e ON e.ticker = ent.ticker AND e.i = ent.ei) USING (ticker, fdate)""",
    *GATES, SQL_ENTRY,
)
def trade_features(spark, d):
    """Every trade with all features, its gate and whether it is in the working set."""
    verdict = [*ROW, "close", "hist_days", "adv", "bucket", "dd", "sync", "routine", "regular", "units", "planned", "inflection", "drop", "ok", "in_set"]
    entered = lambda x, b: compute.entries(cut(x.select(*verdict, "fdate", "px", "split"), "verdicts"), b, _splits(spark, d))
    return _in_parts(spark, d, lambda x, b: entered(x, b).select(*verdict, "entry_day", "entry_px"))


@query(
    """SELECT acc, line, ticker, tdate, fdate, val, CASE WHEN tdate < fdate THEN len(list_filter(range(CAST(tdate AS TIMESTAMP), CAST(fdate AS TIMESTAMP), INTERVAL 1 DAY), lambda x: isodow(x) < 6)) ELSE 0 END AS delay,
  DATE '1998-12-31' - fdate AS age, coalesce(entry_day, fdate) + 90 AS exit
FROM (SELECT ent.*, e.d AS entry_day FROM ent LEFT JOIN bars e ON e.ticker = ent.ticker AND e.i = ent.ei) WHERE fdate >= DATE '1998-12-31' - 200""",
    SQL_BARS, SQL_TRADES, SQL_ENTRY,
)
def feed_rows(spark, d):
    """Recent trades as the feed shows them."""
    x = series.entry_features(tpch.trades(spark, d), _bars(spark, d))
    x = compute.feed(x, F.lit(AS_OF).cast("date"))
    return x.select("acc", "line", "ticker", "tdate", "fdate", "val", F.col("delay").cast("long").alias("delay"), F.col("age").cast("long").alias("age"), "exit")


@query(
    """SELECT ticker, max(why) AS why FROM (
  SELECT ticker, 'recent' AS why FROM b WHERE f >= DATE '1998-12-31' - 760
  UNION ALL SELECT s_suppkey, 'again' FROM supplier WHERE s_suppkey % 3 = 0 AND s_suppkey % 5 < 4 AND s_suppkey IN (SELECT ticker FROM b)
  UNION ALL SELECT ticker, 'stale' FROM (SELECT s.ticker FROM (SELECT l_suppkey AS ticker, max(CAST(l_shipdate AS DATE)) - CAST(l_suppkey % 60 AS INTEGER) AS last FROM lineitem GROUP BY l_suppkey) s
    WHERE last < DATE '1998-12-31' - 20 AND ticker % 2 = 0 AND ticker IN (SELECT ticker FROM b) ORDER BY last, ticker LIMIT 20)) GROUP BY ticker""",
    SQL_TRADES, "b AS (SELECT ticker, max(fdate) - 660 AS f FROM trades WHERE code = 'P' GROUP BY ticker)",
)
def refresh_candidates(spark, d):
    """Which series to load anew, and why."""
    today = F.lit(AS_OF).cast("date")
    big = tpch.trades(spark, d).withColumn("fdate", F.date_sub("fdate", 660))  # so that the window is of the last hundred days
    have = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("ticker")).agg(F.max(F.col("l_shipdate").cast("date")).alias("l"))
    have = have.select("ticker", F.date_sub("l", (F.col("ticker") % 60).cast("int")).alias("last"))
    sup = table(spark, d, "supplier")
    missing = sup.where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("ticker"), (F.col("s_suppkey") % 5).alias("tries"), F.lit(None).cast("date").alias("tried"))
    alive = sup.where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("ticker"), today.alias("through"))
    return compute.refresh_candidates(big, have, missing, alive, today, 20)


# --- more of the feed and its measures ---------------------------------------------------------------------------


@query("SELECT m, count(*) AS names FROM sig GROUP BY m", SQL_SIGNALS)
def signals_by_month(spark, d):
    """Tickers signalled in each month, however many trades."""
    return _signals(spark, d).groupBy("m").agg(F.count("*").alias("names"))


@query(
    f"""SELECT grp, count(*) AS months, {r4('avg(r)')} AS mean FROM (
  SELECT grp, h.k, count(*) AS n, avg(next_ret) AS r FROM (SELECT DISTINCT grp, ticker, unnest(range(k, k + 12)) AS k FROM (
      SELECT coalesce("drop", 'ok') AS grp, ticker, strftime(fdate, '%Y-%m') AS m FROM gated WHERE code = 'P'
      UNION ALL SELECT 'any drop', ticker, strftime(fdate, '%Y-%m') FROM gated WHERE code = 'P' AND "drop" IS NOT NULL) JOIN mon USING (m)) h
  JOIN rets ON rets.ticker = h.ticker AND rets.k = h.k WHERE dv >= {MIN_DV} AND next_ret IS NOT NULL GROUP BY grp, h.k HAVING count(*) >= {MIN_NAMES}) GROUP BY grp""",
    *PANEL, *GATES[1:],
)
def avoid_slices(spark, d):
    """Portfolios of what the gates let through and of what they dropped, by reason and together."""
    dims = {"gate": F.coalesce("drop", F.lit("ok")), "any": F.when(F.col("drop").isNotNull(), "any drop")}
    months = lambda x: x.where("code = 'P'").select("ticker", "drop", S.month("fdate").alias("m"))
    st, rets = _in_parts(spark, d, lambda x, b: slices.stacked(months(x), dims).select(F.lit("gate").alias("dim"), "grp", "ticker", "m").distinct(), True)
    grid = slices.portfolio_grid(rets, st, (12,), MIN_DV, MIN_NAMES)
    return grid.groupBy("grp").agg(F.count("*").alias("months"), rnd(F.avg("r")).alias("mean"))


@query(
    """SELECT o_orderkey, age, CASE WHEN age < 21 THEN 'new' WHEN age < 30 THEN 'fresh' WHEN age < 91.5 THEN 'held' ELSE 'closed' END AS status
FROM (SELECT o_orderkey, DATE '1998-12-31' - CAST(o_orderdate AS DATE) AS age FROM orders)"""
)
def position_status(spark, d):
    """Positions by age."""
    today, day = F.lit(AS_OF).cast("date"), F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select("o_orderkey", F.datediff(today, day).cast("long").alias("age"), positions.status(day, today).alias("status"))


@query(
    f"""SELECT acc, code, di, CASE WHEN o IS NULL OR s = 0 OR o - s < 0 THEN NULL WHEN o = s THEN 9.99 ELSE {r4('s / (o - s)')} END::DOUBLE AS growth
FROM (SELECT acc, code, di, CASE di WHEN 'M' THEN sh_d ELSE sh END AS s, CASE di WHEN 'M' THEN own_d ELSE own END AS o FROM (
  SELECT acc, code, sum(sh) AS sh, CASE WHEN count(DISTINCT di) = 2 THEN 'M' ELSE min(di) END AS di, CASE WHEN code = 'S' THEN min(val) ELSE max(val) END AS own,
    CASE WHEN code = 'S' THEN min(val) FILTER (di = 'D') ELSE max(val) FILTER (di = 'D') END AS own_d, sum(sh) FILTER (di = 'D') AS sh_d
  FROM (SELECT * REPLACE (floor(val / 1000) AS val), CASE WHEN form = '4' THEN 'D' ELSE 'I' END AS di FROM trades) GROUP BY acc, code))""",
    SQL_TRADES,
)
def ownership_growth(spark, d):
    """Shares traded against the holding before."""
    x = tpch.trades(spark, d).withColumn("di", F.when(F.col("form") == "4", "D").otherwise("I")).withColumn("val", F.floor(F.col("val") / 1000).cast("double"))
    x = filings.fold_ownership(x, ["acc", "code"], own="val")
    return x.select("acc", "code", "di", S.ownership_growth("sh", "own", F.col("di") == "M", "sh_d", "own_d").alias("growth"))


@query(
    """SELECT n_nationkey, list_sort(list_distinct(list_filter(list_transform(string_split(upper(s), ','), lambda x: trim(x)), lambda x: regexp_matches(x, '^[A-Z][A-Z0-9./-]{0,9}$'))))[1:3] AS symbols
FROM (SELECT n_nationkey, n_name || ', b.a ,B.A,,1x, ' || substr(n_name, 1, 2) || ',zz' AS s FROM nation)"""
)
def quote_request(spark, d):
    """Requested symbols, cleaned, distinct, sorted, the first three."""
    s = F.concat("n_name", F.lit(", b.a ,B.A,,1x, "), F.substring("n_name", 1, 2), F.lit(",zz"))
    return table(spark, d, "nation").select("n_nationkey", S.quote_symbols(s, 3).alias("symbols"))


@query("SELECT acc, line, ticker, tdate, val FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY tdate DESC, val DESC, acc, line) AS r FROM trades WHERE code = 'P') WHERE r <= 5", SQL_TRADES)
def ticker_cards(spark, d):
    """The last five purchases of every ticker."""
    w = Window.partitionBy("ticker").orderBy(F.desc("tdate"), F.desc("val"), "acc", "line")
    x = tpch.trades(spark, d).where("code = 'P'").withColumn("r", F.row_number().over(w)).where("r <= 5")
    return x.select("acc", "line", "ticker", "tdate", "val")
