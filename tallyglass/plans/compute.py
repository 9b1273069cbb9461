"""The batch job end to end: trades and prices to gated rows, and series to cells.

Thresholds are in ``gates.Limits`` and the keyword arguments. ``verdicts``, ``cells``,
``set_cells``, ``ladders`` and owners' groups store tables that are read several times (``storage.cut``)
while a plan is being built; everything else is lazy.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.functions import scalars as S
from tallyglass.functions.scalars import ratio, rnd
from tallyglass.operators import asof, gates, owners, panel, series, slices, stats
from tallyglass.storage import cut

HOLD_MONTHS, FEED_DAYS, ROUND_TRIP, LEAST_MONTHS, THIN, SPLIT_MONTH = 3, 200, 0.005, 36, 10, "2021-01"


def change_since(trades: DataFrame, bars: DataFrame) -> DataFrame:
    """``trades`` with ``chg`` (from the entry bar to the last; null if that is the entry) and ``chg_trade`` (from the trade's bar)."""
    last = bars.groupBy("ticker").agg(F.max(F.struct("d", "adj")).alias("__last"))
    b = bars.select("ticker", "d", "adj", "i")
    x = asof.entry_after(asof.as_of(trades, b, "tdate", name="__b"), b, "fdate").join(last, "ticker", "left")
    chg = F.when(F.col("entry.d") < F.col("__last.d"), rnd(ratio(F.col("__last.adj"), F.col("entry.adj")) - 1))
    return x.select(*trades.columns, chg.alias("chg"), rnd(ratio(F.col("__last.adj"), F.col("__b.adj")) - 1).alias("chg_trade"))


def reassigned(trades: DataFrame, latest: DataFrame, known: DataFrame) -> DataFrame:
    """``trades`` with ``same`` (whether the day lies in the symbol's present interval; null if the registry has none or the issuer is in the reference) and ``unknown_symbol`` (the registry would be needed and has none).

    ``latest``: ticker, start, end; ``known``: cik of issuers in the reference.
    """
    x = trades.join(latest.select("ticker", F.col("start").alias("__s"), F.col("end").alias("__e")), "ticker", "left")
    x = x.join(known.select(F.col("cik"), F.lit(True).alias("__k")).distinct(), "cik", "left")
    same = F.when(F.col("__k").isNull() & F.col("__s").isNotNull(), F.col("tdate").between(F.col("__s"), F.col("__e")))
    unknown = F.col("__k").isNull() & F.col("__s").isNull()
    return x.withColumns({"same": same, "unknown_symbol": unknown}).drop("__s", "__e", "__k")


def planned(rows: DataFrame) -> DataFrame:
    """``rows`` with ``planned``: the form's box (``plan_box``) is ticked, or a footnote (``fn_b5``) says so; a flag that is there already counts too."""
    has = [F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in ("planned", "plan_box", "fn_b5") if c in rows.columns]
    return rows.withColumn("planned", reduce(or_, has, F.lit(False)))


def verdicts(trades: DataFrame, bars: DataFrame, limits: gates.Limits = gates.Limits(), splits: DataFrame | None = None, groups: DataFrame | None = None, history: DataFrame | None = None, sync_owners: str = "owner", past: DataFrame | None = None) -> DataFrame:
    """All that the gates read, their verdict and the working set.

    ``trades`` needs ticker, owner, tdate, code, sh, px, val; flags in it
    (``fn_*``, ``planned``, ``plan_box``, ``fund_only``, ``cancelled``,
    ``reassigned``) are used where present. ``bars`` has ``i``. ``splits``
    (ticker, d, ratio) make closes comparable with the trade's price: as quoted
    on the day. ``groups`` (node, component) are owners who file together; ``sync_owners``
    names who files a row, one or an array. ``history`` (owner, ticker, code, tdate) is what all owners
    did, where that is more than ``trades``; ``past`` what that says of their days, where it is known (``owners.owner_days``). A reassigned row gets no prices.
    """
    x = series.day_features(trades, series.adv(bars).select("ticker", "d", "close", "i", "adv", "bucket"), splits)
    x = x.withColumn("bucket", F.coalesce("bucket", F.lit("н/д")))
    if "reassigned" in trades.columns:
        gone = F.coalesce(F.col("reassigned"), F.lit(False))
        x = x.withColumns({c: F.when(~gone, F.col(c)) for c in ("close", "hist_days", "adv", "dd")} | {"bucket": F.when(gone, "н/д").otherwise(F.col("bucket"))})
    x = cut(x, "days")  # read by all that follows
    x = planned(owners.with_regular(owners.with_past(owners.sync_count(x, groups, sync_owners), history=history, past=past), history=history))
    x = x.withColumn("no_price", F.col("close").isNull()).withColumn("no_liquidity", F.col("close").isNotNull() & F.col("adv").isNull())
    mismatch = owners.units_mismatch(x).where("mismatch").select("ticker", F.lit(True).alias("units"))
    x = gates.apply_gates(x.join(mismatch, "ticker", "left"), limits)
    x = x.withColumn("inflection", F.when(F.col("ok"), F.col("first"))).drop("first")
    return x.withColumn("in_set", gates.in_set(limits))


def features(trades: DataFrame, bars: DataFrame, limits: gates.Limits = gates.Limits(), splits: DataFrame | None = None, groups: DataFrame | None = None) -> DataFrame:
    """``verdicts`` with ``entry_day, entry_px`` (where a reader of the filing comes in, and at what quoted price) and ``px_adj`` (the trade's price on the scale of the bars); ``trades`` needs fdate."""
    return entries(verdicts(trades, bars, limits, splits, groups), bars, splits)


def entries(rows: DataFrame, bars: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """``rows`` with verdicts, and ``entry_day, entry_px, px_adj``."""
    x = series.entry_features(rows, bars, splits)
    x = x.withColumn("px_adj", rnd(ratio("px", "split")))
    if "reassigned" in rows.columns:
        x = x.withColumns({c: F.when(~F.coalesce(F.col("reassigned"), F.lit(False)), F.col(c)) for c in ("entry_day", "entry_px", "px_adj")})
    return x


def dimensions(rows: DataFrame) -> dict[str, Column]:
    """The ten dimensions by which rows with verdicts are sliced; a null group leaves a row out.

    Only ``gate`` and ``routine`` see dropped rows. ``role`` is a column of ``rows``.
    """
    passed = lambda c: F.when(F.col("ok"), c)
    return {
        "set": passed(F.when(F.col("in_set"), "set").otherwise("outside")),
        "gate": F.coalesce("drop", F.lit("ok")),
        "all": passed(F.lit("passed")),
        "role": passed(F.col("role")),
        "size": passed(S.size_bucket("val")),
        "liquidity": passed(F.col("bucket")),
        "routine": F.when(F.col("routine"), "routine").when(~F.col("routine"), "opportunistic").otherwise("no history"),
        "inflect": passed(F.coalesce("inflection", F.lit("usual"))),
        "dd": passed(S.drawdown_label("dd")),
        "year": passed(F.year("fdate")),
    }


#: Slices that are known to do worse than the index, and the months they are held.
AVOID = (
    ("routine", 12, "drop = 'routine'"), ("planned", 12, "drop = 'planned'"), ("deep", 3, "ok and dd < -0.3"),
    ("role X", 12, "ok and role = 'X'"), ("role O", 12, "ok and role = 'O'"), ("dropped", 12, "not ok"),
)
#: What a set is held against: all that passed.
REFERENCE = (("passed", 12, "ok"),)
SET = (("set", HOLD_MONTHS, "in_set"),)


def named_months(rows: DataFrame, wanted: Sequence[tuple[str, int, str]]) -> DataFrame:
    """``key, hold, ticker, m, n``: months of the rows that fulfil each of ``wanted`` (key, hold, condition), and how many these are."""
    hits = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(h).alias("hold"), F.expr(c).alias("on")) for k, h, c in wanted])
    x = rows.withColumn("__h", F.explode(F.filter(hits, lambda x: F.coalesce(x["on"], F.lit(False)))))
    return x.groupBy("__h.key", "__h.hold", "ticker", S.month("fdate").alias("m")).agg(F.count("*").alias("n"))


def feed(rows: DataFrame, today: Column, days: int = FEED_DAYS) -> DataFrame:
    """Recent rows as the feed shows them: delay in business days, age, day of exit."""
    x = rows.where(F.col("fdate") >= F.date_sub(today, days))
    return x.withColumns(
        {
            "delay": S.business_days("tdate", "fdate"),
            "age": F.datediff(today, "fdate"),
            "exit": F.date_add(F.coalesce("entry_day", "fdate"), HOLD_MONTHS * 30),
        }
    )


def marks(rows: DataFrame) -> DataFrame:
    """Marks beside a row: at its high, the gap of the entry to the insider's price, whether it is worth showing.

    Where the row has ``cur`` (the last close) and ``chg`` (the change with
    dividends), ``price_only`` is the change of the price alone, if they differ by
    0.2 points or more.
    """
    gap = ratio("entry_px", "px") - 1
    out = rows.withColumns({"at_high": F.coalesce(F.col("dd") >= -0.05, F.lit(False)), "gap": F.when(F.abs(gap) >= 0.005, rnd(gap))})
    if "cur" in rows.columns and "chg" in rows.columns:
        alone = rnd(ratio("cur", "entry_px") - 1)
        out = out.withColumn("price_only", F.when(F.abs(alone - F.col("chg")) >= 0.002, alone))
    return out


def positive_years(years: DataFrame) -> DataFrame:
    """``positive, years`` of ``by_year``'s rows."""
    return years.agg(F.count_if(F.col("ex") > 0).alias("positive"), F.count("*").alias("years"))


#: What a chart shows: how many days back, and whether by day or by week.
CHARTS = {"1y": (370, True), "5y": (5 * 365, False), "max": (None, False)}


def chart(bars: DataFrame, today: Column, span: str = "1y") -> DataFrame:
    """``ticker, d, close`` of a ticker's chart: daily closes of a year, or weekly ones of five years or all."""
    days, daily = CHARTS[span]
    x = bars.select("ticker", "d", "close") if daily else series.weekly_close(bars).select("ticker", "d", "close")
    return x if days is None else x.where(F.col("d") >= F.date_sub(today, days))


def chart_marks(rows: DataFrame, today: Column, span: str = "1y", purchases_only: bool = False) -> DataFrame:
    """The trades on that chart, at prices of its scale (``px_adj``, else ``px``)."""
    days, _ = CHARTS[span]
    x = rows.where(F.col("code") == "P") if purchases_only else rows
    x = x if days is None else x.where(F.col("tdate") >= F.date_sub(today, days))
    return x.withColumn("shown", F.coalesce("px_adj", "px"))


def quality(rows: DataFrame, repaired: DataFrame | None = None, states: DataFrame | None = None) -> DataFrame:
    """One row of counters: rows, passed, without price or entry, reassigned and unknown symbols, with tickers; sums of the repairs, from ``repair.counters``; filings ``recovered`` from broken markup and ``lost``, from ``filing_states``."""
    has = lambda c: F.coalesce(F.col(c).cast("boolean"), F.lit(False)) if c in rows.columns else F.lit(False)
    tickers = lambda on: F.count_distinct(F.when(on, F.col("ticker")))
    out = rows.agg(
        F.count("*").alias("rows"), F.count_if("ok").alias("passed"), F.count_if("no_price").alias("no_price"), F.count_if("in_set").alias("in_set"), tickers(F.col("no_price")).alias("tickers_without"),
        F.count_if(has("reassigned")).alias("reassigned"), tickers(has("reassigned")).alias("tickers_reassigned"), F.count_if(has("unknown_symbol")).alias("unknown_symbol"), F.count_if(has("no_entry")).alias("no_entry"),
    )
    if repaired is not None:
        names = [c for c in repaired.columns if c.startswith("n_")]
        out = out.join(F.broadcast(repaired.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names], F.count_if(sum((F.col(c) for c in names), F.lit(0)) > 0).alias("series_repaired"))))
    if states is not None:
        out = out.join(F.broadcast(states.agg(*[F.count_if(F.col("state") == c).alias(c) for c in ("recovered", "lost")])))
    return out


def cells(grid: DataFrame, market: DataFrame, universe: DataFrame, factors: DataFrame | None = None, by: Sequence[str] = ("dim", "grp", "hold"), least: int = LEAST_MONTHS) -> DataFrame:
    """A row of statistics for every series of ``grid`` (``by``, k, n, r), all in one pass.

    ``market`` and ``universe`` are ``m, k, r``; ``factors`` is ``m, market, size,
    momentum``. Means are annualised; ``ex_mean`` is the monthly one. Series under ``least`` months are left out;
    ``thin`` marks few names; ``early, late`` are the excess before and after the
    split month, null under 24 months.
    """
    by = list(by)
    grid = cut(grid, "cells")  # a few hundred months of each series, read several times below
    long_enough = grid.groupBy(*by).agg(F.count("*").alias("months")).where(F.col("months") >= least)
    s = grid.join(long_enough, by)
    p = stats.path(s, by)
    m = s.join(F.broadcast(market.select("k", "m", F.col("r").alias("__m"))), "k").withColumn("d", F.col("r") - F.col("__m"))
    u = s.join(F.broadcast(universe.select("k", F.col("r").alias("__u"))), "k").withColumn("d", F.col("r") - F.col("__u"))
    te, vol = F.sqrt(12 * F.var_pop("d")), F.sqrt(12 * F.var_pop("r"))
    half = lambda on: F.when(F.count_if(on) >= 24, rnd(stats.annualised(F.avg(F.when(on, F.col("d"))))))
    more = m.groupBy(*by).agg(
        F.when(te > 0, rnd(F.avg("d") * 12 / te, 2)).alias("ir"), F.when(vol > 0, rnd(F.avg(F.col("r") - stats.risk_free("m")) * 12 / vol, 2)).alias("sharpe"),
        half(F.col("m") < SPLIT_MONTH).alias("early"), half(F.col("m") >= SPLIT_MONTH).alias("late"),
    )
    excess = lambda x, a, b, *own: stats.newey_west(x, "d", by=by).select(*by, *own, rnd(stats.annualised(F.col("mean"))).alias(a), rnd("t", 2).alias(b))
    out = long_enough.join(p, by).join(more, by, "left").join(excess(m, "ex", "ex_t", rnd("mean").alias("ex_mean")), by, "left").join(excess(u, "over_all", "over_all_t"), by, "left")
    if factors is not None:
        named = s.join(F.broadcast(market.select("k", "m")), "k")
        a = stats.factor_alpha(named, factors, ["market", "size", "momentum"], by)
        out = out.join(a.select(*by, rnd(stats.annualised(F.col("alpha"))).alias("alpha"), rnd("t", 2).alias("alpha_t"), *[rnd(f"beta_{n}", 2).alias(f"beta_{n}") for n in ("market", "size", "momentum")]), by, "left")
    out = out.withColumns({c: rnd(c) for c in ("cagr", "vol", "dd")})
    return out.withColumn("thin", F.col("avg_n") < THIN)


def net_of_costs(cell: DataFrame, turnover: DataFrame, by: Sequence[str] = (), round_trip: float = ROUND_TRIP) -> DataFrame:
    """``cell`` with yearly ``turnover``, ``cost`` and ``net`` excess; ``turnover`` has a row for each ``by``, one row without."""
    t = turnover.select(*by, F.col("turnover").alias("__t"))
    x = cell.join(t, list(by), "left") if by else cell.join(F.broadcast(t))
    cost = F.col("__t") / 2 * 12 * round_trip
    return x.withColumns({"turnover": rnd(F.col("__t") * 12), "cost": rnd(cost), "net": rnd(F.col("ex") - cost)}).drop("__t")


def by_year(series_: DataFrame, market: DataFrame) -> DataFrame:
    """``year, ex``: sums of the monthly excess."""
    x = series_.join(market.select("m", F.col("r").alias("__o")), "m")
    return x.groupBy(F.substring("m", 1, 4).alias("year")).agg(rnd(F.sum(F.col("r") - F.col("__o"))).alias("ex"))


def set_cells(
    rows: DataFrame, rets: DataFrame, market: DataFrame, factors: DataFrame | None = None, wanted: Sequence[tuple[str, int, str]] = (*SET, *AVOID, *REFERENCE), min_dv: float = 3e6, min_names: int = 5
) -> DataFrame:
    """A row for each named set of ``rows`` (with verdicts, ``role``, fdate), for the universe and for the index.

    ``key, hold``, the statistics of ``cells``, ``signals`` (rows of the set), and
    ``turnover, cost, net``. ``universe`` is every liquid name, held a month;
    ``index`` is ``market`` (m, k, r) itself, with no excess, alpha or names.
    """
    return cells_of_sets(cut(named_months(rows, wanted), "sets"), rets, market, factors, min_dv, min_names)


def cells_of_sets(named: DataFrame, rets: DataFrame, market: DataFrame, factors: DataFrame | None = None, min_dv: float = 3e6, min_names: int = 5) -> DataFrame:
    """``set_cells`` of a table that has been made by ``named_months``."""
    by, liquid = ["key", "hold"], rets.where(F.col("dv") >= min_dv)
    held = slices.held(named, rets, by)
    whole = panel.universe(rets, 1, min_dv)
    all_ = slices.held(liquid.select(F.lit("universe").alias("key"), F.lit(1).alias("hold"), "ticker", "m"), rets, by)
    grid = slices.held_series(held, rets, by, min_dv, min_names).unionByName(whole.select(F.lit("universe").alias("key"), F.lit(1).alias("hold"), "k", "n", "r"))
    found = cells(grid, market, whole, factors, by)
    found = net_of_costs(found, slices.held_turnover(held.unionByName(all_), rets, by, min_dv), by)
    found = found.join(named.groupBy(*by).agg(F.sum("n").alias("signals")), by, "left")
    index = cells(market.select(F.lit("index").alias("key"), F.lit(0).alias("hold"), "k", F.lit(1).cast("long").alias("n"), "r"), market, whole, None, by)
    index = index.withColumns({"ex_t": F.lit(None).cast("double"), "ir": F.lit(None).cast("double")})
    if factors is not None:  # against itself
        index = index.withColumns({"alpha": F.lit(0.0), "beta_market": F.lit(1.0), "beta_momentum": F.lit(0.0)})
    return found.unionByName(index, allowMissingColumns=True)


#: Steps of the two ladders: depth below the high, and the least size of a purchase.
DEPTHS, SIZES = (-0.01, -0.02, -0.05, -0.10, -0.20, -0.35), (0.0, 1e4, 5e4, 1e5, 2.5e5, 5e5)


def steps(limits: gates.Limits = gates.Limits(), hold: int = HOLD_MONTHS, depths: Sequence[float] = DEPTHS, sizes: Sequence[float] = SIZES) -> list[tuple[str, int, str]]:
    """The steps of both ladders as named sets."""
    liquid = f"ok and adv >= {limits.set_adv}"
    wanted = [(f"depth {x}", hold, f"{liquid} and dd >= {x} and val >= {limits.set_val}") for x in depths]
    return wanted + [(f"size {x}", hold, f"{liquid} and dd >= {limits.set_dd} and val >= {x}") for x in sizes]


def ladders(rows: DataFrame, rets: DataFrame, market: DataFrame, limits: gates.Limits = gates.Limits(), hold: int = HOLD_MONTHS, min_dv: float = 3e6, min_names: int = 5, depths: Sequence[float] = DEPTHS, sizes: Sequence[float] = SIZES) -> DataFrame:
    """``ladder, step, months, avg_n, ex_mean, ex, ex_t``: the working set with one threshold moved in steps, so that a jump at the chosen one would show."""
    return ladders_of(cut(named_months(rows, steps(limits, hold, depths, sizes)), "steps"), rets, market, min_dv, min_names)


def ladders_of(named: DataFrame, rets: DataFrame, market: DataFrame, min_dv: float = 3e6, min_names: int = 5) -> DataFrame:
    """``ladders`` of a table that has been made by ``named_months`` of ``steps``."""
    by = ["key", "hold"]
    grid = slices.held_series(slices.held(named, rets, by), rets, by, min_dv, min_names)
    found = cells(grid, market, panel.universe(rets, 1, min_dv), None, by)
    return found.select(F.split("key", " ")[0].alias("ladder"), F.split("key", " ")[1].cast("double").alias("step"), "months", "avg_n", "ex_mean", "ex", "ex_t")


def entry_lags(rows: DataFrame, rets: DataFrame, market: DataFrame, condition: str = "in_set", lags: Sequence[int] = (0, 1, 2), hold: int = HOLD_MONTHS, min_dv: float = 3e6, min_names: int = 5) -> DataFrame:
    """``lag, months, ex_mean, ex, ex_t``: a set whose signals are taken some months late."""
    sig = named_months(rows, [("set", hold, condition)])
    late = reduce(DataFrame.unionByName, [panel.shifted(sig.select("ticker", "m"), rets, n).withColumns({"lag": F.lit(n), "hold": F.lit(hold)}) for n in lags])
    by = ["lag", "hold"]
    grid = slices.held_series(slices.held(late, rets, by), rets, by, min_dv, min_names)
    return cells(grid, market, panel.universe(rets, 1, min_dv), None, by).select("lag", "months", "ex_mean", "ex", "ex_t")


def working_set(rows: DataFrame, rets: DataFrame, market: DataFrame, factors: DataFrame | None = None, limits: gates.Limits = gates.Limits(), min_dv: float = 3e6, min_names: int = 5) -> dict[str, DataFrame]:
    """The working set's page: its ``cell``, ``control`` (all names that were as near their high), ``years``, ``ladders`` and ``lags``."""
    sig = named_months(rows, SET).select("ticker", "m").distinct()
    series_ = panel.portfolio(rets, sig, HOLD_MONTHS, min_dv, min_names)
    near = panel.universe(rets, HOLD_MONTHS, min_dv, F.col("dd_hi") >= limits.set_dd)
    return {
        "cell": set_cells(rows, rets, market, factors, SET, min_dv, min_names).where("key = 'set'"),
        "control": stats.paired(series_, near),
        "years": by_year(series_, market),
        "ladders": ladders(rows, rets, market, limits, min_dv=min_dv, min_names=min_names),
        "lags": entry_lags(rows, rets, market, min_dv=min_dv, min_names=min_names),
    }


def refresh_candidates(trades: DataFrame, have: DataFrame, missing: DataFrame, alive: DataFrame, today: Column, most: int = 150) -> DataFrame:
    """``ticker, why``: recent purchases (760 days), failed ones to try again, and the ``most`` stalest series that still trade.

    ``have``: ticker, last; ``missing``: ticker, tries, tried; ``alive``: ticker, through.
    """
    bought = trades.where("code = 'P'").groupBy("ticker").agg(F.max("fdate").alias("f"))
    recent = bought.where(F.col("f") >= F.date_sub(today, 760)).select("ticker", F.lit("recent").alias("why"))
    again = missing.where((F.col("tries") < 4) & (F.col("tried").isNull() | (F.col("tried") < F.date_sub(today, 7)))).join(bought, "ticker", "left_semi").select("ticker", F.lit("again").alias("why"))
    old = F.date_sub(today, 20)
    stale = have.where(F.col("last") < old).join(bought, "ticker", "left_semi").join(alive.where(F.col("through") >= old), "ticker", "left_semi")
    stale = stale.orderBy("last", "ticker").limit(most).select("ticker", F.lit("stale").alias("why"))
    return recent.unionByName(again).unionByName(stale).groupBy("ticker").agg(F.max("why").alias("why"))


def nearest(probes: DataFrame, bars: DataFrame, day: str) -> DataFrame:
    """``probes`` with ``near``: the bar nearest to ``day`` on either side; of two as near the later."""
    b = bars.withColumn("next", F.lead(F.struct("d", "close")).over(series._by_day())).select("ticker", "d", "close", "next", "i")
    x = asof.as_of(probes, b, day, name="__b")
    first = bars.where("i = 0").select("ticker", F.struct("d", "close").alias("__f"))
    x = x.join(first, "ticker", "left")
    here, after = F.struct(F.col("__b.d").alias("d"), F.col("__b.close").alias("close")), F.col("__b.next")
    closer = F.datediff(F.col(day), F.col("__b.d")) < F.datediff(after["d"], F.col(day))
    near = F.when(F.col("__b").isNull(), F.col("__f")).when(after.isNull() | closer, here).otherwise(after)
    return x.withColumn("near", near).drop("__b", "__f")


def covered(quotes: DataFrame, wanted: DataFrame, least: float = 0.5) -> DataFrame:
    """``wanted, found, missing, ok``: whether a batch of quotes covers enough of the symbols asked for; none found is never enough."""
    x = wanted.select("symbol").distinct().join(quotes.select("symbol", F.lit(1).alias("__q")).distinct(), "symbol", "left")
    x = x.agg(F.count("*").alias("wanted"), F.count("__q").alias("found"), F.array_sort(F.collect_set(F.when(F.col("__q").isNull(), F.col("symbol")))).alias("missing"))
    return x.withColumn("ok", (F.col("found") > 0) & (F.col("found") >= F.ceil(F.col("wanted") * least)))


def snapshot(cached: DataFrame, fresh: DataFrame, now: Column, fresh_seconds: int = 30, stale_seconds: int = 1800) -> DataFrame:
    """The latest quote of each symbol with ``state``: fresh, stale, or gone after that.

    Both: symbol, p, at (timestamp).
    """
    x = cached.unionByName(fresh).groupBy("symbol").agg(F.max(F.struct("at", "p")).alias("x")).select("symbol", "x.at", "x.p")
    age = F.unix_timestamp(now) - F.unix_timestamp("at")
    return x.withColumn("state", F.when(age <= fresh_seconds, "fresh").when(age <= stale_seconds, "stale").otherwise("gone"))


def missed_days(last: Column, today: Column) -> Column:
    """Business days strictly between the last one processed and today; two or more are an alarm."""
    return S.business_days(F.date_add(last, 1), today)


def needs_replay(rows: DataFrame, floor: int = 0) -> DataFrame:
    """Days of rows that an older version wrote (they lack ``own_d`` where ownership is known), unless no more than ``floor`` remain."""
    old = rows.where(F.col("own_d").isNull() & F.col("own").isNotNull() & (F.col("di") == "D"))
    return old.groupBy("fdate").agg(F.count("*").alias("n")).withColumn("__all", F.sum("n").over(Window.partitionBy(F.lit(0)))).where(F.col("__all") > floor).drop("__all")


def write_payloads(rows: DataFrame, path: str, today: Column, bars: DataFrame | None = None, stats_: DataFrame | None = None, repaired: DataFrame | None = None, trades: DataFrame | None = None, states: DataFrame | None = None) -> None:
    """JSON documents: the feed, the back test by year with its index, a card for each ticker with its index, the cells, counters.

    A ticker's trades (``trades``, of all kinds; ``rows`` without it) are lines under ``trades/ticker=...``, the newest first,
    so that no task holds a list of them; its card has the counts and, with ``bars``, the last year's daily
    closes and all weekly ones, as many as the calendar has.
    """
    shown = feed(rows, today)
    shown.orderBy(F.desc("fdate"), F.desc("val")).write.mode("overwrite").json(f"{path}/feed")
    year = rows.where("code = 'P'").withColumn("year", F.year("fdate"))
    year.hint("rebalance", "year").write.mode("overwrite").partitionBy("year").json(f"{path}/backtest")
    year.groupBy("year").agg(F.count("*").alias("n"), F.count_if("ok").alias("passed")).orderBy("year").coalesce(1).write.mode("overwrite").json(f"{path}/backtest-index")
    one = rows.select("ticker", "tdate", "fdate", "code", "sh", "px", "val", "drop")
    if trades is not None:
        sold = trades.where("code <> 'P'").select("ticker", "tdate", "fdate", "code", "sh", "px", "val")
        one = one.unionByName(sold, allowMissingColumns=True)
    place = ["ticker", F.desc("tdate"), F.desc("fdate"), "code", "val"]
    one.repartitionByRange(*place).sortWithinPartitions(*place).write.mode("overwrite").partitionBy("ticker").json(f"{path}/trades")
    counts = one.groupBy("ticker").agg(F.count("*").alias("trades")).join(rows.groupBy("ticker").agg(F.count_if("ok").alias("passed")), "ticker", "left")
    cards = counts.withColumn("passed", F.coalesce("passed", F.lit(0)))
    cards.orderBy("ticker").write.mode("overwrite").json(f"{path}/tickers-index")
    if bars is not None:
        for name, span in (("daily", "1y"), ("weekly", "max")):
            line = chart(bars, today, span).groupBy("ticker").agg(F.sort_array(F.collect_list(F.struct("d", "close"))).alias(name))
            cards = cards.join(line, "ticker", "left")
    cards.write.mode("overwrite").json(f"{path}/tickers")
    if stats_ is not None:
        slices.ordered(stats_).write.mode("overwrite").json(f"{path}/stats")
    quality(rows, repaired, states).write.mode("overwrite").json(f"{path}/meta")
