"""The batch job as one plan: parsed filings and cached prices to gated rows, returns and documents.

``trades`` throughout are as ``sources.filings.assemble`` gives them: an array
``owners``, a struct ``fn``, the issuer's ``cik`` and the ticker ``t`` of the form. ``shaped`` makes of them what
the gates read. Nothing here runs a job but what the operators themselves store (see ``compute``), and ``publish``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.functions import scalars as S
from tallyglass.operators import filings, gates, owners, repair, series
from tallyglass.plans import compute
from tallyglass.sources.filings import issuer_category
from tallyglass.storage import cut

ROW_KEY = ("acc", "code", "tdate", "sec")
_FN = ("b5", "offering", "drip", "espp", "forced", "pledge", "wavg", "gift", "trust")


def loaded(quarters: DataFrame | None, live: DataFrame | None) -> DataFrame:
    """One row for each trade: those of the quarterly tables before live ones, then of one content the amendment, else the later filing."""
    parts = [x.withColumn("__load", F.lit(n)) for n, x in enumerate((quarters, live)) if x is not None]
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    rows = rows.withColumn("__first", F.coalesce(F.get("owners", F.lit(0))["cik"], F.lit(0)))
    out = filings.deduplicate(rows, ROW_KEY, ["cik", "__first", "tdate", "code", "sec"], F.col("__load"), [F.col("acc")])
    return out.drop("__load", "__first")


def in_universe(trades: DataFrame, reference: DataFrame, intervals: DataFrame | None) -> DataFrame:
    """``trades`` with ``ticker, category`` of issuers that are or may have been listed, with a plausible ticker and valid days. ``reference``: cik, ticker, exchange, name; ``intervals``: the registry."""
    x = issuer_category(trades.where("tdate is not null and fdate is not null"), reference, intervals)
    return x.where((F.col("category") != "otc") & S.plausible_ticker("ticker"))


def shaped(trades: DataFrame) -> DataFrame:
    """``trades`` with what gates and cells read: ``owner`` and ``owner_ids``, ``who``, ``title``, ``role`` (of persons only), ``fund_only``, ``fn_*``, ``plan_box`` and ``growth``."""
    people = F.filter("owners", lambda o: ~S.is_entity(o["name"]))
    x = trades.withColumns(
        {
            "owner": S.primary_owner(F.col("owners"))["cik"],
            "owner_ids": F.array_compact(F.transform("owners", lambda o: o["cik"])),
            "who": F.array_join(F.transform("owners", lambda o: o["name"]), "; "),
            "title": F.coalesce(F.get("owners", F.lit(0))["title"], F.lit("")),
            "role": S.top_role(people),
            "fund_only": S.fund_only(F.col("owners")),
            "plan_box": F.coalesce(F.col("b5"), F.lit(False)),
            "growth": S.ownership_growth("sh", "own", F.col("di") == "M", "sh_d", "own_d"),
        }
    )
    return x.withColumns({f"fn_{n}": F.coalesce(F.col(f"fn.{n}"), F.lit(False)) for n in _FN}).drop("fn", "b5")


def holders(intervals: DataFrame, gap_days: int = 30) -> DataFrame:
    """``ticker, start, end``: the interval of each symbol's present holder."""
    return series.latest_island(series.islands(intervals.select("ticker", "start", "end"), gap_days=gap_days))


def series_of(cached: DataFrame, splits: DataFrame | None, intervals: DataFrame | None) -> DataFrame:
    """Repaired bars of the price cache with ``i`` and the counters of the repairs, as a table."""
    bars = repair.repair(cached, splits, None if intervals is None else holders(intervals))
    return cut(bars.withColumn("i", F.row_number().over(Window.partitionBy("ticker").orderBy("d")) - 1), "series")


@dataclass
class Job:
    """What a run makes: ``rows`` (purchases with verdicts, entries and returns), ``trades`` (all of the universe), ``bars`` (repaired series), ``repaired`` (what that did to each)."""

    rows: DataFrame
    trades: DataFrame
    bars: DataFrame
    repaired: DataFrame


def job(
    quarters: DataFrame | None, live: DataFrame | None, cached: DataFrame, reference: DataFrame, today: Column,
    splits: DataFrame | None = None, intervals: DataFrame | None = None, market: str = "SPY", small: str | None = "IWM", limits: gates.Limits = gates.Limits(),
) -> Job:
    """All purchases of the universe, each with its verdict, where a reader of the filing comes in, and what became of it.

    ``quarters, live``: trades; ``cached``: ticker, d, close, adj, vol; ``splits``: ticker, d, ratio; ``intervals``: the registry.
    ``market`` and ``small`` name the benchmarks' series. A symbol that by now belongs to another issuer gets no prices.
    """
    trades = cut(shaped(in_universe(loaded(quarters, live), reference, intervals)), "trades")
    bars = series_of(cached, splits, intervals)
    plain = bars.select("ticker", "d", "close", "adj", "vol", "i")
    known = reference.where("ticker is not null").select("cik")
    bought = trades.where("code = 'P'")
    if intervals is not None:
        bought = compute.reassigned(bought, holders(intervals), known).withColumn("reassigned", ~F.coalesce("same", F.lit(True))).drop("same")
    history = trades.select(F.explode("owner_ids").alias("owner"), "ticker", "cik", "code", "tdate")
    rows = compute.verdicts(bought, plain, limits, splits, owners.owner_groups(trades), history, sync_owners="owner_ids")
    rows = compute.entries(cut(rows, "verdicts"), plain, splits)
    line = lambda name: plain.where(F.col("ticker") == name).select("d", "adj")
    gone = F.coalesce(F.col("reassigned"), F.lit(False)) if "reassigned" in rows.columns else F.lit(False)
    through = None if intervals is None else holders(intervals).select("ticker", F.col("end").alias("through"))
    priced = rows.where(~gone & F.col("hist_days").isNotNull())
    done = series.forward_returns(priced.drop("entry_day"), plain, line(market), today, through, small=line(small) if small else None)
    done = compute.change_since(done, plain)
    last = plain.groupBy("ticker").agg(F.max_by("close", "d").alias("cur"))
    done = done.join(last, "ticker", "left").unionByName(rows.where(gone | F.col("hist_days").isNull()), allowMissingColumns=True)
    names = reference.select("cik", F.col("name").alias("__name"))
    done = done.join(names, "cik", "left").withColumn("name", F.coalesce("__name", "t")).drop("__name")
    return Job(cut(done, "rows"), trades, plain, repair.counters(bars))


def publish(made: Job, path: str, today: Column, cells: DataFrame | None = None, states: DataFrame | None = None) -> None:
    """Write the documents of a run, see ``compute.write_payloads``. ``states``: how single filings were read."""
    compute.write_payloads(made.rows, path, today, made.bars, cells, made.repaired, made.trades, states)
