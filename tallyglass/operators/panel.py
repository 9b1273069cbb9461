"""The monthly panel, calendar-time portfolios and factor spreads.

A panel has a row for each ticker and month: ``ticker, m, px, dv, dd, dd_hi,
dd_lo, mom``. Months are numbered over the whole panel (``k``), so a month that
a ticker lacks gives no return instead of a longer one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.functions.scalars import month, ratio, rnd
from tallyglass.operators.series import drawdown_bars, momentum


def monthly(bars: DataFrame) -> DataFrame:
    """Daily bars to a monthly panel; one shuffle by ticker serves windows and groups."""
    rows = momentum(drawdown_bars(bars)).withColumn("m", month("d"))
    return rows.groupBy("ticker", "m").agg(
        F.max_by("adj", "d").alias("px"),
        rnd(F.expr("percentile_disc(0.5) within group (order by case when close > 0 and vol > 0 then close * vol end)"), 0).alias("dv"),
        F.max_by("dd", "d").alias("dd"),
        F.max("dd").alias("dd_hi"),
        F.min("dd").alias("dd_lo"),
        F.max_by("mom", "d").alias("mom"),
    )


def months(panel: DataFrame) -> DataFrame:
    """``m, k``: the panel's months in order. A row for each month of the calendar, small at any scale."""
    return panel.select("m").distinct().withColumn("k", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("m")) - 1)


def with_returns(panel: DataFrame) -> DataFrame:
    """``panel`` with ``k``, ``ret`` (against the month before, which must be the panel's) and ``next_ret``."""
    w = Window.partitionBy("ticker").orderBy("k")
    rows = panel.join(F.broadcast(months(panel)), "m")
    before = F.when(F.lag("k").over(w) == F.col("k") - 1, F.lag("px").over(w))
    rows = rows.withColumn("ret", F.when((before > 0) & (F.col("px") > 0), ratio("px", before) - 1))
    return rows.withColumn("next_ret", F.when(F.lead("k").over(w) == F.col("k") + 1, F.lead("ret").over(w)))


def held(signals: DataFrame, rows: DataFrame, hold: int) -> DataFrame:
    """``ticker, k``: each signal month and the ``hold - 1`` after it, once each, within the panel's months.

    ``signals`` is ``ticker, m``; a signal stands for a ticker and month, however
    many trades it came from.
    """
    ks = signals.distinct().join(F.broadcast(rows.select("m", "k").distinct()), "m").select("ticker", "k")
    return ks.select("ticker", F.explode(F.sequence(F.col("k"), F.col("k") + hold - 1)).alias("k")).distinct()


def _average(rows: DataFrame, min_names: int) -> DataFrame:
    """Equal-weight mean of ``next_ret`` by month of formation, dated by the month it is earned in."""
    out = rows.where("next_ret is not null").groupBy("k").agg(F.count("*").alias("n"), F.avg("next_ret").alias("r")).where(F.col("n") >= min_names)
    return out.select((F.col("k") + 1).alias("k"), "n", "r")


def _dated(series: DataFrame, rows: DataFrame) -> DataFrame:
    return series.join(F.broadcast(rows.select("m", "k").distinct()), "k").select("m", "k", *[c for c in series.columns if c != "k"])


def portfolio(rows: DataFrame, signals: DataFrame, hold: int = 12, min_dv: float = 3e6, min_names: int = 5) -> DataFrame:
    """``m, k, n, r``: equal-weight portfolio of the tickers signalled in the last ``hold`` months.

    Liquidity is asked of the month of formation only. ``rows`` is ``with_returns(panel)``.
    """
    liquid = rows.where(F.col("dv") >= min_dv)
    return _dated(_average(liquid.join(held(signals, rows, hold), ["ticker", "k"], "left_semi"), min_names), rows)


def universe(rows: DataFrame, hold: int = 1, min_dv: float = 3e6, pred: Column | None = None) -> DataFrame:
    """The same over all liquid tickers that fulfil ``pred`` (a Column over the panel); no least number of names."""
    liquid = rows.where(F.col("dv") >= min_dv)
    chosen = liquid if pred is None else liquid.where(pred)
    if hold > 1:
        liquid = liquid.join(held(chosen.select("ticker", "m"), rows, hold), ["ticker", "k"], "left_semi")
    else:
        liquid = chosen
    return _dated(_average(liquid, 1), rows)


def tercile_spread(rows: DataFrame, by: str, low_minus_high: bool, min_dv: float = 3e6, least: int = 5) -> DataFrame:
    """``m, k, spread``: lowest third by ``by`` against the highest, a third being floor(n / 3), at least ``least``."""
    w = Window.partitionBy("k").orderBy(by, "ticker")
    x = rows.where((F.col("dv") >= min_dv) & F.col(by).isNotNull() & ((F.lit(by) != "dv") | (F.col("dv") > 0)))
    x = x.withColumn("__r", F.row_number().over(w)).withColumn("__n", F.count("*").over(Window.partitionBy("k"))).withColumn("__third", F.floor(F.col("__n") / 3))
    side = F.when(F.col("__r") <= F.col("__third"), "lo").when(F.col("__r") > F.col("__n") - F.col("__third"), "hi")
    x = x.where(F.col("__third") >= least).withColumn("__side", side).where("__side is not null and next_ret is not null")
    lo, hi = (F.avg(F.when(F.col("__side") == s, F.col("next_ret"))) for s in ("lo", "hi"))
    nlo, nhi = (F.count_if(F.col("__side") == s) for s in ("lo", "hi"))
    out = x.groupBy("k").agg((lo - hi if low_minus_high else hi - lo).alias("spread"), nlo.alias("__a"), nhi.alias("__b"))
    return _dated(out.where((F.col("__a") >= least) & (F.col("__b") >= least)).select((F.col("k") + 1).alias("k"), "spread"), rows)


def turnover(rows: DataFrame, signals: DataFrame, hold: int = 12, min_dv: float = 3e6) -> DataFrame:
    """One row ``turnover, months``: mean share of names that change from month to month; a month without names breaks the chain."""
    last = rows.agg(F.max("k").alias("last"))
    names = rows.where(F.col("dv") >= min_dv).join(held(signals, rows, hold), ["ticker", "k"], "left_semi").join(F.broadcast(last)).where("k < last").select("ticker", "k")
    size = names.groupBy("k").agg(F.count("*").alias("n"))
    stay = names.join(names.select("ticker", (F.col("k") + 1).alias("k")), ["ticker", "k"]).groupBy("k").agg(F.count("*").alias("both"))
    before = size.select((F.col("k") + 1).alias("k"), F.col("n").alias("n0"))
    x = size.join(before, "k").join(stay, "k", "left")
    change = (F.col("n") + F.col("n0") - 2 * F.coalesce("both", F.lit(0))) / F.greatest("n", "n0")
    return x.agg(F.avg(change).alias("turnover"), F.count("*").alias("months"))


def shifted(signals: DataFrame, rows: DataFrame, lag: int) -> DataFrame:
    """Signals moved ``lag`` months later on the panel's months."""
    ks = F.broadcast(rows.select("m", "k").distinct())
    later = signals.join(ks, "m").select("ticker", (F.col("k") + lag).alias("k"))
    return later.join(ks, "k").select("ticker", "m").distinct()
