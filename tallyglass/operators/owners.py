"""Owners: co-filing groups, trading history and what it says of a new trade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.functions.scalars import is_entity
from tallyglass.operators.components import connected_components


def group_edges(filings: DataFrame, owners: str = "owners") -> DataFrame:
    """``a, b``: in each filing the first entity with the other entities, and the first person with the other persons.

    The two kinds are never linked, so an entity can't bridge unrelated persons.
    """
    people = lambda want: F.filter(owners, lambda o: o["cik"].isNotNull() & (is_entity(o["name"]) == F.lit(want)))
    star = lambda x: F.transform(F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(0))), lambda o: F.struct(F.get(x, F.lit(0))["cik"].alias("a"), o["cik"].alias("b")))
    both = filings.select(people(True).alias("e"), people(False).alias("p"))
    return both.select(F.explode(F.concat(star(F.col("e")), star(F.col("p")))).alias("x")).select("x.a", "x.b").distinct()


def owner_groups(filings: DataFrame, owners: str = "owners") -> DataFrame:
    """``node, component`` for every owner that has filed with another of its kind."""
    return connected_components(group_edges(filings, owners), "a", "b")


def summary(trades: DataFrame, owner: str = "owner") -> DataFrame:
    """``owner, n, first, last, buys``: an owner's trades, their first and last day, and how many are purchases."""
    return trades.groupBy(owner).agg(F.count("*").alias("n"), F.min("tdate").alias("first"), F.max("tdate").alias("last"), F.count_if(F.col("code") == "P").alias("buys"))


def owner_days(history: DataFrame, owner: str = "owner", years: int = 3, part: Column | None = None) -> DataFrame:
    """``owner, tdate, routine, first`` for each day on which an owner traded, see ``with_past``; with ``part``, a row for each of its values among the day's trades."""
    month = F.year("tdate") * 12 + F.month("tdate") - 1
    also = [] if part is None else [part.alias("part")]
    days = history.where(F.col(owner).isNotNull() & F.col("tdate").isNotNull()).groupBy(owner, "tdate", *also).agg(F.max((F.col("code") == "P").cast("int")).alias("__buy"))
    months = Window.partitionBy(owner).orderBy("__m")
    there = lambda k: F.count("*").over(months.rangeBetween(-12 * k, -12 * k)) > 0
    before = Window.partitionBy(owner).orderBy("__n").rangeBetween(Window.unboundedPreceding, -1)
    x = days.withColumn("__m", month.cast("long")).withColumn("__n", F.datediff("tdate", F.lit("1970-01-01").cast("date")))
    x = x.withColumn("__since", F.floor(F.min("__m").over(months.rangeBetween(Window.unboundedPreceding, 0)) / 12))
    met = there(1)
    for k in range(2, years + 1):
        met = met & there(k)
    x = x.withColumn("routine", F.when(F.floor(F.col("__m") / 12) - F.col("__since") >= years, met))
    x = x.withColumns({"__began": F.min("tdate").over(before), "__bought": F.max(F.when(F.col("__buy") == 1, F.col("tdate"))).over(before)})
    gone = (F.datediff("tdate", "__began") >= years * 365) & (F.col("__bought") < F.date_sub("tdate", years * 365))
    first = F.when(F.col("__began").isNull(), None).when(F.col("__bought").isNull(), "first-ever").when(gone, "first-in-3y")
    return x.select(owner, "tdate", "routine", first.alias("first"), *([] if part is None else ["part"]))


def with_past(trades: DataFrame, owner: str = "owner", years: int = 3, history: DataFrame | None = None, past: DataFrame | None = None) -> DataFrame:
    """``trades`` with ``routine`` and ``first``: what the owner's other trades say of one on that day.

    ``routine``: there was a trade in this month of each of the three years before;
    null if the owner's history begins in a later year than that. ``first``: a
    purchase on that day would be ``first-ever`` or ``first-in-3y``, else null; only
    days strictly before count, and there must be one. Both are null without an
    owner or a day.

    Windows go over the distinct days of an owner, so a task holds no more of one
    owner than the calendar has; the rows get their day's answer by an equal join.
    ``past``: the answers, where ``owner_days`` has made them before.
    """
    x = owner_days(trades if history is None else history, owner, years) if past is None else past
    x = x.select(F.col(owner).alias("__owner"), F.col("tdate").alias("__day"), "routine", "first")
    return trades.join(x, (F.col(owner) == F.col("__owner")) & (F.col("tdate") == F.col("__day")), "left").drop("__owner", "__day")


def with_regular(trades: DataFrame, by: tuple[str, ...] = ("owner", "ticker", "code"), history: DataFrame | None = None) -> DataFrame:
    """``trades`` with ``regular``: the last trades of this owner, issuer and kind, up to four, and this one come at even distances.

    At least three before it, each on a day of its own; no gap over 200 days; on
    average at least 20; population deviation under a quarter of the mean. False
    where a key or the day is null. ``history`` as in ``with_past``. Windows go over the distinct days of a key.
    """
    known = F.col("tdate").isNotNull()
    for c in by:
        known = known & F.col(c).isNotNull()
    days = (trades if history is None else history).where(known).groupBy(*by, "tdate").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*by).orderBy("tdate")
    x = days.select("*", *[F.lag(F.struct("tdate", "n"), k).over(w).alias(f"__{k}") for k in (1, 2, 3, 4)])
    gap = lambda a, b: F.datediff(a, b).cast("long")
    gaps = [gap("tdate", F.col("__1.tdate")), *[gap(F.col(f"__{k}.tdate"), F.col(f"__{k + 1}.tdate")) for k in (1, 2, 3)]]
    total, squares = sum((F.coalesce(g, F.lit(0)) for g in gaps), F.lit(0)), sum((F.coalesce(g * g, F.lit(0)) for g in gaps), F.lit(0))
    n = F.when(F.col("__4").isNull(), 3).otherwise(4)
    mean, deviation = total / n, F.sqrt((n * squares - total * total).cast("double")) / n
    single = (F.col("__1.n") == 1) & (F.col("__2.n") == 1) & (F.col("__3.n") == 1)
    even = single & (F.greatest(*gaps) <= 200) & (mean >= 20) & (deviation / mean < 0.25)
    found = x.where(F.col("__3").isNotNull() & even).select(*[F.col(c).alias(f"__of_{c}") for c in by], F.col("tdate").alias("__day"), F.lit(True).alias("regular"))
    on = F.col("tdate") == F.col("__day")
    for c in by:
        on = on & (F.col(c) == F.col(f"__of_{c}"))
    out = trades.join(found, on, "left").drop("__day", *[f"__of_{c}" for c in by])
    return out.withColumn("regular", F.coalesce("regular", F.lit(False)))


def typical_purchase(rows: DataFrame, trades: DataFrame, owner: str = "owner") -> DataFrame:
    """``rows`` with ``typical``: the lower median value of the owner's purchases on earlier days; null without one.

    For the rows of a card or feed: the values bought by their owners are listed.
    """
    bought = trades.where((F.col("code") == "P") & (F.col("val") > 0)).join(rows.select(owner).distinct(), owner, "left_semi")
    listed = bought.groupBy(F.col(owner).alias("__owner")).agg(F.collect_list(F.struct("tdate", "val")).alias("__bought"))
    x = rows.join(listed, F.col(owner) == F.col("__owner"), "left").drop("__owner")
    own = F.array_sort(F.transform(F.filter("__bought", lambda h: h["tdate"] < F.col("tdate")), lambda h: h["val"]))
    x = x.withColumn("__bought", own)
    return x.withColumn("typical", F.when(F.size("__bought") > 0, F.element_at("__bought", ((F.size("__bought") - 1) / 2).cast("int") + 1))).drop("__bought")


def sync_count(trades: DataFrame, groups: DataFrame | None = None, owner: str = "owner") -> DataFrame:
    """``trades`` with ``sync``: how many owner groups traded this ticker on this day at exactly this price; 1 without a price.

    ``groups`` is ``node, component`` of ``owner_groups``: a fund, its partner and
    its manager are one. An owner that is in none stands for itself. ``owner`` may be an array of all who file a row.
    """
    keys = ["ticker", "tdate", "px"]
    who = F.explode(owner) if dict(trades.dtypes)[owner].startswith("array") else F.col(owner)
    x = trades.where(F.col("px") != 0).select(*keys, who.alias("__owner")).distinct()
    if groups is not None:
        x = x.join(groups.select(F.col("node").alias("__owner"), F.col("component").alias("__group")), "__owner", "left").withColumn("__owner", F.coalesce("__group", "__owner"))
    n = x.groupBy(*keys).agg(F.count_distinct("__owner").alias("__n"))
    return trades.join(n, keys, "left").withColumn("sync", F.coalesce("__n", F.lit(1)).cast("long")).drop("__n")


def units_mismatch(trades: DataFrame, px: str = "px", close: str = "close", least: int = 5) -> DataFrame:
    """``ticker, n, med, iqr, mismatch``: purchase prices that are off the quote by one common factor.

    Three order statistics of a ticker's ratios, found by running counts over its
    distinct ratios; no ticker's ratios are listed.
    """
    r = trades.where((F.col("code") == "P") & (F.col(px) > 0) & (F.col(close) > 0)).select("ticker", (F.col(px) / F.col(close)).alias("r"))
    upto = Window.partitionBy("ticker").orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    x = r.groupBy("ticker", "r").agg(F.count("*").alias("c")).withColumn("upto", F.sum("c").over(upto)).withColumn("n", F.sum("c").over(Window.partitionBy("ticker")))

    def quantile(p: float):
        at = F.least(F.col("n") - 1, F.floor(F.lit(p) * F.col("n")))
        return F.min(F.when(F.col("upto") > at, F.col("r")))

    x = x.where(F.col("n") >= least).groupBy("ticker").agg(F.max("n").cast("int").alias("n"), quantile(0.5).alias("med"), quantile(0.25).alias("low"), quantile(0.75).alias("high"))
    x = x.withColumn("iqr", (F.col("high") - F.col("low")) / F.col("med"))
    return x.select("ticker", "n", "med", "iqr", ((F.abs(F.col("med") - 1) > 0.15) & (F.col("iqr") < 0.1)).alias("mismatch"))
