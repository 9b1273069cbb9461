"""Repair of price series, in a fixed order: spikes, missed splits, holder of the symbol, data break, frozen tail.

After the spikes a series is stored with the number ``i`` of each bar. Every later
step reads it by joins and windows and gives one small row a ticker: events that
rescale what lies before them, or the range ``lo <= i < hi`` of the bars that stay.
What is sequential (a split after another, a break after another) is a fold over
these few candidates, not over the bars.

A series is bounded by the calendar (a few thousand bars).
"""

from __future__ import annotations

from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.functions.scalars import rnd
from tallyglass.operators import rolling
from tallyglass.storage import cut

COUNTS = ("spikes", "splits", "head", "tail", "break", "frozen")
EVENTS = "array<struct<p: bigint, f: double>>"
KEY = "ticker"


def _let(value: Column, f) -> Column:
    """``f(value)``, the value worked out once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _lower_median(values: Column) -> Column:
    """The lower median of an array; 0 of an empty one."""
    return _let(F.array_sort(values), lambda v: F.coalesce(F.get(v, ((F.size(v) - 1) / 2).cast("int")), F.lit(0.0)))


def numbered_without_spikes(bars: DataFrame, passes: int = 3, window: int = 30, limit: float = 3.0) -> DataFrame:
    """``ticker, d, close, adj, vol, i, n_spikes``: the bars that stay, see ``series.drop_spikes``; bars without ticker, day or price are left out."""
    rows = bars.where(F.col(KEY).isNotNull() & F.col("d").isNotNull() & F.col("adj").isNotNull() & ~F.isnan("adj"))
    rows = rows.select(KEY, "d", F.col("close").cast("double").alias("close"), F.col("adj").cast("double").alias("adj"), F.coalesce(F.nanvl(F.col("vol").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("vol"))
    schema = rows.withColumns({"i": F.lit(0).cast("long"), "n_spikes": F.lit(0).cast("long")}).schema

    def drop(x: pa.Table) -> pa.Table:
        x = x.sort_by([(c, "ascending") for c in ("d", "adj", "close", "vol")])
        left = rolling.without_spikes(rolling.numbers(x, "adj"), rolling.numbers(x, "vol"), window, limit, passes)
        gone = len(x) - len(left)
        return x.take(pa.array(left)).append_column("i", pa.array(range(len(left)), pa.int64())).append_column("n_spikes", pa.array([gone] * len(left), pa.int64()))

    return rolling.by_series(rows, drop, schema)


def missed_splits(series: DataFrame, splits: DataFrame, tolerance: float = 0.25, around: int = 3) -> DataFrame:
    """``ticker, events``: by which factors ``f`` the bars before ``p`` are to be divided, in order.

    A split matters if its ratio is at most a half or at least two. Among the bars
    around its day the step that best undoes it is sought, on prices as earlier
    events leave them; the ratio itself is used where it fits, else the step.
    ``splits``: ``ticker, d, ratio``; rows that lack one of these say nothing.
    """
    kind = series.schema[KEY].dataType
    s = splits.select(F.col(KEY).cast(kind).alias(KEY), "d", F.col("ratio").cast("double").alias("ratio"))
    s = s.where(F.col(KEY).isNotNull() & F.col("d").isNotNull() & (F.col("ratio") > 0) & ~F.isnan("ratio") & ~((F.col("ratio") > 0.5) & (F.col("ratio") < 2)))
    # bars and splits laid end to end: how many bars lie before a split's day
    line = series.select(KEY, "d", F.lit(1).alias("__bar"), F.lit(None).cast("double").alias("ratio")).unionByName(s.withColumn("__bar", F.lit(0)))
    before = Window.partitionBy(KEY).orderBy("d", "__bar").rowsBetween(Window.unboundedPreceding, 0)
    line = line.withColumns({"at": F.sum("__bar").over(before), "n": F.sum("__bar").over(Window.partitionBy(KEY))})
    marks = line.where((F.col("__bar") == 0) & (F.col("at") > 0) & (F.col("at") < F.col("n")))
    marks = marks.select(KEY, "ratio", "at", F.row_number().over(Window.partitionBy(KEY).orderBy("d", "ratio")).alias("k"))
    near = marks.withColumn("i", F.explode(F.sequence(F.col("at") - around - 1, F.col("at") + around)))
    near = near.join(series.select(KEY, "i", "adj"), [KEY, "i"]).groupBy(KEY, "k").agg(F.max("ratio").alias("ratio"), F.array_sort(F.collect_list(F.struct("i", "adj"))).alias("near"))
    found = near.groupBy(KEY).agg(F.array_sort(F.collect_list(F.struct("k", "ratio", "near"))).alias("marks"))

    def judge(events: Column, mark: Column) -> Column:
        now = F.transform(mark["near"], lambda b: F.struct(b["i"].alias("i"), _scaled(events, b["i"], b["adj"], lambda x, f: rnd(x / f)).alias("adj")))

        def best(near: Column) -> Column:
            pairs = F.zip_with(F.slice(near, 2, F.size(near) - 1), F.slice(near, 1, F.size(near) - 1), lambda b, a: F.struct(b["i"].alias("i"), F.when((a["adj"] > 0) & (b["adj"] > 0), b["adj"] / a["adj"]).alias("step")))
            return F.array_min(F.transform(F.filter(pairs, lambda x: x["step"].isNotNull()), lambda x: F.struct(F.abs(F.ln(x["step"] * mark["ratio"])).alias("miss"), x["i"].alias("i"), x["step"].alias("step"))))

        def with_event(x: Column) -> Column:
            fits = (x["miss"] <= log(2)) & (F.abs(F.ln(x["step"])) >= log(1.8))
            f = F.when(x["miss"] <= tolerance, mark["ratio"]).otherwise(1 / x["step"])
            return F.when(fits, F.concat(events, F.array(F.struct(x["i"].alias("p"), f.alias("f"))))).otherwise(events).cast(EVENTS)

        return _let(_let(now, best), with_event)

    found = found.select(KEY, F.aggregate("marks", F.array().cast(EVENTS), judge).alias("events"))
    return found.where(F.size("events") > 0)


def _scaled(events: Column, i: Column, value: Column, f) -> Column:
    return F.aggregate(F.filter(events, lambda e: e["p"] > i), value, lambda x, e: f(x, e["f"]))


def rescaled(series: DataFrame, events: DataFrame) -> DataFrame:
    """``series`` with prices divided and volumes multiplied by the factors of all later events, and ``n_splits``."""
    x = series.join(events, KEY, "left")
    price, volume = lambda v, f: rnd(v / f), lambda v, f: rnd(v * f, 0)
    new = {c: F.when(F.col("events").isNull(), F.col(c)).otherwise(_scaled(F.col("events"), F.col("i"), F.col(c), volume if c == "vol" else price)) for c in ("close", "adj", "vol")}
    return x.withColumns(new | {"n_splits": F.when(F.col("events").isNull(), 0).otherwise(F.size("events")).cast("long")}).drop("events")


def with_neighbours(series: DataFrame) -> DataFrame:
    """``series`` with ``prev`` and ``next``, the prices beside each bar."""
    w = Window.partitionBy(KEY).orderBy("i")
    return series.withColumns({"prev": F.lag("adj").over(w), "next": F.lead("adj").over(w)})


def whole(series: DataFrame) -> DataFrame:
    """``ticker, lo, hi``: all bars of each series."""
    return series.groupBy(KEY).agg(F.lit(0).cast("long").alias("lo"), F.count("*").alias("hi"))


def holder_range(series: DataFrame, holders: DataFrame, gap: int = 30, jump: float = 2.0, overhang: int = 90) -> DataFrame:
    """``ticker, lo, hi, n_head, n_tail``: what belongs to the present holder of the symbol.

    ``holders``: ``ticker, start, end``; of several rows the latest start holds, and
    without a start nothing is known. Bars after the end go if the series runs on for
    longer than ``overhang`` days (no end: none go). Bars before the start go if a gap
    or a jump parts them from the rest.
    """
    kind = series.schema[KEY].dataType
    h = holders.where(F.col(KEY).isNotNull() & F.col("start").isNotNull()).groupBy(F.col(KEY).cast(kind).alias(KEY)).agg(F.max(F.struct("start", "end")).alias("h"))
    x = series.join(h, KEY, "left")
    early = F.col("d") < F.col("h.start")
    bar = F.struct("i", "d", "adj")
    x = x.groupBy(KEY).agg(
        F.max("h.end").alias("end"), F.max("d").alias("last"), F.count("*").alias("n"), F.count_if(F.col("d") <= F.col("h.end")).alias("within"), F.count_if(early).alias("b"),
        F.max(F.when(early, bar)).alias("a"), F.min(F.when(~early, bar)).alias("c"),
    )
    hi = F.when(F.col("end") < F.date_sub("last", overhang), F.col("within")).otherwise(F.col("n"))
    a, c = F.col("a.adj"), F.col("c.adj")
    parted = (F.datediff("c.d", "a.d") >= gap) | F.when((a > 0) & (c > 0), F.greatest(a / c, c / a) >= jump).otherwise(jump <= 1)
    x = x.withColumn("hi", hi)
    lo = F.when((F.col("b") > 0) & (F.col("b") < F.col("hi")) & parted, F.col("b")).otherwise(0).cast("long")
    return x.select(KEY, lo.alias("lo"), "hi", lo.alias("n_head"), (F.col("n") - F.col("hi")).alias("n_tail")).where("hi > lo")


def break_range(series: DataFrame, ranges: DataFrame, splits: DataFrame | None = None, step: float = 5.0, level: float = 4.0, volume: float = 1.5, side: int = 30, least: int = 60) -> DataFrame:
    """``ranges`` that begin with the last upward break, and ``n_break``; ``series`` has its ``with_neighbours``.

    A break is a step of five times, not on the day of a known split, that the level
    keeps without a surge in volume; the bars before are only those since the break before it.
    """
    x = series.select(KEY, "i", "d", "adj", "prev").where(F.when(F.col("prev") > 0, F.col("adj") / F.col("prev") >= step).otherwise((F.col("prev") == 0) & (F.col("adj") > 0)))
    x = x.join(ranges.select(KEY, "lo", "hi"), KEY)
    x = x.where((F.col("hi") - F.col("lo") >= least) & (F.col("i") >= F.col("lo") + side) & (F.col("i") < F.col("hi") - 10))
    if splits is not None:
        x = x.join(splits.select(F.col(KEY).cast(series.schema[KEY].dataType).alias(KEY), "d").distinct(), [KEY, "d"], "left_anti")
    x = x.select(KEY, "lo", "hi", F.col("i").alias("at"))
    near = x.withColumn("i", F.explode(F.sequence(F.greatest("lo", F.col("at") - side), F.least(F.col("hi"), F.col("at") + side) - 1)))
    near = near.join(series.select(KEY, "i", "adj", "vol"), [KEY, "i"]).groupBy(KEY, "lo", "at").agg(F.collect_list(F.struct("i", "adj", "vol")).alias("near"))
    marks = near.groupBy(KEY, "lo").agg(F.array_sort(F.collect_list(F.struct("at", "near"))).alias("marks"))

    def judge(start: Column, mark: Column) -> Column:
        left = F.filter(mark["near"], lambda b: (b["i"] >= start) & (b["i"] < mark["at"]))
        right = F.filter(mark["near"], lambda b: b["i"] >= mark["at"])
        prices = lambda x: _lower_median(F.transform(x, lambda b: b["adj"]))
        volumes = lambda x: _lower_median(F.transform(F.filter(x, lambda b: b["vol"] > 0), lambda b: b["vol"]))
        sides = F.struct(F.size(left).alias("n"), prices(left).alias("a"), prices(right).alias("b"), volumes(left).alias("va"), volumes(right).alias("vb"))

        def move(s: Column) -> Column:
            kept = F.when((s["a"] > 0) & (s["b"] > 0), s["b"] / s["a"] >= level).otherwise(False)
            surge = F.when((s["va"] > 0) & (s["vb"] > 0), s["vb"] / s["va"] > volume).otherwise(False)
            return F.when((s["n"] >= 10) & kept & ~surge, mark["at"]).otherwise(start)

        return _let(sides, move)

    found = marks.select(KEY, F.aggregate("marks", F.col("lo"), judge).alias("__start"))
    out = ranges.join(found, KEY, "left").withColumn("__start", F.coalesce("__start", "lo"))
    return out.withColumns({"n_break": F.col("__start") - F.col("lo"), "lo": F.col("__start")}).drop("__start")


def frozen_range(series: DataFrame, ranges: DataFrame, least: int = 5, back: int = 60) -> DataFrame:
    """``ranges`` whose tail of one repeated price and almost no volume is cut back to its first bar, and ``n_frozen``; ``series`` has its ``with_neighbours``."""
    x = series.select(KEY, "i", "adj", "next").where(F.col("adj") != F.col("next"))
    x = x.join(ranges.select(KEY, "lo", "hi"), KEY).where((F.col("i") >= F.col("lo")) & (F.col("i") < F.col("hi") - 1))
    first = x.groupBy(KEY).agg((F.max("i") + 1).alias("first"))
    tails = ranges.select(KEY, "lo", "hi").join(first, KEY, "left").withColumn("first", F.coalesce("first", "lo"))
    tails = tails.where((F.col("hi") - F.col("lo") >= least + 20) & (F.col("hi") - F.col("first") >= least))
    x = series.where("vol > 0").select(KEY, "i", "vol").join(tails, KEY).where((F.col("i") >= F.greatest("lo", F.col("first") - back)) & (F.col("i") < F.col("hi")))
    x = x.groupBy(KEY, "hi", "first").agg(_lower_median(F.collect_list(F.when(F.col("i") < F.col("first"), F.col("vol")))).alias("usual"), F.coalesce(F.sum(F.when(F.col("i") > F.col("first"), F.col("vol"))), F.lit(0.0)).alias("traded"))
    frozen = x.where((F.col("usual") > 0) & (F.col("traded") <= 0.01 * F.col("usual") * (F.col("hi") - F.col("first")))).select(KEY, (F.col("first") + 1).alias("__end"))
    out = ranges.join(frozen, KEY, "left").withColumn("__end", F.coalesce("__end", "hi"))
    return out.withColumns({"n_frozen": F.col("hi") - F.col("__end"), "hi": F.col("__end")}).drop("__end")


def repair(bars: DataFrame, splits: DataFrame | None = None, holders: DataFrame | None = None) -> DataFrame:
    """Repaired bars with the ticker's counters in every row.

    ``bars``: ``ticker, d, close, adj, vol``; ``splits``: ``ticker, d, ratio``;
    ``holders``: ``ticker, start, end``, the interval of the present holder. A
    missing volume is 0, of bars of one day the lower price comes first. The series
    without spikes, those rescaled and the ranges are stored while the plan is built (``storage.cut``); a series of which nothing stays has no rows.
    """
    none = F.lit(0).cast("long")
    x = cut(numbered_without_spikes(bars), "series")
    x = cut(with_neighbours(x.withColumn("n_splits", none) if splits is None else rescaled(x, missed_splits(x, splits))), "rescaled")
    ranges = whole(x).withColumns({"n_head": none, "n_tail": none}) if holders is None else holder_range(x, holders)
    # a row a ticker, read several times by the next step
    ranges = cut(break_range(x, cut(ranges, "ranges"), splits), "ranges")
    ranges = frozen_range(x, ranges)
    out = x.join(ranges, KEY).where((F.col("i") >= F.col("lo")) & (F.col("i") < F.col("hi")))
    return out.select(KEY, "d", "close", "adj", "vol", *[f"n_{c}" for c in COUNTS])


def counters(repaired: DataFrame) -> DataFrame:
    """One row for each ticker of ``repair``'s result: its counters, told once however often the series is read."""
    names = [f"n_{c}" for c in COUNTS]
    return repaired.groupBy("ticker").agg(F.count("*").alias("bars"), *[F.max(c).alias(c) for c in names])


def splice(cached: DataFrame, fresh: DataFrame) -> DataFrame:
    """Cached bars strictly before each ticker's first fresh bar, then the fresh ones."""
    first = fresh.groupBy("ticker").agg(F.min("d").alias("__first"))
    old = cached.join(first, "ticker", "left").where(F.col("__first").isNull() | (F.col("d") < F.col("__first"))).drop("__first")
    return old.unionByName(fresh)


def guarded(cached: DataFrame, fresh: DataFrame, least: float = 0.5) -> DataFrame:
    """Fresh series, but the cached one where the fresh has less than ``least`` of its length or is missing."""
    old, new = (x.groupBy("ticker").agg(F.count("*").alias(n)) for x, n in ((cached, "__o"), (fresh, "__n")))
    pick = old.join(new, "ticker", "full").select("ticker", (F.coalesce("__n", F.lit(0)) >= least * F.coalesce("__o", F.lit(0))).alias("__fresh"))
    take = lambda x, want: x.join(pick.where(F.col("__fresh") == want).select("ticker"), "ticker", "left_semi")
    return take(cached, False).unionByName(take(fresh, True))
