"""Ordered-series operators over bars ``ticker, d, close, adj, vol, i``."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from tallyglass.functions.scalars import adv_bucket, ratio, rnd
from tallyglass.operators import rolling
from tallyglass.operators.asof import as_of, calendar_as_of, entry_after, per_day

YEAR_BARS, MONTH_BARS, MIN_BARS = 252, 21, 30
HORIZONS = {"3": 63, "6": 126, "12": 252, "24": 504}
SHORT_COLUMNS = {"d1": 1, "w1": 5, "m1": 21, "m6": 126}
STALE_DAYS = 14


def _by_day():
    return Window.partitionBy("ticker").orderBy("d")


def drawdown_bars(bars: DataFrame) -> DataFrame:
    """``dd``: close against its high of the last 252 bars, from the 31st bar on.

    A window of 252 bars is the end of one block of 252 and the beginning of the
    next: the running high of a block so far, and that of a block from a bar on,
    251 bars before. So each bar is looked at twice, whatever the length of the window.
    """
    x = bars.withColumn("__row", F.row_number().over(_by_day()) - 1).withColumn("__block", F.floor(F.col("__row") / YEAR_BARS))
    block = Window.partitionBy("ticker", "__block")
    upto = block.orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    onward = block.orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("__rest", F.max("close").over(onward)).withColumn("__so_far", F.max("close").over(upto))
    high = F.greatest("__so_far", F.lag("__rest", YEAR_BARS - 1).over(_by_day()))  # nulls are passed over
    x = x.withColumn("__high", high)
    dd = F.when((F.col("i") >= MIN_BARS) & (F.col("__high") > 0) & (F.col("close") > 0), rnd(ratio("close", "__high") - 1))
    return x.select(*bars.columns, dd.alias("dd"))


def _highs(rows: DataFrame, days: int) -> DataFrame:
    """The high of ``close`` in the ``days`` before each row with ``__asked``, its own day included: ``ticker, __n, high``. ``rows``: ticker, __n (day number), close, __asked.

    As in ``drawdown_bars``, with blocks of as many days: the answer is the higher of a block's running high at the window's end
    and of another's, taken from its end, at the window's beginning.
    """
    size = days + 1
    edges = rows.where("__asked").select("ticker", F.explode(F.array(F.struct("__n", F.lit(True).alias("end"), F.col("__n").alias("of")), F.struct((F.col("__n") - days).alias("__n"), F.lit(False).alias("end"), F.col("__n").alias("of")))).alias("x"))
    laid = rows.where("not __asked").select("ticker", "__n", "close", F.lit(None).cast("boolean").alias("end"), F.lit(None).cast("int").alias("of"))
    laid = laid.unionByName(edges.select("ticker", "x.__n", F.lit(None).cast("double").alias("close"), "x.end", "x.of"))
    block = Window.partitionBy("ticker", F.floor(F.col("__n") / size))
    upto = block.orderBy("__n").rangeBetween(Window.unboundedPreceding, 0)
    onward = block.orderBy(F.desc("__n")).rangeBetween(Window.unboundedPreceding, 0)
    laid = laid.withColumn("__so_far", F.max("close").over(upto)).withColumn("__rest", F.max("close").over(onward)).where("end is not null")
    return laid.groupBy("ticker", F.col("of").alias("__n")).agg(F.max(F.when(F.col("end"), F.col("__so_far")).otherwise(F.col("__rest"))).alias("high"))


def drawdown_calendar(bars: DataFrame, probes: DataFrame, day: str = "tdate", days: int = 365) -> DataFrame:
    """``probes`` with ``dd``: the as-of close against the high of the ``days`` before ``day``.

    The window begins at the probe's day, not at the bar's: the distinct days that
    are asked for stand in the same ordered series as bars, as rows without a price.
    """
    none, epoch = F.lit(None), F.lit("1970-01-01").cast("date")
    right = bars.select("ticker", F.col("d").alias("__d"), "close", F.col("i").cast("int").alias("i"), F.lit(False).alias("__asked"))

    def answer(asked: DataFrame) -> DataFrame:
        left = asked.select("ticker", "__d", none.cast("double").alias("close"), none.cast("int").alias("i"), F.lit(True).alias("__asked"))
        rows = left.unionByName(right).withColumn("__n", F.datediff("__d", epoch))
        w = Window.partitionBy("ticker").orderBy("__n")
        # the last bar is the one with the largest place; its close rides along in the struct
        last = F.max(F.when(F.col("i").isNotNull(), F.struct("i", "close"))).over(w.rangeBetween(Window.unboundedPreceding, 0))
        found = rows.withColumn("__last", last).where("__asked").join(_highs(rows, days), ["ticker", "__n"])
        ok = (F.col("__last.i") >= MIN_BARS) & (F.col("high") > 0) & (F.col("__last.close") > 0)
        return found.select("ticker", "__d", F.when(ok, rnd(ratio("__last.close", "high") - 1)).alias("dd"))

    return per_day(probes, "ticker", day, answer)


def momentum(bars: DataFrame) -> DataFrame:
    """``mom``: adjusted price a month ago against a year ago, in bars."""
    a, b = F.lag("adj", YEAR_BARS).over(_by_day()), F.lag("adj", MONTH_BARS).over(_by_day())
    return bars.withColumn("mom", F.when((a > 0) & (b > 0), rnd(ratio(b, a) - 1)))


def adv(bars: DataFrame, window: int = 60, min_index: int = 20, min_values: int = 15) -> DataFrame:
    """``adv``: the lower median of close times volume over the last ``window`` bars, a whole number."""
    value = F.when((F.col("vol") > 0) & ~F.isnan("vol"), F.col("close") * F.col("vol"))
    rows = bars.withColumn("adv", value.cast("double"))

    def medians(x: pa.Table) -> pa.Table:
        found = rolling.lower_medians(rolling.numbers(x, "adv"), window, min_values)
        return x.set_column(x.schema.get_field_index("adv"), "adv", pa.array(found, from_pandas=True))

    x = rolling.by_series(rows, medians, rows.schema)
    return x.withColumn("adv", F.when(F.col("i") >= min_index, rnd("adv", 0))).withColumn("bucket", adv_bucket("adv"))


def nominal_factor(splits, day) -> F.Column:
    """The product of the ratios of all splits after ``day``; ``splits`` is an array of (d, ratio)."""
    later = F.filter(splits, lambda s: s["d"] > day)
    return F.coalesce(F.aggregate(later, F.lit(1.0), lambda x, s: x * s["ratio"]), F.lit(1.0))


def split_adjusted(bars: DataFrame) -> DataFrame:
    """Nominal ``close, vol, factor`` to split-adjusted ones: by the factors of all later bars; null is 1."""
    later = Window.partitionBy("ticker").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, -1)
    f = F.coalesce(F.product(F.coalesce("factor", F.lit(1.0))).over(later), F.lit(1.0))
    return bars.withColumn("__f", f).withColumn("close", F.col("close") / F.col("__f")).withColumn("vol", F.col("vol") * F.col("__f")).drop("__f")


def islands(intervals: DataFrame, by: str = "ticker", start: str = "start", end: str = "end", gap_days: int = 30) -> DataFrame:
    """Merge intervals that overlap or lie at most ``gap_days`` apart: ``by, start, end, n``."""
    w = Window.partitionBy(by).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("__reach").isNull() | (F.col(start) > F.date_add("__reach", gap_days)), 1).otherwise(0)
    rows = intervals.withColumn("__reach", reach).withColumn("__fresh", fresh)
    rows = rows.withColumn("island", F.sum("__fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(by, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("island")


def latest_island(islands_: DataFrame, by: str = "ticker") -> DataFrame:
    """The last merged interval of each ``by``: what its present holder covers."""
    return islands_.groupBy(by).agg(F.max(F.struct("start", "end")).alias("x")).select(by, "x.start", "x.end")


def spike_candidates(bars: DataFrame, window: int = 30, ratio_limit: float = 3.0) -> DataFrame:
    """One pass of the spike test: ``spike`` marks bars far from the median of their neighbours.

    A bar is tested if it is 25 % off the mean log of its neighbours and has three
    on either side; it is kept where the two sides differ by more than the limit
    (a level shift), or where its volume confirms a move of less than tenfold.
    Medians are worked out for tested bars only.
    """
    schema = StructType([*bars.schema.fields, StructField("spike", BooleanType()), StructField("neighbours", DoubleType())])

    def test(x: pa.Table) -> pa.Table:
        found, middle = rolling.spikes(rolling.numbers(x, "adj"), np.nan_to_num(rolling.numbers(x, "vol")), window, ratio_limit)
        return x.append_column("spike", pa.array(found)).append_column("neighbours", pa.array(middle, from_pandas=True))

    return rolling.by_series(bars, test, schema)


def drop_spikes(bars: DataFrame, passes: int = 3, window: int = 30, ratio_limit: float = 3.0) -> DataFrame:
    """``bars`` without spikes, in several passes: a spike beside another shows once that is gone. One shuffle serves all passes."""

    def drop(x: pa.Table) -> pa.Table:
        return x.take(pa.array(rolling.without_spikes(rolling.numbers(x, "adj"), np.nan_to_num(rolling.numbers(x, "vol")), window, ratio_limit, passes)))

    return rolling.by_series(bars, drop, bars.schema)


def weekly_close(bars: DataFrame) -> DataFrame:
    """The last close of each ISO week: ``ticker, year, week, d, close``."""
    keys = (F.extract(F.lit("YEAROFWEEK"), F.col("d")).cast("int").alias("year"), F.weekofyear("d").alias("week"))
    return bars.groupBy("ticker", *keys).agg(F.max("d").alias("d"), F.max_by("close", "d").alias("close"))


def forward_returns(trades: DataFrame, bars: DataFrame, bench: DataFrame, as_of_day, alive=None, horizons: dict = HORIZONS, short: dict = SHORT_COLUMNS, small: DataFrame | None = None) -> DataFrame:
    """Returns from the first bar after ``fdate``, and over a common benchmark.

    For each horizon ``r`` (return), ``x`` (over the benchmark; where it has no
    window nothing is subtracted) and ``s``: c closed, d delisted (closed at the
    last bar, which must be after the entry), o open. ``short`` columns only where
    matured. With ``small``, a benchmark of small companies, there is also ``e``:
    over that one where the row's ``bucket`` is micro or small, else the common
    one. ``matured`` is the day on which the second horizon ended. ``no_entry`` marks trades before the series begins. ``alive`` is an
    optional frame ``ticker, through``: the registry's last listing day; a series
    that ended is delisted only if the registry does not know better.
    """
    ends = bars.groupBy("ticker").agg(F.max(F.struct("i", "d", "adj")).alias("last"))
    if alive is not None:
        ends = ends.join(alive.select("ticker", "through"), "ticker", "left")
    else:
        ends = ends.withColumn("through", F.lit(None).cast("date"))
    stale = F.date_sub(as_of_day, STALE_DAYS)
    ends = ends.withColumn("dead", (F.col("last.d") < stale) & (F.col("through").isNull() | (F.col("through") < stale)))
    w = _by_day()
    steps = sorted({*horizons.values(), *short.values()})
    ahead = bars.select(F.col("ticker").alias("__t"), F.col("i").alias("__i"), *[F.lead(F.struct("d", "adj"), h).over(w).alias(f"f{h}") for h in steps])
    rows = entry_after(trades, bars.select("ticker", "d", "i", "adj"), "fdate").join(ends, "ticker", "left")
    rows = rows.join(ahead, (F.col("ticker") == F.col("__t")) & (F.col("entry.i") == F.col("__i")), "left").drop("__t", "__i")
    # exits that need a benchmark: the day of each
    for m, h in horizons.items():
        late = F.col("dead") & (F.col("last.i") > F.col("entry.i"))
        exit_ = F.when(F.col(f"f{h}").isNotNull(), F.col(f"f{h}")).when(late, F.struct(F.col("last.d").alias("d"), F.col("last.adj").alias("adj")))
        status = F.when(F.col("entry").isNull(), "o").when(F.col(f"f{h}").isNotNull(), "c").when(late, "d").otherwise("o")
        rows = rows.withColumn(f"s{m}", status).withColumn(f"__x{m}", F.when(F.col("entry").isNotNull(), exit_))
    days = rows.select(F.explode(F.array(F.col("entry.d"), *[F.col(f"__x{m}.d") for m in horizons])).alias("d")).where("d is not null").distinct()
    common = calendar_as_of(bench, days)
    common = common.withColumn("s", F.col("b")) if small is None else common.join(calendar_as_of(small, days, name="s"), "d")
    is_small = F.col("bucket").isin("micro", "small") if small is not None else F.lit(False)

    def at(name: str, day) -> None:
        """Add both benchmarks' bars as of a day; the calendar bounds the table."""
        nonlocal rows
        rows = rows.join(F.broadcast(common.select(F.col("d").alias("__d"), F.struct("b", "s").alias(name))), day == F.col("__d"), "left").drop("__d")

    def moved(kind: str, m: str):
        """How the benchmark moved meanwhile; 0 where it has no window."""
        begin, end = F.col(f"__be.{kind}"), F.col(f"__b{m}.{kind}")
        return F.coalesce(F.when(end["d"] > begin["d"], ratio(end["adj"], begin["adj"]) - 1), F.lit(0.0))

    at("__be", F.col("entry.d"))
    for m in horizons:
        at(f"__b{m}", F.col(f"__x{m}.d"))
        r = ratio(F.col(f"__x{m}.adj"), F.col("entry.adj")) - 1
        rows = rows.withColumns({f"r{m}": rnd(r), f"x{m}": rnd(r - moved("b", m))})
        if small is not None:
            rows = rows.withColumn(f"e{m}", rnd(r - F.when(is_small, moved("s", m)).otherwise(moved("b", m))))
    for name, h in short.items():
        rows = rows.withColumn(name, rnd(ratio(F.col(f"f{h}.adj"), F.col("entry.adj")) - 1))
    rows = rows.withColumn("no_entry", F.col("entry").isNull() & F.col("at").isNull())
    figures = [f"{p}{m}" for m in horizons for p in ("rxs" if small is None else "rexs")]
    second = list(horizons)[min(1, len(horizons) - 1)]
    return rows.select(*trades.columns, F.col("entry.d").alias("entry_day"), *figures, *short, F.col(f"__x{second}.d").alias("matured"), "no_entry")


def _later_product(value: str, n: str) -> F.Column:
    """The product of a ticker's values on later days than a row's; 1 without any. Backwards, so that it is a running one."""
    later = Window.partitionBy("ticker").orderBy(F.desc(n)).rangeBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.product(value).over(later), F.lit(1.0))


def nominal_closes(bars: DataFrame, splits: DataFrame) -> DataFrame:
    """``bars`` with ``nominal``: the close as it was quoted, by the ratios of all splits after its day, to four places.

    ``splits``: ticker, d, ratio.
    """
    rows = bars.withColumn("__ratio", F.lit(None).cast("double")).unionByName(splits.select("ticker", "d", F.col("ratio").cast("double").alias("__ratio")), allowMissingColumns=True)
    x = rows.withColumn("__n", F.datediff("d", F.lit("1970-01-01").cast("date")))
    x = x.withColumn("__f", _later_product("__ratio", "__n")).where("__ratio is null")
    return x.select(*bars.columns, rnd(F.col("close") * F.col("__f")).alias("nominal"))


def day_features(trades: DataFrame, bars: DataFrame, splits: DataFrame | None = None, day: str = "tdate", days: int = 365) -> DataFrame:
    """``trades`` with what the series says on ``day``: ``close, hist_days, adv, bucket, dd``.

    ``close`` is that of the last bar so far, as it was quoted on ``day`` (see
    ``nominal_closes``; without ``splits`` as it is); ``hist_days`` the number of
    bars so far, null without a series; ``adv`` and ``bucket`` those of that bar,
    ``bars`` has them; ``dd`` see ``drawdown_calendar``; ``split`` the product of
    the ratios of later splits (1 without). Bars, splits and the
    distinct days asked for are sorted once for all of it.
    """
    kinds = {"close": "double", "i": "int", "adv": "double", "bucket": "string", "__ratio": "double", "__asked": "boolean"}
    laid = lambda df, **own: df.select("ticker", "__d", *[own.get(c, F.lit(None)).cast(t).alias(c) for c, t in kinds.items()])
    rows = laid(bars.withColumnRenamed("d", "__d"), **{c: F.col(c) for c in ("close", "i", "adv", "bucket")}, __asked=F.lit(False))
    if splits is not None:
        rows = rows.unionByName(laid(splits.withColumnRenamed("d", "__d"), __ratio=F.col("ratio"), __asked=F.lit(False)))

    def answer(asked: DataFrame) -> DataFrame:
        x = rows.unionByName(laid(asked, __asked=F.lit(True))).withColumn("__n", F.datediff("__d", F.lit("1970-01-01").cast("date")))
        w = Window.partitionBy("ticker").orderBy("__n")
        bar = F.when(F.col("i").isNotNull(), F.struct("i", "close", "adv", "bucket"))
        x = x.withColumns(
            {
                "__high": F.max("close").over(w.rangeBetween(-days, 0)),
                "__last": F.max(bar).over(w.rangeBetween(Window.unboundedPreceding, 0)),
                "__f": _later_product("__ratio", "__n"),
                "__any": F.count("i").over(Window.partitionBy("ticker")) > 0,
            }
        ).where("__asked")
        ok = (F.col("__last.i") >= MIN_BARS) & (F.col("__high") > 0) & (F.col("__last.close") > 0)
        return x.select(
            "ticker",
            "__d",
            (rnd(F.col("__last.close") * F.col("__f")) if splits is not None else F.col("__last.close")).alias("close"),
            F.when(F.col("__any"), F.coalesce(F.col("__last.i"), F.lit(-1)) + 1).cast("int").alias("hist_days"),
            F.col("__last.adv").alias("adv"),
            F.col("__last.bucket").alias("bucket"),
            F.when(ok, rnd(ratio("__last.close", "__high") - 1)).alias("dd"),
            F.col("__f").alias("split"),
        )

    new = [c for c in ("close", "hist_days", "adv", "bucket", "dd", "split") if c in trades.columns]
    return per_day(trades.drop(*new), "ticker", day, answer)


def entry_features(trades: DataFrame, bars: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """``trades`` with ``entry_day, entry_px``: the first bar after the filing and its close as it was quoted then."""
    b = bars.select("ticker", "d", "close", "i")
    b = b.withColumn("nominal", F.col("close")) if splits is None else nominal_closes(b, splits)
    found = entry_after(trades, b.select("ticker", "d", "nominal", "i"), "fdate")
    return found.select(*trades.columns, F.col("entry.d").alias("entry_day"), F.col("entry.nominal").alias("entry_px"))
