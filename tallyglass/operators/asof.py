"""As-of joins without a range join.

Only the distinct days of a series are probed: these and the bars are laid end to
end, each series is sorted once by day with bars before probes of the same day,
and a running last value carries the bar over. What a task holds of one series is
bounded by the calendar, however many rows ask; they get the answer by an equal
join on series and day, whose large keys the adaptive skew join can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def per_day(probes: DataFrame, by: str, day: str, answer) -> DataFrame:
    """``probes`` with the columns that ``answer`` adds to their distinct ``by, day`` (null where either is null)."""
    asked = probes.select(F.col(by), F.col(day).alias("__d")).distinct().where(F.col(by).isNotNull() & F.col("__d").isNotNull())
    found = answer(asked)
    new = [c for c in found.columns if c not in (by, "__d")]
    found = found.select(F.col(by).alias("__by"), F.col("__d").alias("__day"), *[F.col(c).alias(c) for c in new])
    return probes.join(found, (F.col(by) == F.col("__by")) & (F.col(day) == F.col("__day")), "left").select(*probes.columns, *new)


def as_of(probes: DataFrame, bars: DataFrame, day: str, by: str = "ticker", bar_day: str = "d", name: str = "bar") -> DataFrame:
    """``probes`` with a struct ``name``: the last row of ``bars`` of the same ``by`` at or before ``day``, else null."""
    one = F.struct(*[F.col(c) for c in bars.columns if c != by])
    right = bars.select(F.col(by), F.col(bar_day).alias("__d"), F.lit(0).alias("__k"), one.alias("__bar"))

    def answer(asked: DataFrame) -> DataFrame:
        left = asked.select(by, "__d", F.lit(1).alias("__k"), F.lit(None).cast(right.schema["__bar"].dataType).alias("__bar"))
        w = Window.partitionBy(by).orderBy("__d", "__k").rowsBetween(Window.unboundedPreceding, 0)
        return left.unionByName(right).withColumn(name, F.last("__bar", ignorenulls=True).over(w)).where("__k = 1").select(by, "__d", name)

    return per_day(probes, by, day, answer)


def calendar_as_of(series: DataFrame, days: DataFrame, day: str = "d", name: str = "b") -> DataFrame:
    """For each distinct ``day`` of ``days`` the last row of one common ``series`` at or before it.

    Both sides have at most a row for each calendar day, so the single sort is of
    thousands of rows at any scale of data; join the result back on the day.
    """
    wanted = days.select(F.col(day).alias("d")).distinct().withColumn("__k", F.lit(1))
    fields = [c for c in series.columns if c != "d"]
    one = F.struct("d", *fields)
    bars = series.select("d", F.lit(0).alias("__k"), one.alias("__bar"))
    rows = wanted.withColumn("__bar", F.lit(None).cast(bars.schema["__bar"].dataType)).unionByName(bars)
    w = Window.partitionBy(F.lit(0)).orderBy("d", "__k").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last("__bar", ignorenulls=True).over(w)).where("__k = 1").select(F.col("d").alias(day), name)


def entry_after(probes: DataFrame, bars: DataFrame, day: str, max_gap_days: int = 10) -> DataFrame:
    """``probes`` with ``entry``: the first bar strictly after ``day``, or null.

    ``bars`` has ``ticker, d, i``. Where the series begins after ``day``, its first
    bar counts only within ``max_gap_days``.
    """
    followed = bars.withColumn("next", F.lead(F.struct(*[c for c in bars.columns if c != "ticker"])).over(Window.partitionBy("ticker").orderBy("d")))
    found = as_of(probes, followed, day, name="__at")
    first = bars.where("i = 0").select(F.col("ticker").alias("__t"), F.struct(*[c for c in bars.columns if c != "ticker"]).alias("__first"))
    found = found.join(first, F.col("ticker") == F.col("__t"), "left")
    near = F.col("__first.d") <= F.date_add(F.col(day), max_gap_days)
    entry = F.when(F.col("__at").isNull(), F.when(near, F.col("__first"))).otherwise(F.col("__at.next"))
    return found.withColumn("entry", entry).withColumn("at", F.col("__at").dropFields("next")).drop("__t", "__first", "__at")


def interval_lookup(probes: DataFrame, intervals: DataFrame, day: str, by: str = "ticker", start: str = "start", end: str = "end") -> DataFrame:
    """``probes`` with ``hits``: the number of intervals of the same ``by`` that hold ``day``, ends included.

    Counts of starts and of ends before the day, each an ordered running sum, so
    no probe meets an interval that does not hold it.
    """
    w = Window.partitionBy(by).orderBy("__d", "__k").rowsBetween(Window.unboundedPreceding, 0)
    edges = intervals.select(F.col(by), F.explode(F.array(F.struct(F.col(start).alias("d"), F.lit(0).alias("k"), F.lit(1).alias("n")), F.struct(F.col(end).alias("d"), F.lit(2).alias("k"), F.lit(-1).alias("n")))).alias("x"))
    edges = edges.groupBy(by, F.col("x.d").alias("__d"), F.col("x.k").alias("__k")).agg(F.sum("x.n").alias("__n"))

    def answer(asked: DataFrame) -> DataFrame:
        laid = edges.unionByName(asked.select(by, "__d", F.lit(1).alias("__k"), F.lit(0).cast("long").alias("__n")))
        return laid.withColumn("hits", F.sum("__n").over(w)).where("__k = 1").select(by, "__d", "hits")

    return per_day(probes, by, day, answer).withColumn("hits", F.coalesce("hits", F.lit(0)))


def covers(probes: DataFrame, intervals: DataFrame, first: str, last: str, by: str = "ticker", start: str = "start", end: str = "end") -> DataFrame:
    """``probes`` with ``covered``: whether one single interval of the same ``by`` holds both days; null where ``by`` has none.

    Of the intervals that begin by the first day only the farthest end matters: a running maximum, looked up as of that day.
    """
    w = Window.partitionBy(by).orderBy(start)
    reach = intervals.select(by, F.col(start).alias("d"), F.max(end).over(w).alias("reach"), F.lit(0).alias("i")).distinct()
    x = as_of(probes, reach, first, by, name="__r")
    known = intervals.select(F.col(by).alias("__known")).distinct()
    x = x.join(known, F.col(by) == F.col("__known"), "left")
    return x.withColumn("covered", F.when(F.col("__known").isNotNull(), F.coalesce(F.col("__r.reach") >= F.col(last), F.lit(False)))).drop("__r", "__known")
