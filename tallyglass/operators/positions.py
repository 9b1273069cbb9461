"""Positions: signals of one ticker within a holding period of the first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOLD_MONTHS, MONTH_DAYS = 3, 30.5


def first_days(days: Column | str, hold_days: float = HOLD_MONTHS * MONTH_DAYS) -> Column:
    """The opening days of positions from a sorted array of days.

    A day opens a position if more than ``hold_days`` have passed since the last
    *opening*; signals in between do not extend it (unlike a session window).
    """

    def step(opened: Column, d: Column) -> Column:
        return F.when((F.size(opened) == 0) | (F.datediff(d, F.try_element_at(opened, F.lit(-1))) > hold_days), F.concat(opened, F.array(d))).otherwise(opened)

    return F.aggregate(days, F.array().cast("array<date>"), step)


def positions(signals: DataFrame, key: str, day: str, value: Column | None = None, hold_days: float = HOLD_MONTHS * MONTH_DAYS) -> DataFrame:
    """``key, first, last, n, val``: one row for each position.

    What a task holds of a key are its distinct days, bounded by the calendar;
    the signals themselves are summed by day before.
    """
    daily = signals.groupBy(key, F.col(day).alias("__d")).agg(F.count("*").alias("n"), (F.sum(value) if value is not None else F.lit(0.0)).alias("val"))
    opened = daily.groupBy(key).agg(F.array_sort(F.collect_set("__d")).alias("__days")).select(key, first_days("__days", hold_days).alias("__first"))
    rows = daily.join(opened, key)
    own = F.array_max(F.filter("__first", lambda f: f <= F.col("__d")))
    return rows.withColumn("first", own).groupBy(key, "first").agg(F.max("__d").alias("last"), F.sum("n").alias("n"), F.sum("val").alias("val"))


def status(first: Column | str, today: Column, fresh_days: int = 30, hold_months: int = HOLD_MONTHS) -> Column:
    """``new``, ``fresh``, ``held`` or ``closed`` by age."""
    age = F.datediff(today, F.col(first) if isinstance(first, str) else first)
    return F.when(age < fresh_days * 0.7, "new").when(age < fresh_days, "fresh").when(age < hold_months * MONTH_DAYS, "held").otherwise("closed")
