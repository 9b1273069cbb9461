"""Keyed state of streams: quotes that age, positions that late days change.

Both keep little for a key and need the RocksDB state store, which the functions
choose for the session.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Seconds that a quote is fresh, that it may still be shown, and that a source is left alone after it refused.
FRESH_SECONDS, STALE_SECONDS, COOLDOWN_SECONDS = 30, 1800, 300
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EPOCH = dt.date(1970, 1, 1)


def _with_rocks(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)


_CACHE = "symbol string, at timestamp, p double, state string, cooling boolean"


class _QuoteCache(StatefulProcessor):
    """State of a symbol: its latest quote, and until when its source is left alone (milliseconds)."""

    def __init__(self, stale: int, cooldown: int):
        self.stale, self.cooldown = 1000 * stale, 1000 * cooldown

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.quote = handle.getValueState("quote", "at long, p double, fresh long")
        self.until = handle.getValueState("until", "ms long")

    def _state(self, at: int, fresh: int, now: int) -> str:
        return "fresh" if now <= at + fresh else "stale" if now <= at + self.stale else "gone"

    def _row(self, symbol: str, now: int) -> pd.DataFrame:
        at, p, fresh = self.quote.get() if self.quote.exists() else (None, None, 0)
        cooling = self.until.exists() and now <= self.until.get()[0]
        shown = None if at is None else pd.Timestamp(at, unit="ms")
        return pd.DataFrame({"symbol": [symbol], "at": [shown], "p": [p], "state": ["gone" if at is None else self._state(at, fresh, now)], "cooling": [cooling]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = 0
        for frame in rows:
            for at, p, refused, ttl in zip(frame["at"], frame["p"], frame["refused"], frame["ttl"]):
                ms = int(at.timestamp() * 1000)
                now = max(now, ms)
                if refused:
                    until = ms + self.cooldown
                    if not self.until.exists() or until > self.until.get()[0]:
                        self.until.update((until,))
                        self.handle.registerTimer(until + 1)
                elif p == p and (not self.quote.exists() or (ms, p) > tuple(self.quote.get())[:2]):  # an older answer changes nothing
                    self.quote.update((ms, float(p), 1000 * int(ttl)))
                    self.handle.registerTimer(ms + 1000 * int(ttl) + 1)
                    self.handle.registerTimer(ms + self.stale + 1)
        yield self._row(key[0], max(now, timerValues.getCurrentWatermarkInMs()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, due = timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()
        last, _, fresh = self.quote.get() if self.quote.exists() else (None, None, 0)
        # timers of quotes that were replaced since are passed over
        gone = last is not None and now > last + self.stale
        mine = last is not None and due == last + fresh + 1
        if gone or mine or (self.until.exists() and due == self.until.get()[0] + 1):
            yield self._row(key[0], now)
        if gone:
            self.quote.clear()
        if self.until.exists() and now > self.until.get()[0]:
            self.until.clear()

    def close(self) -> None:
        pass


def quote_cache(answers: DataFrame, late: str = "0 seconds", fresh_seconds: int = FRESH_SECONDS, stale_seconds: int = STALE_SECONDS, cooldown_seconds: int = COOLDOWN_SECONDS) -> DataFrame:
    """A stream of ``symbol, at, p, state, cooling``: a row whenever a symbol's quote, or what it is worth by now, changes.

    ``answers``: symbol, at (timestamp), p (null if it failed), refused (the source limits
    its callers), and perhaps ttl (seconds that it is fresh, where its source is dearer than usual). A quote is ``fresh`` at first, ``stale`` (to be shown with a warning) after that,
    then ``gone`` and forgotten: timers tell, no new answer is needed. After a refusal
    the symbol is ``cooling`` for a while, and what is cached is still there. Time is that
    of the answers (a watermark, ``late`` behind them), so a replay gives what
    happened. The last row of each symbol is what ``compute.snapshot`` makes of all answers at that time.
    """
    _with_rocks(answers.sparkSession)
    ttl = F.coalesce(F.col("ttl").cast("long"), F.lit(fresh_seconds)) if "ttl" in answers.columns else F.lit(fresh_seconds).cast("long")
    rows = answers.select(F.col("symbol").cast("string"), F.col("at").cast("timestamp").alias("at"), F.col("p").cast("double"), F.coalesce(F.col("refused").cast("boolean"), F.lit(False)).alias("refused"), ttl.alias("ttl"))
    rows = rows.where("symbol is not null and at is not null").withWatermark("at", late)
    return rows.groupBy("symbol").transformWithStateInPandas(_QuoteCache(stale_seconds, cooldown_seconds), _CACHE, "Update", "EventTime")


def latest(rows: DataFrame) -> DataFrame:
    """The last row of each symbol of a table of ``quote_cache``'s rows with ``batch``, the number of the batch that gave them."""
    worth = F.when(F.col("state") == "fresh", 0).when(F.col("state") == "stale", 1).otherwise(2)
    return rows.groupBy("symbol").agg(F.max(F.struct("batch", F.coalesce(F.col("at"), F.lit(0).cast("timestamp")).alias("order"), worth.alias("worth"), ~F.col("cooling"), F.struct("at", "p", "state", "cooling").alias("x"))).alias("y")).select("symbol", "y.x.*")


def to_ask(cache: DataFrame, wanted: DataFrame) -> DataFrame:
    """The symbols of ``wanted`` to ask for now: those without a fresh quote whose source is not left alone. ``cache`` has a row for each symbol."""
    x = wanted.select("symbol").distinct().join(cache.select("symbol", "state", "cooling"), "symbol", "left")
    return x.where((F.coalesce("state", F.lit("gone")) != "fresh") & ~F.coalesce("cooling", F.lit(False))).select("symbol")


class _Positions(StatefulProcessor):
    """State of a key: the days of its signals, in order (days since 1970)."""

    def __init__(self, name: str, hold_days: float):
        self.name, self.hold = name, hold_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getValueState("days", "days array<int>")

    def _opened(self, days: list[int]) -> set[int]:
        found: list[int] = []
        for d in days:
            if not found or d - found[-1] > self.hold:
                found.append(d)
        return set(found)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = list(self.days.get()[0]) if self.days.exists() else []
        new = {int(d) for frame in rows for d in frame["day"] if d == d} - set(known)
        if new:
            days = sorted({*known, *new})
            self.days.update((days,))
            before, after = self._opened(known), self._opened(days)
            changes = sorted([(d, -1) for d in before - after] + [(d, 1) for d in after - before])
            if changes:
                yield pd.DataFrame({self.name: [key[0]] * len(changes), "first": [_EPOCH + dt.timedelta(days=d) for d, _ in changes], "change": [c for _, c in changes]})

    def close(self) -> None:
        pass


def position_changes(signals: DataFrame, key: str, day: str = "day", hold_days: float = 91.5) -> DataFrame:
    """A stream of ``key, first, change``: 1 for a position that opens on that day, -1 for one that an earlier day, come late, makes part of another.

    State is the distinct days of a key, bounded by the calendar. Whatever the order in
    which days come, the changes so far add up to the openings that ``positions``
    finds in all of them. Null days are passed over.
    """
    _with_rocks(signals.sparkSession)
    kind = signals.schema[key].dataType.simpleString()
    rows = signals.select(key, F.datediff(F.col(day).cast("date"), F.lit(str(_EPOCH)).cast("date")).alias("day")).where(f"`{key}` is not null and day is not null")
    return rows.groupBy(key).transformWithStateInPandas(_Positions(key, hold_days), f"`{key}` {kind}, first date, change int", "Append", "None")
