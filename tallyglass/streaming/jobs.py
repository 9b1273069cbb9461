"""Incremental jobs: filings that arrive in files, positions that are announced once.

Ingestion is a file stream with ``availableNow``: the checkpoint is the cursor, a
run takes what is new and stops. Loaded trades are an append log; amendments
replace what they correct at read time, however late, so no watermark drops them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallyglass.operators import published
from tallyglass.operators.filings import newest
from tallyglass.plans.compute import needs_replay
from tallyglass.sources.filings import index_entries
from tallyglass.storage import cut
from tallyglass.streaming.state import position_changes

#: Days after a position's first day in which one may still enter.
FRESH_DAYS = 45


def files(spark: SparkSession, path: str, schema: StructType | str, form: str = "parquet", per_run: int | None = None) -> DataFrame:
    """A stream of the files under ``path``; ``per_run`` files at most in a batch."""
    reader = spark.readStream.format(form).schema(schema)
    if per_run:
        reader = reader.option("maxFilesPerTrigger", per_run)
    return reader.load(path)


def append_new(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], day: str = "tdate", replace: bool = False) -> StreamingQuery:
    """Put rows into the table at ``target``, by year of ``day``: those whose key it lacks, or with ``replace`` (while older rows are read again) all.

    Each batch looks only at the years that it touches, and shows when all of it is written (``published.stored`` reads the table). A batch that is run again
    after a failure finds its rows there and adds none.
    """

    def batch(df: DataFrame, _: int) -> None:
        published.write_by_year(df, target, keys, day, replace, first_year=0)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def purge_covered(spark: SparkSession, target: str, start: date, day: str = "fdate") -> None:
    """Drop rows of before ``start``, which the quarterly tables hold by now, from the live table, in one step."""
    published.purge(spark, target, F.col(day) >= F.lit(start))


def pending_days(indexed: DataFrame, last: Column, today: Column) -> DataFrame:
    """``d``: the days to read after ``last``, in order, of those that have an index (``indexed``: d).

    Weekends have none. A weekday without an index is a holiday, unless it lies
    within two days of ``today``: then its index is still to come, and it and all
    after it wait.
    """
    days = indexed.sparkSession.range(1).select(F.explode(F.sequence(F.date_add(last, 1), today)).alias("d")).where(F.weekday("d") < 5)
    x = days.join(indexed.select("d", F.lit(True).alias("has")).distinct(), "d", "left")
    late = x.where(F.col("has").isNull() & (F.date_add("d", 2) >= today)).agg(F.min("d").alias("late"))
    return x.where("has").join(F.broadcast(late)).where(F.col("late").isNull() | (F.col("d") < F.col("late"))).select("d").orderBy("d")


def follow(lines: DataFrame, keep: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Hand the filings of the days that are ready, each once though several parties list it, to ``keep``: ``day, form, cik, path``. ``lines`` is ``archive.daily_tail``."""

    def batch(df: DataFrame, _: int) -> None:
        keep(df.groupBy("day", "path").agg(F.min("form").alias("form"), F.min("cik").alias("cik")).select("day", "form", "cik", "path"))

    return index_entries(lines, keep=["day"]).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def replay(target: str, indexed: DataFrame, parse: Callable[[DataFrame], DataFrame], keys: Sequence[str], day: str = "tdate", floor: int = 0) -> DataFrame | None:
    """Read again the days of the live table at ``target`` whose rows an older version wrote; the filings that were read, or None if there is nothing to do.

    ``indexed``: day, path of the filings that can be had; ``parse`` makes rows of some of these. They take the place of the
    stored ones in one step, all else stays, so the table is never short of rows. Rows that can't be had again remain: give
    their number as ``floor`` from then on (see ``compute.needs_replay``).
    """
    rows = published.stored(indexed.sparkSession, target)
    if rows is None:
        return None
    days = cut(needs_replay(rows, floor).select(F.col("fdate").alias("day")), "replay")
    queue = indexed.join(F.broadcast(days), "day", "left_semi")  # as many days as the live table has
    if queue.isEmpty():
        return None
    published.write_by_year(parse(queue), target, keys, day, replace=True, first_year=0)
    return queue


def corrected(log: DataFrame, content_keys: Sequence[str], order: str = "acc") -> DataFrame:
    """The log as it stands: of one content the amendment, else the later filing."""
    amended = F.when(F.col("form") == "4/A", 0).otherwise(1)
    return newest(log, content_keys, [amended, F.desc("fdate"), F.col(order)], "versions")


def new_positions(signals: DataFrame, key: str, hold_days: float = 91.5, day: str = "day") -> DataFrame:
    """A stream of ``key, first``: a row for each position that opens, none for what adds to it; see ``state.position_changes``, whose withdrawals are left out."""
    return position_changes(signals, key, day, hold_days).where("change = 1").select(key, "first")


def announce(opened: DataFrame, checkpoint: str, send: Callable[[DataFrame], None], seed: Callable[[DataFrame], None] | None = None, version: int = 1, today: Column | None = None, fresh_days: int = 7) -> StreamingQuery:
    """Hand the rows of each batch to ``send``; the very first batch of a ``version`` goes to ``seed``, silently.

    State and cursor are kept apart for each version, so that a changed rule for
    what a position is reads all again and sends nothing old. With ``today`` only
    positions opened in the last ``fresh_days`` are sent; all are remembered.
    """

    def batch(df: DataFrame, number: int) -> None:
        if number == 0 and seed is not None:
            seed(df)
        else:
            send(df if today is None else df.where(F.col("first") >= F.date_sub(today, fresh_days)))

    return opened.writeStream.foreachBatch(batch).option("checkpointLocation", f"{checkpoint}/v{version}").trigger(availableNow=True).start()


def cards(opened: DataFrame, most: int = 4, fresh_days: int = FRESH_DAYS) -> DataFrame:
    """``ticker, message`` for new positions: a card each up to ``most`` of them, else a line each of one digest, under its head (``ticker`` null, first).

    ``opened``: ticker, first, and where there are val, dd (below the high of a year) and deadline these are told; the
    deadline is ``fresh_days`` after the first day if there is none. Every position is named, however many there are.
    """
    has = lambda c, text: F.when(F.col(c).isNotNull(), text) if c in opened.columns else F.lit(None).cast("string")
    deadline = F.coalesce("deadline", F.date_add("first", fresh_days)) if "deadline" in opened.columns else F.date_add("first", fresh_days)
    depth = F.when(F.abs("dd") < 0.005, F.lit("at its high of a year")).otherwise(F.format_string("%.1f%% below its high", F.abs(F.col("dd")) * 100)) if "dd" in opened.columns else F.lit("")
    name = F.col("ticker").cast("string")
    facts = [has("val", F.concat(F.lit("$"), F.format_number(F.col("val"), 0)) if "val" in opened.columns else F.lit("")), has("dd", depth), F.concat(F.lit("enter by "), deadline.cast("string"))]
    n = opened.agg(F.count("*").alias("__n"))
    x = opened.join(F.broadcast(n))
    card = F.concat_ws(", ", F.concat_ws(" ", F.lit("New position:"), name, F.col("first").cast("string")), *facts)
    line = F.concat_ws(" · ", name, *facts)
    rows = x.select(F.col("first"), name.alias("ticker"), F.when(F.col("__n") <= most, card).otherwise(line).alias("message"))
    head = n.where(F.col("__n") > most).select(F.lit(None).cast("date").alias("first"), F.lit(None).cast("string").alias("ticker"), F.concat(F.col("__n").cast("string"), F.lit(" new positions")).alias("message"))
    return rows.unionByName(head).orderBy(F.col("ticker").isNotNull(), F.desc("first"), "ticker").select("ticker", "message")


def poll(spark: SparkSession, fetch: Callable[[], DataFrame], keep: Callable[[DataFrame], None], checkpoint: str, seconds: float = 30.0) -> StreamingQuery:
    """Ask ``fetch`` for quotes at a steady rate and hand each answer to ``keep``; a round that is late is skipped, not made up for.

    How quotes are fetched is the caller's; ``plans.compute.covered`` tells whether an answer is good enough.
    """
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def batch(df: DataFrame, _: int) -> None:
        if not df.isEmpty():
            keep(fetch())

    return ticks.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()


def live_changes(snapshot: DataFrame, quotes: DataFrame) -> DataFrame:
    """Rebase the snapshot's change on live prices: ``(1 + chg) * p / cur - 1``, or against the entry where it has none.

    ``snapshot``: symbol, cur, chg, entry_px; ``quotes`` (a stream or a table): symbol, p.
    """
    x = quotes.join(snapshot, "symbol")
    change = F.when(F.col("chg").isNotNull(), (1 + F.col("chg")) * F.try_divide("p", "cur") - 1).otherwise(F.try_divide("p", "entry_px") - 1)
    return x.select("symbol", "p", change.alias("change"))


def windowed_counts(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Events by kind in tumbling windows with a watermark: an extension beyond the batch operators."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
