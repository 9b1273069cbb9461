import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyglass.operators import published
from tallyglass.streaming import jobs

SCHEMA = "acc string, form string, fdate date, tdate date, owner long, val double"


def write(spark, path, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def test_append_is_resumable_and_amendments_win(spark, tmp_path):
    d = dt.date(2020, 2, 5)
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    run = lambda: jobs.append_new(jobs.files(spark, f"{src}/*", SCHEMA, per_run=1), out, ck, ["acc"]).awaitTermination()
    write(spark, src, "a", [("A", "4", d, d, 1, 5.0), ("A", "4", d, d, 1, 5.0), ("B", "4", d, dt.date(2019, 1, 1), 2, 7.0)])
    run()
    write(spark, src, "b", [("A", "4", d, d, 1, 5.0), ("AR", "4/A", d + dt.timedelta(days=900), d, 1, 6.0)])
    run()
    run()
    log = published.stored(spark, out)
    assert sorted(r.acc for r in log.collect()) == ["A", "AR", "B"]
    assert sorted((r.acc, r.val) for r in jobs.corrected(log, ["owner", "tdate"]).collect()) == [("AR", 6), ("B", 7)]
    with pytest.raises(Exception):  # another failure than a missing target is not swallowed
        jobs.append_new(jobs.files(spark, f"{src}/*", SCHEMA), out, f"{ck}2", ["nothing"]).awaitTermination()
    write(spark, src, "c", [("A", "4", d, d, 1, 9.0)])
    jobs.append_new(jobs.files(spark, f"{src}/c", SCHEMA), out, f"{ck}3", ["acc"]).awaitTermination()
    assert published.stored(spark, out).where("acc = 'A'").first().val == 5.0
    jobs.append_new(jobs.files(spark, f"{src}/c", SCHEMA), out, f"{ck}4", ["acc"], replace=True).awaitTermination()
    assert sorted((r.acc, r.val) for r in published.stored(spark, out).collect()) == [("A", 9.0), ("AR", 6.0), ("B", 7.0)]
    jobs.purge_covered(spark, out, d + dt.timedelta(days=1))
    assert [r.acc for r in published.stored(spark, out).collect()] == ["AR"]


def test_days_that_wait_for_their_index(spark):
    day = lambda n: dt.date(2024, 3, n)
    indexed = spark.createDataFrame([(day(n),) for n in (4, 5, 7, 12)], "d date")  # the 9th and 10th are a weekend
    run = lambda today: [r.d.day for r in jobs.pending_days(indexed, F.lit(day(1)), F.lit(day(today))).collect()]
    assert run(15) == [4, 5, 7, 12] and run(8) == [4, 5] and run(10) == [4, 5, 7] and run(4) == [4] and run(3) == []


def test_positions_announced_once(spark, tmp_path):
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    src, ck, seen, seeds = str(tmp_path / "in"), str(tmp_path / "ck"), [], []
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def run(name, rows):
        spark.createDataFrame(rows, "ticker string, day date").coalesce(1).write.parquet(f"{src}/{name}")
        stream = jobs.new_positions(jobs.files(spark, f"{src}/*", "ticker string, day date"), "ticker")
        jobs.announce(stream, ck, lambda df: seen.extend(map(tuple, df.collect())), lambda df: seeds.extend(map(tuple, df.collect()))).awaitTermination()

    run("1", [("A", day(0)), ("A", day(5))])
    assert seeds == [("A", day(0))] and not seen
    run("2", [("B", day(6)), ("A", day(60)), ("C", day(-100)), ("C", day(0))])
    assert sorted(seen) == [("B", day(6)), ("C", day(-100)), ("C", day(0))]
    run("3", [("B", day(20)), ("A", day(92))])
    assert sorted(seen)[0] == ("A", day(92)) and len(seen) == 4
    stream = jobs.new_positions(jobs.files(spark, f"{src}/*", "ticker string, day date"), "ticker")
    jobs.announce(stream, ck, lambda df: seen.extend(map(tuple, df.collect())), lambda df: seeds.extend(map(tuple, df.collect())), version=2).awaitTermination()
    assert len(seen) == 4 and len(seeds) > 4  # a new version remembers all and says nothing
    spark.createDataFrame([("N", day(200)), ("O", day(150))], "ticker string, day date").coalesce(1).write.parquet(f"{src}/4")
    stream = jobs.new_positions(jobs.files(spark, f"{src}/*", "ticker string, day date"), "ticker")
    jobs.announce(stream, ck, lambda df: seen.extend(map(tuple, df.collect())), version=2, today=F.lit(day(204))).awaitTermination()
    assert seen[4:] == [("N", day(200))]


def test_cards_and_live_changes(spark):
    few = spark.createDataFrame([("A", dt.date(2020, 1, 1))], "ticker string, first date")
    assert [tuple(r) for r in jobs.cards(few).collect()] == [("A", "New position: A 2020-01-01, enter by 2020-02-15")]
    many = spark.createDataFrame([(c, dt.date(2020, 1, 1)) for c in "EDCBA"], "ticker string, first date")
    assert [r.message for r in jobs.cards(many).collect()] == ["5 new positions", *(f"{c} · enter by 2020-02-15" for c in "ABCDE")]
    d = dt.date(2020, 1, 1)
    lots = spark.createDataFrame([(f"T{i:03d}", d, 60000.0 + i, -0.034 if i else -0.001, d if i == 1 else None) for i in range(120)], "ticker string, first date, val double, dd double, deadline date")
    lines = [r.message for r in jobs.cards(lots).collect()]
    assert len(lines) == 121 and lines[1] == "T000 · $60,000 · at its high of a year · enter by 2020-02-15" and lines[2] == "T001 · $60,001 · 3.4% below its high · enter by 2020-01-01"
    snap = spark.createDataFrame([("A", 10.0, 0.5, 4.0), ("B", 10.0, None, 5.0)], "symbol string, cur double, chg double, entry_px double")
    live = spark.createDataFrame([("A", 20.0), ("B", 10.0), ("Z", 1.0)], "symbol string, p double")
    assert {r.symbol: r.change for r in jobs.live_changes(snap, live).collect()} == {"A": 2.0, "B": 1.0}


def test_windowed_counts(spark, tmp_path):
    path = "/root/testdata/sf0.001/events.parquet"
    schema = spark.read.parquet(path).schema
    spark.read.parquet(path).write.parquet(f"{tmp_path}/e")
    stream = jobs.windowed_counts(spark.readStream.schema(schema).parquet(f"{tmp_path}/e"), "0 seconds")
    q = stream.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == spark.read.parquet(path).count()


def test_polling(spark, tmp_path):
    quotes, kept = spark.createDataFrame([("A", 1.0)], "symbol string, p double"), []
    q = jobs.poll(spark, lambda: quotes, lambda df: kept.append(df.count()), str(tmp_path / "ck"), 0.5)
    try:
        for _ in range(60):
            if kept:
                break
            q.awaitTermination(1)
    finally:
        q.stop()
    assert kept and set(kept) == {1}


def test_stale_days_are_read_again(spark, tmp_path):
    path, d = str(tmp_path / "live"), lambda n: dt.date(2024, 3, n)
    schema = "acc string, fdate date, tdate date, own double, own_d double, di string"
    old = [("a", d(4), d(1), 5.0, None, "D"), ("b", d(5), d(4), 5.0, 5.0, "D"), ("c", d(6), d(5), 5.0, None, "D"), ("i", d(6), d(5), 5.0, None, "I")]
    published.write_by_year(spark.createDataFrame(old, schema), path, ["acc"])
    indexed = spark.createDataFrame([(d(4), "p/a"), (d(5), "p/b"), (d(7), "p/z")], "day date, path string")  # the 6th can't be had again
    new = lambda q: q.select(F.substring("path", 3, 1).alias("acc"), F.col("day").alias("fdate"), F.lit(d(1)).alias("tdate"), F.lit(5.0).alias("own"), F.lit(4.0).alias("own_d"), F.lit("D").alias("di"))
    assert [r.path for r in jobs.replay(path, indexed, new, ["acc"]).collect()] == ["p/a"]
    rows = {r.acc: r.own_d for r in published.stored(spark, path).collect()}
    assert rows == {"a": 4.0, "b": 5.0, "c": None, "i": None}
    assert jobs.replay(path, indexed, new, ["acc"]) is None  # what is left is in no index
    assert jobs.replay(str(tmp_path / "none"), indexed, new, ["acc"]) is None
