import datetime as dt
import random

from pyspark.sql import functions as F

from tallyglass.operators.positions import positions
from tallyglass.plans.compute import snapshot
from tallyglass.streaming import jobs, state


def collect(stream, mode, kept, ck):
    def batch(df, n):
        kept.extend((n, *x) for x in df.collect())

    stream.writeStream.foreachBatch(batch).outputMode(mode).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()


def test_any_order_of_days_gives_the_positions_of_the_batch(spark, tmp_path):
    r = random.Random(5)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    rows = [(k, day(r.randrange(600))) for k in "ABCDE" for _ in range(r.randint(1, 25))] + [("F", day(0)), ("F", day(0)), (None, day(3)), ("G", None)]
    r.shuffle(rows)
    schema, changes = "ticker string, day date", []
    files = lambda: jobs.files(spark, str(tmp_path / "in/*"), schema, per_run=1)
    for i in range(0, len(rows), 12):
        spark.createDataFrame(rows[i : i + 12], schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
        if i in (24, 48):
            collect(state.position_changes(files(), "ticker"), "append", changes, str(tmp_path / "ck"))
    collect(state.position_changes(files(), "ticker"), "append", changes, str(tmp_path / "ck"))
    open_ = {}
    for _, k, first, n in changes:
        open_[k, first] = open_.get((k, first), 0) + n
        assert open_[k, first] in (0, 1)
    batch = positions(spark.createDataFrame(rows, schema).where("ticker is not null and day is not null"), "ticker", "day").collect()
    assert {x for x, n in open_.items() if n} == {(p.ticker, p["first"]) for p in batch}
    assert any(n < 0 for *_, n in changes)  # some had to be withdrawn


def test_cached_quotes_age_as_the_snapshot_says(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 2, 12, 0, 0)
    at = lambda s: t0 + dt.timedelta(seconds=s)
    answers = [
        [("A", at(0), 1.0, False), ("B", at(0), 2.0, False)],
        [("A", at(20), 1.5, None), ("C", at(25), 3.0, False)],
        [("A", at(10), 9.0, False), ("B", at(40), None, True), ("D", at(41), None, True)],  # an old answer; refusals
        [("E", at(700), 5.0, False)],
        [("Z", at(1830), 1.0, False)],
        [("Z", at(2600), 1.0, False), ("E", at(2500), None, False)],
    ]
    schema, kept, told = "symbol string, at timestamp, p double, refused boolean", [], {}
    for i, rows in enumerate(answers):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
        collect(state.quote_cache(jobs.files(spark, str(tmp_path / "in/*"), schema), fresh_seconds=30), "update", kept, str(tmp_path / "ck"))
        so_far = [x for part in answers[: i + 1] for x in part]
        now = max(x[1] for x in so_far)
        table = spark.createDataFrame([(n, s, a, p, w, c) for n, s, a, p, w, c in kept], "batch long, symbol string, at timestamp, p double, state string, cooling boolean")
        told = {x.symbol: x for x in state.latest(table).collect()}
        good = spark.createDataFrame([x[:3] for x in so_far if x[2] is not None], "symbol string, at timestamp, p double")
        for x in snapshot(good.limit(0), good, F.lit(now)).collect():
            mine = told[x.symbol]
            assert (mine.at, mine.p, mine.state) == (x.at, x.p, x.state), (i, x.symbol)
    assert [told[c].state for c in "ABCEZ"] == ["gone", "gone", "gone", "gone", "fresh"]
    assert {x[1] for x in kept if x[5]} == {"B", "D"} and not told["B"].cooling  # it was left alone, and then no more
    assert told["D"].at is None and told["D"].state == "gone"
    table = spark.createDataFrame([("A", "fresh", False), ("B", "stale", False), ("C", "stale", True)], "symbol string, state string, cooling boolean")
    assert sorted(x.symbol for x in state.to_ask(table, spark.createDataFrame([(c,) for c in "ABCDD"], "symbol string")).collect()) == ["B", "D"]


def test_a_dearer_source_is_fresh_for_longer(spark, tmp_path):
    at = lambda s: dt.datetime(2024, 1, 2) + dt.timedelta(seconds=s)
    schema, kept = "symbol string, at timestamp, p double, refused boolean, ttl long", []
    for i, rows in enumerate([[("A", at(0), 1.0, False, 300), ("B", at(0), 1.0, False, None)], [("Z", at(200), 1.0, False, None)], [("Z", at(301), 1.0, False, None)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
        collect(state.quote_cache(jobs.files(spark, str(tmp_path / "in/*"), schema)), "update", kept, str(tmp_path / "ck"))
    assert [x[4] for x in kept if x[1] == "A"] == ["fresh", "stale"] == [x[4] for x in kept if x[1] == "B"]
    last = {c: max(x[0] for x in kept if x[1] == c) for c in "AB"}
    assert last["A"] > last["B"]
