import datetime as dt
import io
import os
import random
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyglass.sources import archive as A
from tallyglass.sources import filings as R
from tallyglass.streaming import jobs


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab\té\r", max_size=9), max_size=20), st.booleans(), st.integers(1, 40), st.integers(1, 9))
def test_each_line_is_in_one_range(lines, ended, size, block):
    data = ("\n".join(lines) + "\n" * ended).encode()
    want = [x.decode().replace("\r", "") for x in data.split(b"\n")]
    want = want[:-1] if data.endswith(b"\n") or not data else want
    found = []
    for at in range(0, len(data), size):
        for part in A.lines_of(io.BytesIO(data), at, min(len(data), at + size), block):
            found += part
    assert found == want


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=300), st.booleans(), st.lists(st.tuples(st.sampled_from(["seek", "read", "line"]), st.integers(0, 320)), max_size=12))
def test_members_are_files(data, packed, steps):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED if packed else zipfile.ZIP_STORED) as z:
        z.writestr("first", b"other" * 9)
        z.writestr("T", data)
    member, plain = A.Member(out, zipfile.ZipFile(out).getinfo("T")), io.BytesIO(data)
    for what, n in steps:
        if what == "seek":
            member.seek(min(n, len(data))), plain.seek(min(n, len(data)))
        else:
            assert (member.read(n), member.tell()) == (plain.read(n), plain.tell()) if what == "read" else (member.readline(), member.tell()) == (plain.readline(), plain.tell())


def made(path, tables, packed=True):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED if packed else zipfile.ZIP_STORED) as z:
        for n, t in tables.items():
            z.writestr(n, t)


@pytest.mark.parametrize("packed", [True, False])
def test_ranges_columns_and_predicates(spark, tmp_path, packed):
    r = random.Random(3)
    rows = [(f"A{i}", r.choice(["4", "4/A", "3", "5"]), "é" * r.randrange(4), str(i)) for i in range(3000)]
    text = "acc\tform\tnote\tn\r\n" + "".join("\t".join(x) + "\r\n" for x in rows) + "\n  \nshort\t4\n" + "last\t4\tno end\t7\textra"
    made(tmp_path / "a.zip", {"T.tsv": text, "other.tsv": "x\n1\n"}, packed)
    made(tmp_path / "b.zip", {"other.tsv": "x\n2"}, packed)
    made(tmp_path / "c.zip", {"T.tsv": "form\tacc\n4\tC1\n"}, packed)
    (tmp_path / "d.txt").write_text("no archive")
    df = A.zip_table(spark, str(tmp_path / "*.zip"), "T.tsv", ["acc", "form", "n", "absent"], 7000)
    assert df.rdd.getNumPartitions() > 5 and df.columns == ["acc", "form", "n", "absent"]
    want = [(a, f, n, "") for a, f, _, n in rows] + [("short", "4", "", ""), ("last", "4", "7", ""), ("C1", "4", "", "")]
    assert [tuple(x) for x in df.collect()] == want  # in order
    some = df.where(F.col("form").isin("4", "4/A") & (F.col("n") > "2")).select("acc")
    assert [x.acc for x in some.collect()] == [a for a, f, n, _ in want if f in ("4", "4/A") and n > "2"]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "form" not in plan.split("Filter", 1)[1].split("BatchScan")[0]  # tested by the reader
    assert [x.x for x in A.zip_table(spark, str(tmp_path), "other.tsv", ["x"]).collect()] == ["1", "2"]
    assert A.zip_table(spark, str(tmp_path / "a.zip"), "none.tsv", ["x"]).count() == 0
    assert A.zip_table(spark, str(tmp_path / "none*.zip"), "T.tsv", ["x"]).count() == 0


def test_quarters_do_not_depend_on_ranges(spark, tmp_path):
    from tests.test_filings import NOTES, OWN, SUB, TRANS

    made(tmp_path / "q.zip", {"SUBMISSION.tsv": SUB, "REPORTINGOWNER.tsv": OWN, "NONDERIV_TRANS.tsv": TRANS, "FOOTNOTES.tsv": NOTES})
    got = [[sorted(map(str, x.collect())) for x in R.read_quarters(spark, str(tmp_path), size)] for size in (1 << 20, 60)]
    assert got[0] == got[1] and len(got[0][0]) == 3 and len(got[0][1]) == 1


def days(spark, out):
    return sorted({x.day for x in spark.read.parquet(out).collect()}) if os.path.isdir(out) else []


def test_daily_tail_restarts_where_it_was(spark, tmp_path):
    """Runs on successive days read just the days of ``pending_days``: weekends, holidays, an index that is late."""
    line = "4           First Co            111   2020-02-05   edgar/{}.txt\n"
    put = lambda d: (tmp_path / "in" / str(d.year)).mkdir(parents=True, exist_ok=True) or (tmp_path / "in" / str(d.year) / d.strftime("form.%Y%m%d.idx")).write_text("Form Type\n8-K   x\n" + line.format(d) * 2)
    out, ck, first = str(tmp_path / "out"), str(tmp_path / "ck"), dt.date(2024, 2, 29)
    last, read = first - dt.timedelta(days=1), []

    def keep(df):
        df.write.mode("append").parquet(out)

    indexed = []
    plan = {dt.date(2024, 3, 1): [dt.date(2024, 2, 29)], dt.date(2024, 3, 5): [dt.date(2024, 3, 1), dt.date(2024, 3, 4)], dt.date(2024, 3, 8): [dt.date(2024, 3, 6)], dt.date(2024, 3, 9): [dt.date(2024, 3, 7)], dt.date(2024, 3, 15): [dt.date(2024, 3, 8), dt.date(2024, 3, 13), dt.date(2024, 3, 15)]}
    for today, new in plan.items():
        for d in new:
            put(d)
            indexed.append(d)
        known = spark.createDataFrame([(d,) for d in indexed], "d date")
        want = [r.d for r in jobs.pending_days(known, F.lit(last), F.lit(today)).collect()]
        jobs.follow(A.daily_tail(spark, str(tmp_path / "in"), str(first), str(today)), keep, ck).awaitTermination()
        read += want
        assert days(spark, out) == read
        last = max([last, *want])
    rows = spark.read.parquet(out).collect()
    assert len(rows) == len(read) == 7 and {(x.form, x.cik, x.path) for x in rows} == {("4", 111, f"edgar/{d}.txt") for d in read}
    jobs.follow(A.daily_tail(spark, str(tmp_path / "in"), str(first), "2024-03-15"), keep, ck).awaitTermination()
    assert spark.read.parquet(out).count() == 7


def test_ready_days():
    d = lambda n: dt.date(2024, 3, n)
    known, ready = {d(4), d(5)}, A.last_ready_day
    assert ready(known, d(1), d(5)) == d(5) and ready(known, d(1), d(6)) == d(5) and ready(known, d(1), d(7)) == d(5)
    assert ready(known | {d(7)}, d(1), d(7)) == d(5) and ready(known | {d(7)}, d(7), d(7)) == d(7)  # the 6th may still come, or is not asked for
    assert ready(known | {d(7), d(8)}, d(1), d(9)) == d(9) and ready(set(), d(1), d(10)) == d(7)  # the 8th may still come
    assert ready(known, d(9), d(5)) == d(8)  # nothing is asked for yet
