import random
import re
from collections import defaultdict

import pytest

from tallyglass.llm import mixing as M


def slow_seats(weights, seats):
    given = [0] * len(weights)
    for _ in range(seats if sum(weights) > 0 else 0):
        i = max(range(len(weights)), key=lambda i: (weights[i] / (2 * given[i] + 1), -i))
        given[i] += 1
    return given


def test_sainte_lague():
    r = random.Random(2)
    for _ in range(300):
        w = [r.choice([0, 1, 2, 5, r.random() * 100, 1000]) for _ in range(r.randint(1, 12))]
        n = r.randint(0, 200)
        assert M.sainte_lague(w, n) == slow_seats(w, n)
    big = M.sainte_lague([5.0, 2.0, 1.0], 10**15)
    assert sum(big) == 10**15


def test_targets():
    assert M.targets([100, 100, 100], (5, 2, 1)) == [187.5, 75, 37.5]
    out = M.targets([10, 100, 100], (5, 2, 1))
    assert out == [30, 120, 60]
    assert M.targets([0, 0], (5, 2)) == [0, 0] and M.targets([], ()) == []
    chain = M.targets([10, 20, 1000], (5, 5, 1))
    assert chain[:2] == [30, 60] and sum(chain) == pytest.approx(1030)


def verify(rows, docs):
    """rows of the result against (doc_id, text, source) rows."""
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    of = defaultdict(int)
    for _, t, s in docs:
        of[s] += size(t)
    names = sorted(of, key=lambda s: (s is None, s or ""))
    goal = dict(zip(names, M.targets([of[s] for s in names], [M.WEIGHTS[i % 3] for i in range(len(names))])))
    want = sorted(((i, size(t), of[s], goal[s]) for i, t, s in docs), key=str)
    assert sorted(((r.doc_id, r.size, r.source_size, r.target) for r in rows), key=str) == want
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    got = defaultdict(int)
    for r in rows:
        got[r.source_size, r.target] += r.taken
    expected = defaultdict(float)
    for s in names:
        expected[of[s], goal[s]] += goal[s]
    for k, x in expected.items():
        assert abs(got[k] - x) <= max(70, 0.005 * x), (k, got[k], x)


def test_edge_rows(spark):
    texts = [None, "", "a", "a b\tc\x0bd", "  ", "w " * 20_000, "é\xa0é x"]
    docs = [(i if i % 9 else None, texts[i % 7], [None, "", "b", "B", "é"][i % 5]) for i in range(200)] + [(3, "a b\tc\x0bd", "B")] * 5
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, source string, size int, target int")
    out = M.mix(df).collect()
    verify(out, docs)
    again = M.mix(df.repartition(7, "text")).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, out), key=str)
    assert M.mix(df.limit(0)).count() == 0


def test_mixed_rows_hold_the_words(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    taken = {r.doc_id: r.taken for r in M.mix(docs).collect()}
    got = defaultdict(int)
    rows = M.mixed(docs).collect()
    assert M.mixed(docs).columns == docs.columns
    for r in rows:
        got[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert {i: n for i, n in taken.items() if n} == got


def test_query(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    verify(M.op8_mixing(spark, d).collect(), docs)


def slow_takes(docs, seed=M.SEED):
    """``taken`` row for row by plain loops: quotas by single highest quotients, then documents of a shard in their drawn order."""
    total = sum(d["size"] for d in docs)
    names = sorted({d["source"] for d in docs}, key=lambda s: (s is None, s or ""))
    sizes = [sum(d["size"] for d in docs if d["source"] == s) for s in names]
    goal = M.targets(sizes, [M.WEIGHTS[i % 3] for i in range(len(names))])
    block = max(1, min(M.MOST_BLOCK, total // M.LEAST_BLOCKS))
    out = {}
    for s, size, t, blocks in zip(names, sizes, goal, slow_seats(goal, round(total / block))):
        own = [d for d in docs if d["source"] == s]
        cells = max(1, -(-size // (M.SHARDS * M.CELL_WORDS)), -(-len(own) // (M.SHARDS * M.CELL_ROWS)))
        shards = sorted({d["h"] % M.SHARDS for d in own})
        words = [sum(d["size"] for d in own if d["h"] % M.SHARDS == k) for k in shards]
        for k, n, seats in zip(shards, words, slow_seats(words, blocks)):
            quota = 3 * n if t >= 3 * size else min(seats * block, 3 * n)
            times, rest = divmod(quota, n) if n else (0, 0)
            for d in sorted((d for d in own if d["h"] % M.SHARDS == k), key=lambda d: ((d["h"] >> 16) % cells, d["h"], d["doc_id"])):
                part = min(d["size"], rest)
                rest -= part
                out[d["doc_id"]] = times * d["size"] + part
    return out


def test_taken_row_for_row(spark):
    r = random.Random(8)
    rows = [(i, "w " * r.choice([0, 1, 5, 30, 200]), r.choice(["a", "b", "b", "b", "c", None])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = [x.asDict() for x in M._measured(df, M.SEED).collect()]
    assert {x.doc_id: x.taken for x in M.mix(df).collect()} == slow_takes(docs)


def test_many_sources_give_the_same_as_few(spark):
    r = random.Random(9)
    rows = [(i, "w " * r.choice([0, 1, 3, 10, 100]), None if i % 50 == 0 else f"s{r.randint(0, 150) ** 2 // 150:03d}") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    few, many = (sorted(map(tuple, M.mix(df, most_listed=n).collect())) for n in (10_000, 0))
    assert [x[:3] + x[4:] for x in few] == [x[:3] + x[4:] for x in many]
    assert [x[3] for x in few] == pytest.approx([x[3] for x in many])


def test_seats_of_equal_sources(spark):
    for weights, seats in (([5.0] * 40, 17), ([5.0] * 40, 57), ([1.0, 2.0, 3.0, 0.0, 1.0], 9), ([0.0, 0.0], 3), ([7.0], 10**6)):
        df = spark.createDataFrame(list(enumerate(weights)), "sx long, target double")
        assert [x.blocks for x in M._spread_seats(df, seats).orderBy("sx").collect()] == M.sainte_lague(weights, seats)


def test_source_of_empty_texts(spark):
    rows = [(i, "", "a") for i in range(5000)] + [(9000, "x y", "b"), (9001, None, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {x.doc_id: x for x in M.mix(df).collect()}
    assert len(out) == 5002 and out[9000].taken == 2 and out[0].taken == 0 and out[9000].target == 2.0


def test_mixed_edges(spark):
    rows = [(1, "a b c", "s", 5, "q", 1), (2, None, "s", None, "q", 2), (3, "", None, 0, "q", 3), (None, "x\ty", None, 3, "q", 4), (1, "a b c", "s", 5, "q", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, h string, taken int").withColumnRenamed("h", "__h")
    out = M.mixed(df)
    assert out.columns == df.columns and {r["__h"] for r in out.collect()} == {"q"} and {r.doc_id for r in out.collect()} == {1, None}
    assert M.mixed(df.limit(0)).count() == 0
    assert M.mixed(df.select("doc_id", "text", "source")).columns == ["doc_id", "text", "source"]
