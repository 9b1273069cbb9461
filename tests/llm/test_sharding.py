import zlib
from collections import Counter, defaultdict

import pytest

from tallyglass.llm import sharding as S


def verify(rows, docs, shards):
    want = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=str) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert set(slots) <= set(range(shards)) and max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert {(r.law, r.grown_shard) for r in rows} <= {("rows", None)}


def spread(rows):
    """Shards over which groups of equal texts lie, and rows outside their group's largest part."""
    groups = defaultdict(Counter)
    for r in rows:
        groups[r.text_crc32, r.size][r.shard] += 1
    return sum(sum(c.values()) - max(c.values()) for c in groups.values())


@pytest.mark.parametrize("hot", [0, 150])
def test_rows(spark, hot):
    docs = [(i if i % 11 else None, f"text {i // 3}" if i < 200 else f"own {i}") for i in range(400)]
    docs += [(1000 + i, "hot") for i in range(hot)] + [(5, None), (6, ""), (7, "")] + [(9, "again")] * 4
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, shard int, node int")
    out = S.shard(df, shards=8).collect()
    verify(out, docs, 8)
    split = spread(out)
    assert split <= 30 + max(0, hot - len(docs) // 8)


def test_few_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    verify(S.shard(df).collect(), [(1, "a"), (2, "a"), (3, "b")], 40)
    assert S.shard(df.limit(0)).count() == 0
    same = [(i, "x") for i in range(50)]
    verify(S.shard(spark.createDataFrame(same, "doc_id long, text string"), shards=4).collect(), same, 4)


def test_propagate_on_a_general_graph(spark):
    edges = [(k * 10 + i, k * 10 + j) for k in range(20) for i in range(10) for j in range(i)]
    nodes = spark.createDataFrame([(n, n * 7 % 4) for n in range(200)], "node long, label int")
    out = S.propagate(nodes, spark.createDataFrame(edges, "a long, b long"), {s: 60 for s in range(4)}, rounds=9)
    label = {r.node: r.label for r in out.collect()}
    assert len(label) == 200 and max(Counter(label.values()).values()) <= 75
    assert sum(label[a] != label[b] for a, b in edges) < 0.25 * len(edges)


def test_query(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    out = S.op10_sharding(spark, d).collect()
    verify(out, docs, 40)
    assert spread(out) <= 0.2 * sum(n for n in Counter(t for _, t in docs).values() if n > 1)
