import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tallyglass.llm import simhash as S


def slow_fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) > len(h) / 2)


def components(fps):
    names = sorted(set(fps))
    root = {x: x for x in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    groups = {}
    for x in names:
        groups.setdefault(find(x), set()).add(x)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "one TWO", "a b a b a b", "Ünï ÇÖDE über alle Maßen", "x y z w q", "w " * 70000])
def test_fingerprint(text):
    assert S.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("max_local", [3, 2000])
def test_links_have_the_components_of_all_pairs(spark, max_local):
    r = random.Random(7)
    fps = {0, 1, 7, 15, 2**64 - 1}
    for _ in range(25):
        x = r.getrandbits(64)
        for _ in range(12):
            fps.add(x)
            for _ in range(r.randint(1, 4)):
                x ^= 1 << r.randrange(64)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    edges = S.links(spark.createDataFrame(signed, "fp long"), max_local).collect()
    assert all(((e.a ^ e.b) & (2**64 - 1)).bit_count() <= 3 for e in edges)
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for e in edges:
        root[find(e.a % 2**64)] = find(e.b % 2**64)
    found = {}
    for x in fps:
        found.setdefault(find(x), set()).add(x)
    assert {frozenset(g) for g in found.values()} == components(fps)


def test_rows_kept_and_named(spark):
    rows = [(5, "a b c d"), (2, "A b c D"), (2, "a b c d"), (None, "a b c d"), (9, None), (7, ""), (None, "zz yy xx ww vv")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    out = sorted(map(tuple, S.near_duplicates(docs).select("doc_id", "component_id").collect()), key=str)
    assert out == sorted([(5, 2), (2, 2), (2, 2), (None, 2), (9, 7), (7, 7), (None, None)], key=str)
    assert S.near_duplicates(docs.limit(0)).count() == 0
    stay = S.representatives(docs).collect()
    assert S.representatives(docs).columns == docs.columns and S.representatives(docs.limit(0)).count() == 0
    assert sorted((r.doc_id is None, r.doc_id or 0, (r.text or "").lower()) for r in stay) == [(False, 2, "a b c d"), (False, 7, ""), (True, 0, "zz yy xx ww vv")]
    same = S.representatives(docs.where("doc_id = 5").union(docs.where("doc_id = 5"))).collect()
    assert [tuple(r) for r in same] == [(5, "a b c d", "x")]


def test_query(spark):
    out = S.op1_simhash(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    fps = {r.doc_id: int(r.fingerprint, 16) for r in out}
    assert len(out) == len(texts) and all(fps[i] == slow_fingerprint(t) for i, t in texts.items())
    groups = components(fps.values())
    least = {f: min(i for i, x in fps.items() if x in g) for g in groups for f in g}
    assert all(r.component_id == least[fps[r.doc_id]] for r in out)


def test_representatives_keep_clashing_columns(spark):
    rows = [(3, "a b c d", "x", 1, 5), (1, "A b c d", "y", 2, 6), (1, "A b c d", "y", 2, 6), (None, "q r s t", "z", 3, 7), (9, None, "n", 4, 8), (8, "", "m", 5, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, t string, root int, n int").withColumn("__id", F.col("n")).withColumn("id", F.lit("own")).withColumn("a.b", F.lit(0))
    out = S.representatives(df)
    assert out.columns == df.columns
    assert sorted((tuple(r)[:5] for r in out.collect()), key=str) == sorted([(1, "A b c d", "y", 2, 6), (None, "q r s t", "z", 3, 7), (8, "", "m", 5, 9)], key=str)
    assert S.representatives(df.limit(0)).count() == 0


def test_first_rows_do_not_depend_on_order(spark):
    """Rows equal in id and text: the one that stays is the same whatever the order and the columns' kinds."""
    rows = [(1, "same text here", None, {"k": 2}), (1, "same text here", "b", {"k": 1}), (1, "same text here", "a", {"k": 3}), (2, "same text here", "a", {"k": 0})]
    schema = "doc_id long, text string, source string, more map<string,int>"
    found = {str(S.representatives(spark.createDataFrame(r, schema).repartition(n)).collect()) for r in (rows, rows[::-1]) for n in (1, 3)}
    assert len(found) == 1 and "doc_id=1" in found.pop()
