import hashlib
import random
import zlib

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyglass.llm import periodic as P

D = "/root/testdata/sf0.001"


def slow_runs(words, least=12):
    """All runs by trying each period on each stretch."""
    n, found = len(words), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i >= p and j - i + p >= least:
                found.append((i, j - i + p, p))
            i = j + 1
    smallest = lambda s, m: next(p for p in range(1, m + 1) if all(words[x] == words[x + p] for x in range(s, s + m - p)))
    return sorted(x for x in found if smallest(x[0], x[1]) == x[2])


def slow_row(doc, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = slow_runs(words)
    gone = {i for s, m, p in found for i in range(s + p, s + m)}
    top = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    lines = "".join(f"{s},{m},{p}\n" for s, m, p in found).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc, len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2], sha(lines), sha(kept))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70), st.sampled_from([2, 5, 12]))
def test_runs_of_few_letters(words, least):
    assert P.runs(words, least) == slow_runs(words, least)
    texts = [[b"%d" % w for w in words], [], [b"x"] * 30]
    assert P.runs_of_texts(texts, least) == [slow_runs(words, least), [], [(0, 30, 1)]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(1, 40), st.integers(0, 3)), max_size=5), st.randoms(use_true_random=False))
def test_runs_of_powers(parts, r):
    """Repeated roots, repeats of repeats, words between them."""
    words = []
    for p, n, alone in parts:
        root = [r.randrange(4) for _ in range(p)]
        words += (root * n)[: r.randint(1, p * n)] + [100 + r.randrange(1000) for _ in range(alone)]
    words = words + words if len(words) < 60 else words
    assert P.runs(words) == slow_runs(words)
    assert P.runs_of_texts([[b"%d" % w for w in words]] * 2) == [slow_runs(words)] * 2


def test_places_keep_their_order():
    r = random.Random(1)
    members = r.sample(range(10**6), 5000)
    places = P.Places(members[0])
    for x in members[1:]:
        places.add(x)
    want = sorted(members)
    assert list(places) == want and places.size == 5000 and len(places.blocks) > 3
    at = r.sample(range(1, 4999), 200)
    assert all(places.neighbours(want[i]) == (want[i - 1], want[i + 1]) for i in at)
    assert places.neighbours(want[0]) == (None, want[1]) and places.neighbours(want[-1]) == (want[-2], None)


def test_long_periodic_texts():
    assert P.runs([0] * 60_000) == [(0, 60_000, 1)]
    root = [f"w{i}" for i in range(9000)]
    assert P.runs(root * 3 + ["end"]) == [(0, 27_000, 9000)]


def test_rows_against_brute_force(spark):
    r = random.Random(4)
    line = "All rights are reserved by the holder of this text"
    texts = [None, "", " \n ", "one", "a " * 11, "a " * 12, "a\tb\x0bc\x0cd\re\nf " * 3, "  x" * 20, (line + "\n") * 5, f"{line} {line} and {line} {line}", "é è " * 9]
    texts += [" ".join(r.choice("ab") for _ in range(r.randint(0, 150))) for _ in range(150)]
    rows = [(i, t, "own") for i, t in enumerate(texts)] + [(None, texts[9], "own"), (8, texts[8], "own"), (8, "x y " * 9, "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    out = P.periodic_runs(docs)
    assert out.columns == ["doc_id", "runs", "text"]
    found = sorted(((x.doc_id, [tuple(y) for y in x.runs], x.text) for x in out.collect()), key=str)
    want = []
    for i, t, _ in rows:
        words = (t or "").encode().split()
        all_ = slow_runs(words)
        gone = {j for s, m, p in all_ for j in range(s + p, s + m)}
        want.append((i, all_, b" ".join(w for j, w in enumerate(words) if j not in gone).decode()))
    assert found == sorted(want, key=str) and sum(len(x[1]) for x in found) > 20
    assert P.periodic_runs(docs.limit(0)).count() == 0 and P.planted(docs.limit(0)).count() == 0


def test_query_against_brute_force_and_sql(spark):
    rows = sorted(map(tuple, P.op11_periodic(spark, D).collect()))
    documents = spark.read.parquet(f"{D}/documents.parquet").collect()
    assert rows == sorted(slow_row(d.doc_id, d.text) for d in documents) and any(x[1] for x in rows)
    c = duckdb.connect()
    c.sql(f"create view documents as from '{D}/documents.parquet'")
    want = c.sql(P.ORACLE)
    assert want.columns == P.op11_periodic(spark, D).columns and rows == sorted(want.fetchall())
