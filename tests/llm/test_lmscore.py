import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyglass.llm import lmscore as L


def slow_score(v, weights, token):
    """Sum over all segmentations, listed one by one."""
    text = "▁" + token

    def rest(i):
        if i == len(text):
            return 1.0
        total = 0.0
        for j in range(i + 1, len(text) + 1):
            n = v.number.get(text[i:j])
            if n is not None:
                total += weights[n] * rest(j)
            elif j == i + 1:
                total += math.prod(weights[v.bytes[b]] for b in text[i].encode()) * rest(j)
        return total

    return math.log(rest(0))


@pytest.mark.parametrize("token", ["a", "the", "nation", "über", "日x", "\U0001f600", "==>"])
def test_lattice_sums_all_segmentations(token):
    v = L.pieces()
    lattice = L.Lattice(v, v.start)
    assert lattice.score(token) == pytest.approx(slow_score(v, v.start, token), rel=1e-9)
    got, eps = [0.0] * v.size, 1e-5
    lattice.expect(token, 2.0, got)
    for i in np.flatnonzero(got)[:6]:  # an expected count is the derivative by the log weight
        up = v.start.copy()
        up[i] *= math.exp(eps)
        assert got[i] == pytest.approx(2 * (slow_score(v, up, token) - slow_score(v, v.start, token)) / eps, rel=1e-3, abs=1e-8)


def test_long_tokens_are_counted_alike():
    v = L.pieces()
    lattice = L.Lattice(v, v.start)
    for token in ("thenation" * 12, "日本é" * 5):
        got, edges = [0.0] * v.size, []
        lattice.expect(token, 3.0, got)
        text = "▁" + token
        for i in range(len(text)):
            for j in range(i + 1, len(text) + 1):
                n = v.number.get(text[i:j], -1)
                if n >= 0 or j == i + 1:
                    edges.append((i, j, n, v.start[n] if n >= 0 else 0.0))
        far = [0.0] * v.size
        for i, n, x in lattice._long_shares(len(text), 3.0, edges, text):
            for k in [n] if n >= 0 else [v.bytes[b] for b in text[i].encode()]:
                far[k] += x
        assert far == pytest.approx(got, rel=1e-9, abs=1e-12)
    lattice.expect("😀" * 5000, 1.0, got)
    assert np.isfinite(got).all()


def brute(docs):
    words = lambda t: [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
    c = Counter(x for i, t, out in docs if not out for x in [*words(t), ""])
    n, v = sum(c.values()), len(c)
    p = L.pieces()
    total = [0.0] * p.size
    start = L.Lattice(p, p.start)
    for t, k in c.items():
        start.expect(t, k, total)
    total = np.array(total) + p.start * L.PRIOR
    lattice = L.Lattice(p, total / total.sum())
    out = []
    for i, t, held in docs:
        own = [*words(t), ""]
        base = sum(math.log10((c[x] + 1) / (n + 1 * (v + 1))) for x in own)
        out.append((i, held, len(own), sum(c[x] > 0 for x in own), n, base, sum(lattice.score(x) for x in own) / math.log(10)))
    return out


def same(rows, want):
    rows, want = sorted(map(tuple, rows), key=str), sorted(want, key=str)
    assert [r[:5] for r in rows] == [w[:5] for w in want]
    for r, w in zip(rows, want):
        assert r[5:] == pytest.approx(w[5:], rel=1e-9)


@pytest.mark.parametrize("chunk_bytes", [60, 1 << 20])
def test_rows(spark, chunk_bytes):
    texts = [None, "", " \t", "One two\x0bTWO", "zz ÄÖ äö", "a\xa0b <unk> ▁x", "w" * 3000, "the the the", "x y " * 2000]
    docs = [(i if i != 4 else None, t, i % 3 == 1) for i, t in enumerate(texts)] + [(3, texts[3], False)] * 2
    df = spark.createDataFrame([(*d, 1, "q") for d in docs], "doc_id long, text string, held_out boolean, ix int, token string").repartition(3)
    same(L.score(df, chunk_bytes=chunk_bytes).collect(), brute(docs))
    assert L.score(df.limit(0)).count() == 0


def test_nothing_to_learn_from(spark):
    docs = [(1, "a b", True), (2, None, True)]
    same(L.score(spark.createDataFrame(docs, "doc_id long, text string, held_out boolean")).collect(), brute(docs))


def test_query(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    rows = L.op9_lmscore(spark, d).collect()
    same(rows, brute(docs))
    untrained = L.Lattice(L.pieces(), L.pieces().start)
    held = {r.doc_id: r.score for r in rows if r.held_out}
    start = sum(untrained.score(x.decode()) for i, t, out in docs if out for x in [*L.tokens(t), b""]) / math.log(10)
    assert sum(held.values()) > 0.8 * start > start
