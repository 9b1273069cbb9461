import duckdb
import numpy as np
import pytest

from tallyglass.llm import topk as K


def brute(rows, every=50, k=5):
    known = [(i, [int(np.floor(256 * float(x))) for x in np.array(v, np.float32)]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(known):
        if i % every == 0:
            best = sorted((-sum(x * y for x, y in zip(q, w)), j) for b, (j, w) in enumerate(known) if a != b and len(w) == len(q))
            out += [(i, n + 1, j, min(max(-s, -(2**63)), 2**63 - 1)) for n, (s, j) in enumerate(best[:k])]
    return sorted(out)


@pytest.mark.parametrize("rows, block", [(5, 2), (40, 3), (8192, 16_384)])
def test_against_brute_force(spark, rows, block):
    r = np.random.default_rng(1)
    data = [(int(i), [float(x) for x in r.integers(-3, 4, 6) / 8]) for i in range(300)]
    data += [(300, None), (350, [None] * 6), (400, [float("nan")] * 6), (450, [float("inf")] * 6), (None, [1.0] * 6), (7, [9.0] * 6)]
    data += [(50, [0.5, 0.25]), (51, [0.5, 0.5]), (100, []), (150, []), (500, [1e30] * 3), (501, [1e30] * 3), (550, [2.0**30] * 3), (551, [-(2.0**29)] * 3)]
    data += [data[3], data[0], data[0]]  # repeated rows are candidates for each other, and queries each
    df = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id long, embedding array<float>, rank int")
    found = sorted(map(tuple, K.top_k(df, shard_rows=rows, block_queries=block).collect()))
    big = [x for x in found if x[0] in (500,)]
    assert [x for x in found if x not in big] == [x for x in brute(data) if x[0] != 500]
    assert big[0][2:] == (501, 2**63 - 1)
    assert K.top_k(df.limit(0)).count() == 0


def test_clustered_and_equal_vectors(spark):
    """A third of the rows are one vector; the others lie in far clusters, so most shards are never asked."""
    r = np.random.default_rng(2)
    centres = r.normal(0, 4, (8, 6))
    data = [(int(i), [float(x) for x in centres[i % 8] + r.normal(0, 0.1, 6)]) for i in range(400)] + [(int(i), [1.0] * 6) for i in range(400, 600)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, K.top_k(df, every=7, shard_rows=40).collect())) == brute(data, 7)


def test_scores_beyond_doubles(spark):
    """Scores of 2^52 to 2^62, one apart, in the type for them: best rows are not lost by rounding."""
    big = 2.0**22 / 256
    data = [(50, [big, 1 / 256]), (3, [2.0**38 / 256, 0.0]), (1, [2.0**38 / 256, 2 / 256]), (2, [2.0**38 / 256, 1 / 256]), (9, [2.0**38 / 256, 3 / 256])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    for rows in (2, 8192):
        assert [tuple(x) for x in K.top_k(df, k=2, shard_rows=rows).orderBy("rank").collect()] == [(50, 1, 9, 2**60 + 3), (50, 2, 1, 2**60 + 2)]
    r = np.random.default_rng(9)
    for bits in (25, 27, 28, 30):  # components of so many bits: floats, longs, then Python's integers
        data = [(int(i), [float(x) for x in r.integers(-(2**bits), 2**bits, 8) / 256]) for i in range(150)]
        data += [(200 + i, [x + (i % 2) / 256 for x in data[0][1]]) for i in range(12)]
        found = sorted(map(tuple, K.top_k(spark.createDataFrame(data, "vec_id long, embedding array<double>"), every=10, shard_rows=30).collect()))
        known = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in data]
        want = []
        for i, q in known:
            if i % 10 == 0:
                best = sorted((-sum(x * y for x, y in zip(q, w)), j) for j, w in known if j != i)[:5]
                want += [(i, n + 1, j, min(max(-s, -(2**63)), 2**63 - 1)) for n, (s, j) in enumerate(best)]
        assert found == sorted(want), bits


def test_tree_bounds_prune():
    r = np.random.default_rng(3)
    v = np.concatenate([r.normal(c, 0.1, (200, 4)) for c in (-9, 0, 9)])
    tree = K.Tree(v, 20)
    q = r.normal(0, 1, (30, 4))
    score = q @ v.T
    kth = np.sort(score, axis=1)[:, -5]
    bound = tree.bounds(q, kth, -np.inf)
    assert (bound > -np.inf).mean() < 0.5 and sorted(np.concatenate([tree.rows[n] for n in tree.leaves]).tolist()) == list(range(600))
    for i in range(30):
        for j, leaf in enumerate(tree.leaves):
            best = score[i, tree.rows[leaf]].max()
            assert best <= bound[i, j] + 1e-9 if bound[i, j] > -np.inf else best < kth[i]
    assert all((tree.low[n] <= v[tree.rows[n]]).all() and (v[tree.rows[n]] <= tree.high[n]).all() for n in range(len(tree.rows)))


def test_query_equals_its_sql(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view embeddings as from '{d}/embeddings.parquet'")
    assert sorted(map(tuple, K.op2_topk(spark, d).collect())) == sorted(con.sql(K.ORACLE).fetchall())
