"""Exact top-k inner-product search with KD-trees per shard.

The top of the tree is fitted on a bounded sample: median splits of the widest
dimension deal the vectors to *cells*, so that a cell's vectors lie together.
Every vector is then placed, and the tight bounding box of each cell is taken
from all its vectors. A cell of more rows than a shard may hold is dealt to
several shards by a hash; they share its box.

A query first searches a shard of the cell with the best bound. The k-th score
found there travels with it: it is then sent only to those other shards whose
box can reach that score, and only scores that reach it come back.

A task holds one shard and a block of queries. It builds a KD-tree (median
splits of the widest dimension down to leaves, a tight box for every node),
descends from the root with all queries at once, dropping a query from a branch
whose box cannot reach its k-th score, and visits the leaves that are left best
first. A query stops when the next bound is below its k-th score (an equal bound
may still hold a tie with a smaller id).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.storage import cut

SHARD_ROWS, BLOCK_QUERIES, LEAF_ROWS, TOGETHER = 8192, 16_384, 128, 1024
#: The cells' tree is fitted on about CELL_SAMPLE rows for each of at most MOST_CELLS cells.
MOST_CELLS, CELL_SAMPLE = 4096, 32
_LEAST, _MOST = -(2**63), 2**63 - 1
#: Below any score, by the type that scores are exact in (see ``_number_type``); its negative is one of that type too.
_NONE = {np.float64: -np.inf, np.int64: -(2**62), object: -(2**200)}


def quantise(column: str = "embedding"):
    """``floor(256 * x)`` of every component as a long; null where a component is null or not finite.

    Values beyond 9.2e18 either way become that.
    """
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    scaled = F.transform(column, lambda x: F.floor(F.least(F.greatest(x.cast("double") * 256, F.lit(-9.2e18)), F.lit(9.2e18))).cast("long"))
    return F.when(F.coalesce(bad, F.lit(False)), F.lit(None)).otherwise(scaled)


def _number_type(a: np.ndarray, b: np.ndarray):
    """A type in which inner products of rows of ``a`` and ``b`` are exact."""
    if not a.size or not b.size:
        return np.float64
    most = max(abs(int(a.min())), int(a.max())) * max(abs(int(b.min())), int(b.max())) * a.shape[1]
    return np.float64 if most < 2**52 else np.int64 if most < 2**62 else object


def _bound(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The best score that a vector in the box can have for each query; boxes may be rows."""
    zero = np.zeros((), queries.dtype)
    return np.maximum(queries, zero) @ high.T + np.minimum(queries, zero) @ low.T


def _halves(vectors: np.ndarray) -> tuple[int, np.ndarray]:
    """The widest dimension, and the rows with their lower half by it first."""
    axis = int(np.argmax(vectors.max(0) - vectors.min(0)))
    return axis, np.argpartition(vectors[:, axis], len(vectors) // 2)


class Tree:
    """A KD-tree: of each node its box and children, or the rows of a leaf."""

    def __init__(self, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray] = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        todo = [self._node(vectors, np.arange(len(vectors)))]
        while todo:
            node = todo.pop()
            rows = self.rows[node]
            if len(rows) > leaf_rows and vectors.shape[1]:
                _, order = _halves(vectors[rows])
                half = len(rows) // 2
                self.children[node] = self._node(vectors, rows[order[:half]]), self._node(vectors, rows[order[half:]])
                todo += self.children[node]
        self.leaves = [n for n, c in enumerate(self.children) if c is None]

    def _node(self, vectors: np.ndarray, rows: np.ndarray) -> int:
        own = vectors[rows]
        self.children.append(None)
        self.rows.append(rows)
        self.low.append(own.min(0))
        self.high.append(own.max(0))
        return len(self.rows) - 1

    def nearest_leaves(self, queries: np.ndarray) -> np.ndarray:
        """The leaf that each query comes to by always taking the child with the better bound."""
        at, todo = np.zeros(len(queries), np.int64), [(0, np.arange(len(queries)))]
        while todo:
            node, rows = todo.pop()
            if self.children[node] is None:
                at[rows] = node
                continue
            left, right = self.children[node]
            better = _bound(queries[rows], self.low[left], self.high[left]) >= _bound(queries[rows], self.low[right], self.high[right])
            todo += [(child, own) for child, own in ((left, rows[better]), (right, rows[~better])) if len(own)]
        return at

    def bounds(self, queries: np.ndarray, worst: np.ndarray, none) -> np.ndarray:
        """Bounds of the leaves (columns as in ``leaves``) for each query, ``none`` where a box above cannot reach ``worst``."""
        out = np.full((len(queries), len(self.leaves)), none, worst.dtype)
        place = {n: i for i, n in enumerate(self.leaves)}
        todo = [(0, np.arange(len(queries)))]
        while todo:
            node, rows = todo.pop()
            found = _bound(queries[rows], self.low[node], self.high[node])
            reach = found >= worst[rows]
            rows = rows[reach]
            if not len(rows):
                continue
            if self.children[node] is None:
                out[rows, place[node]] = found[reach]
            else:
                todo += [(child, rows) for child in self.children[node]]
        return out


def _floors(floors, kind) -> np.ndarray:
    """Scores to be reached, in the type of the scores."""
    return np.array([_NONE[kind] if x is None else x for x in floors], kind)


def search(ids, keys, vectors, query_keys, queries, floor, k: int, leaf_rows: int = LEAF_ROWS):
    """The ``k`` best of ``vectors`` for each of ``queries``: ``(query row, id, score)`` arrays.

    ``floor`` is a score that a query's k-th result is known to reach (None: no
    such); nothing below it is given out. The row with the query's own key is no
    candidate.
    """
    kind = _number_type(vectors, queries)
    vectors, queries = vectors.astype(kind), queries.astype(kind)
    none = _NONE[kind]
    floor = _floors(floor, kind)
    tree, out = Tree(vectors, leaf_rows), []
    for at in range(0, len(queries), TOGETHER):
        own = slice(at, at + TOGETHER)
        q, found, score = _search_part(tree, ids, keys, vectors, query_keys[own], queries[own], floor[own], k, none)
        out.append((q + at, found, score))
    q, found, score = (np.concatenate(x) for x in zip(*out))
    return q, found, [min(max(int(x), _LEAST), _MOST) for x in score]


def _search_part(tree: Tree, ids, keys, vectors, query_keys, queries, floor, k: int, none):
    def scores(rows: np.ndarray, members: np.ndarray) -> np.ndarray:
        found = queries[rows] @ vectors[members].T
        return np.where(keys[members][None, :] == query_keys[rows][:, None], none, found)

    def by_leaf(rows: np.ndarray, leaf: np.ndarray):
        order = np.argsort(leaf, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(leaf[order])) + 1):
            yield rows[own], tree.rows[leaf[own[0]]]

    n = len(queries)
    worst = floor.copy()
    for rows, members in by_leaf(np.arange(n), tree.nearest_leaves(queries)):
        if len(members) > k:  # with a query's own row left out still k
            kth = np.sort(scores(rows, members), axis=1)[:, -k]
            worst[rows] = np.maximum(worst[rows], kth)
    bound = tree.bounds(queries, worst, none)
    order = np.argsort(bound, axis=1, kind="stable")[:, ::-1]
    best_score, best_id = np.full((n, k), none, worst.dtype), np.full((n, k), _MOST)
    rows, leaves = np.arange(n), np.array(tree.leaves)
    for step in range(len(leaves)):
        leaf = order[rows, step]
        reach = bound[rows, leaf]
        alive = (reach >= np.maximum(worst, best_score[:, -1])[rows]) & (reach != none)
        rows, leaf = rows[alive], leaf[alive]  # bounds only fall from here on
        if not len(rows):
            break
        for at, members in by_leaf(rows, leaves[leaf]):
            score = scores(at, members)
            all_score = np.concatenate([best_score[at], score], axis=1)
            all_id = np.concatenate([best_id[at], np.broadcast_to(ids[members], score.shape)], axis=1)
            if vectors.dtype != object and all_score.shape[1] > 4 * k:  # ties at the k-th place all stay in play
                kth = -np.partition(-all_score, k - 1, axis=1)[:, k - 1 : k]
                keep = (all_score >= kth).sum(1).max()
                part = np.argpartition(-all_score, keep - 1, axis=1)[:, :keep]
                all_score, all_id = np.take_along_axis(all_score, part, 1), np.take_along_axis(all_id, part, 1)
            rank = np.lexsort((all_id, -all_score), axis=1)[:, :k]
            best_score[at], best_id[at] = np.take_along_axis(all_score, rank, 1), np.take_along_axis(all_id, rank, 1)
    q, j = np.nonzero((best_score != none) & (best_score >= floor[:, None]))
    return q, best_id[q, j], best_score[q, j]


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


class Cells:
    """The top of the tree: a complete binary tree of splits over the leading components."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.depth, self.width = max(0, cells - 1).bit_length(), sample.shape[1]
        self.axis, self.edge = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf)
        todo = [(0, sample)]
        while todo and self.depth and self.width:
            node, own = todo.pop()
            if node >= len(self.axis) or len(own) < 2:
                continue
            axis, order = _halves(own)
            edge = own[order[len(own) // 2], axis]
            self.axis[node], self.edge[node] = axis, edge
            up = own[:, axis] >= edge
            todo += [(2 * node + 1, own[~up]), (2 * node + 2, own[up])]

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """The cell of each vector; components beyond the tree's are ignored, missing ones are 0."""
        own = np.zeros((len(vectors), max(1, self.width)))
        n = min(self.width, vectors.shape[1])
        own[:, :n] = vectors[:, :n]
        at, rows = np.zeros(len(own), np.int64), np.arange(len(own))
        for _ in range(self.depth):
            at = 2 * at + 1 + (own[rows, self.axis[at]] >= self.edge[at])
        return at - len(self.axis)


def _place(cells: Cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(3).to_numpy()
            found = np.zeros(len(dims), np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                found[at] = cells.place(_matrix(batch.column(2).take(pa.array(at)), dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, "cell"])

    return run


_BOX = "dim int, cell long, n long, low array<long>, high array<long>"


def _box_table(boxes: dict) -> pa.Table:
    keys = list(boxes)
    lists = lambda i: pa.array([boxes[x][i].tolist() for x in keys], pa.list_(pa.int64()))
    return pa.table(
        [pa.array([x[0] for x in keys], pa.int32()), pa.array([x[1] for x in keys], pa.int64()), pa.array([boxes[x][0] for x in keys], pa.int64()), lists(1), lists(2)],
        names=["dim", "cell", "n", "low", "high"],
    )


def _merge(boxes: dict, key: tuple, n: int, low: np.ndarray, high: np.ndarray) -> None:
    if key in boxes:
        n, low, high = n + boxes[key][0], np.minimum(low, boxes[key][1]), np.maximum(high, boxes[key][2])
    boxes[key] = n, low, high


def _partial_boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each cell that a task meets."""
    boxes: dict = {}
    for batch in batches:
        dims, cell = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        order = np.lexsort((cell, dims))
        for at in np.split(order, np.flatnonzero((np.diff(dims[order]) != 0) | (np.diff(cell[order]) != 0)) + 1):
            if len(at):
                own = _matrix(batch.column(2).take(pa.array(at)), int(dims[at[0]]))
                _merge(boxes, (int(dims[at[0]]), int(cell[at[0]])), len(at), own.min(0), own.max(0))
    yield from _box_table(boxes).to_batches()


def _whole_boxes(part: pa.Table) -> pa.Table:
    boxes: dict = {}
    for dim, cell, n, low, high in zip(*(part[c].to_pylist() for c in ("dim", "cell", "n", "low", "high"))):
        _merge(boxes, (dim, cell), n, np.array(low, np.int64), np.array(high, np.int64))
    return _box_table(boxes)


def _route(first: bool):
    """The cells that a block of queries is sent to: the one with the best bound, or all that reach the floor."""

    def run(queries: pa.Table, boxes: pa.Table) -> pa.Table:
        names = ["qkey", "cell", "pieces"]
        if not queries.num_rows or not boxes.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        dim = queries["dim"][0].as_py()
        q, low, high = _matrix(queries["q"], dim), _matrix(boxes["low"], dim), _matrix(boxes["high"], dim)
        kind = _number_type(q, np.concatenate([low, high]))
        q, low, high = q.astype(kind), low.astype(kind), high.astype(kind)
        floors = queries["floor"].to_pylist()
        rows, columns = [], []
        for at in range(0, len(q), TOGETHER):
            bound = _bound(q[at : at + TOGETHER], low, high)
            if first:
                rows.append(np.arange(len(bound)) + at)
                columns.append(np.argmax(bound, axis=1))
            else:
                i, j = np.nonzero(bound >= _floors(floors[at : at + TOGETHER], kind)[:, None])
                rows.append(i + at)
                columns.append(j)
        i, j = np.concatenate(rows), np.concatenate(columns)
        return pa.table([queries["qkey"].combine_chunks().take(pa.array(i)), boxes["cell"].combine_chunks().take(pa.array(j)), boxes["pieces"].combine_chunks().take(pa.array(j))], names=names)

    return run


def _search_group(k: int):
    names = ["query_id", "qkey", "vec_id", "score"]

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4, names=names)
        dim = rows["dim"][0].as_py()
        qids, qkeys = queries["vec_id"].to_numpy(), queries["qkey"].to_numpy()
        q, ids, score = search(rows["vec_id"].to_numpy(), rows["qkey"].to_numpy(), _matrix(rows["q"], dim), qkeys, _matrix(queries["q"], dim), queries["floor"].to_pylist(), k)
        return pa.table([pa.array(qids[q]), pa.array(qkeys[q]), pa.array(ids), pa.array(score, pa.int64())], names=names)

    return run


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """The ``k`` best rows by inner product for each row whose ``vec_id`` is divisible by ``every``.

    ``query_id, rank, vec_id, score``; ties go to the smaller vec_id; fewer rows
    where there are fewer candidates. Candidates are all rows but the query's own:
    a repeated row is a candidate for its copies, and each copy is a query. Rows
    without an id, and vectors that are null or hold a null or non-finite
    component, take no part. Vectors are compared with those of their own length.
    Scores beyond a long are cut to its ends. An empty table gives no rows; other
    columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), quantise("embedding").alias("q")).where("vec_id is not null and q is not null")
    rows = cut(rows.select(F.monotonically_increasing_id().alias("qkey"), "vec_id", "q", F.size("q").alias("dim")), "topk")
    n, n_queries = rows.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0)).first()
    wanted = min(MOST_CELLS, max(1, -(-n // shard_rows)))
    share = min(1.0, CELL_SAMPLE * wanted / max(1, n))
    sample = rows.where(F.pmod(F.xxhash64("qkey"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select("q").limit(2 * CELL_SAMPLE * wanted) if wanted > 1 else rows.limit(0).select("q")
    taken = [r.q for r in sample.collect()]
    width = sorted(map(len, taken))[len(taken) // 2] if taken else 0
    cells = Cells(np.array([[*q[:width], *[0] * (width - len(q))] for q in taken], np.float64).reshape(len(taken), width), wanted)
    placed = cut(rows.mapInArrow(_place(cells), "qkey long, vec_id long, q array<long>, dim int, cell long"), "topk-placed")

    boxes = placed.select("dim", "cell", "q").mapInArrow(_partial_boxes, _BOX).groupBy("dim", "cell").applyInArrow(_whole_boxes, _BOX)
    boxes = cut(boxes.withColumn("pieces", F.ceil(F.col("n") / shard_rows).cast("long")), "topk-boxes")
    piece = F.pmod(F.xxhash64("qkey"), F.col("pieces"))
    data = placed.join(boxes.select("dim", "cell", "pieces"), ["dim", "cell"]).withColumn("piece", piece).drop("pieces")
    blocks = max(1, -(-n_queries // block_queries))
    queries = placed.where(F.col("vec_id") % every == 0).select("qkey", "vec_id", "q", "dim", F.pmod(F.xxhash64("qkey", F.lit("block")), F.lit(blocks)).alias("block"))

    def routed(asked: DataFrame, first: bool) -> DataFrame:
        """``qkey, cell, pieces`` of the cells that each query is sent to."""
        all_boxes = boxes.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        return asked.groupBy("dim", "block").cogroup(all_boxes.groupBy("dim", "block")).applyInArrow(_route(first), "qkey long, cell long, pieces long")

    def searched(asked: DataFrame) -> DataFrame:
        """The results of queries at their ``dim, cell, piece``."""
        shard, block = ["dim", "cell", "piece"], ["dim", "cell", "piece", "block"]
        own = lambda df, *columns: df.select(*(F.col(c).alias(c) for c in columns))  # noqa: E731  columns of its own on each side
        copies = own(data.join(own(asked, *block).distinct(), shard), *block, "qkey", "vec_id", "q")
        return copies.groupBy(block).cogroup(own(asked, *block, "qkey", "vec_id", "q", "floor").groupBy(block)).applyInArrow(_search_group(k), "query_id long, qkey long, vec_id long, score long")

    asked = queries.withColumn("floor", F.lit(None).cast("long"))
    at_home = cut(routed(asked, True).withColumn("home", piece), "topk-routes")
    home = cut(searched(asked.join(at_home.select("qkey", "cell", F.col("home").alias("piece")), "qkey")), "topk-home")
    kth = home.groupBy("qkey").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where((F.col("n") >= k) & (F.col("kth") > _LEAST))
    asked = cut(queries.join(kth.select("qkey", F.col("kth").alias("floor")), "qkey", "left"), "topk-asked")
    there = routed(asked, False).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    there = there.join(at_home.select("qkey", "cell", F.col("home").alias("piece")), ["qkey", "cell", "piece"], "left_anti")
    found = home.unionByName(searched(asked.join(there.select("qkey", "cell", "piece"), "qkey")))
    place = F.row_number().over(Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_topk(spark, sf_dir: str) -> DataFrame:
    """Each query's five best vectors by integer inner product."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS own, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.own, a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: CAST(z[1] AS HUGEINT) * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.own <> b.own AND len(a.q) = len(b.q)),
r AS (SELECT query_id, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
