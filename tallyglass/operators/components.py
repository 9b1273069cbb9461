"""Connected components of an undirected graph as iterated Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.storage import remove, written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Label every node that has an edge with the smallest node it can reach.

    Alternates "large-star" and "small-star" steps: in the first, a node's
    larger neighbours are re-attached to the smallest node it sees; in the
    second, its smaller neighbours are. The edge list never grows, the minimum
    of a neighbourhood is a partially aggregated ``min`` and the join back is an
    ordinary equi-join, so a hub with very many edges is split by the adaptive
    skew join instead of landing in one task. Rounds grow with the logarithm of
    the longest path. Each round's edges are written to the shared folder, and those
    of the round before are removed.

    Null ends and self loops are ignored. Returns ``node, component``, a row for
    each node with an edge to another; no edges give no rows.
    """
    e = (
        edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
        .where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    spark = edges.sparkSession
    e, path = written(e, "cc")
    before = _state(e)
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("x"))
            .select(F.col("x.u").alias("u"), F.col("x.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        old = path
        e, path = written(small, "cc")
        remove(spark, old)
        now = _state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
