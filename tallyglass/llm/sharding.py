"""Sharding by balanced label propagation.

Nodes start in a shard drawn from a hash. In each round every node counts its
neighbours' shards and asks to move to the one that most of them are in; a shard
takes no more than it has room for, and where more ask, a share of them drawn by
hash is let in. Nodes that are the smallest of their neighbourhood hold still
and move only in every third round, so that two linked nodes do not keep
swapping places. Links are rows of an edge table and each round is joins and
partially aggregated counts; only tables with a row for each shard come to the
driver. A group of equal texts is a star of edges to its smallest row.

Afterwards rows without links, and what rounding let in too many, fill the
shards up to their exact number of rows. Ranks over large shards are taken
within hash cells of bounded size, offset by the sums of the cells before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.storage import cut

SHARDS, ROUNDS, SEED = 40, 6, 23
CELL_ROWS, BLOCKS = 4000, 64


def _chance(*columns, seed: int):
    """A number in [0, 1) drawn by hash."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 30)) / float(1 << 30)


def propagate(labels: DataFrame, edges: DataFrame, room: dict[int, int], rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """Move the nodes of ``labels`` (node, label) towards their neighbours.

    ``edges`` (a, b) are links between nodes, in any direction, each once; loops
    and links to unknown nodes count for nothing. ``room`` is the number of nodes
    that each label may hold, on average: acceptance is by chance, so a label may
    end a little above. Nodes without links keep their label. Ties between labels
    go to the smallest. Returns ``node, label``.
    """
    links = edges.where("a <> b").select("a", "b")
    both = cut(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "shard-links")
    anchors = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), (F.col("a") < F.col("least")).alias("anchor"))
    now = cut(labels.join(anchors, "node", "left").select("node", "label", F.coalesce("anchor", F.lit(True)).alias("anchor")), "shard-label")
    for i in range(rounds):
        votes = both.join(now.select(F.col("node").alias("b"), "label"), "b").groupBy("a", "label").agg(F.count("*").alias("n"))
        want = votes.groupBy("a").agg(F.max(F.struct("n", (-F.col("label")).alias("minus"))).alias("best"))
        want = want.select(F.col("a").alias("node"), (-F.col("best.minus")).alias("want"))
        asked = now.join(want, "node", "left").withColumn("ask", (F.col("want") != F.col("label")) & (F.col("anchor") == F.lit(i % 3 == 2)))
        asked = cut(asked.withColumn("ask", F.coalesce("ask", F.lit(False))), "shard-ask")
        held = {r.label: r.n for r in asked.groupBy("label").agg(F.count("*").alias("n")).collect()}
        wanted = {r.want: r.n for r in asked.where("ask").groupBy("want").agg(F.count("*").alias("n")).collect()}
        if not wanted:
            continue
        share = {s: min(1.0, max(0, room.get(s, 0) - held.get(s, 0)) / n) for s, n in wanted.items()}
        let_in = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(share.items()) for x in pair]), F.col("want"))
        goes = F.col("ask") & (_chance("node", F.lit(i), seed=seed) < let_in)
        now = cut(asked.select("node", F.when(goes, F.col("want")).otherwise(F.col("label")).alias("label"), "anchor"), "shard-label")
    return now.select("node", "label")


def ranked(rows: DataFrame, by: str, order: list[str], cells: int) -> DataFrame:
    """``rows`` with ``rank``, gapless from 0 within each value of ``by``.

    The order is by hash cell and then by ``order``, which must tell all rows of a
    ``by`` apart. No task sorts more than a cell.
    """
    placed = rows.withColumn("cell", F.pmod(F.xxhash64(*order), F.lit(cells)))
    before = Window.partitionBy(by).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    start = placed.groupBy(by, "cell").agg(F.count("*").alias("n")).select(by, "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy(by, "cell").orderBy(*order))
    return placed.join(start, [by, "cell"]).withColumn("rank", F.col("start") + inside - 1).drop("cell", "start")


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """Every row's shard and place in it, by the law ``rows``.

    ``doc_id, size, text_crc32, law, shard, slot, grown_shard``. The shards' counts
    of rows are at most one apart, slots are gapless from 0, ``grown_shard`` is
    null. Rows with equal texts are linked (null and empty texts are equal) and
    share a shard as far as it has room. Repeated rows and null ids are rows of
    their own. An empty table gives no rows; other columns are ignored.
    """
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select(
        F.monotonically_increasing_id().alias("node"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"),
    )
    rows = cut(rows.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "t")), "shard-rows")
    same = ["t", "text_crc32", "size"]
    groups = rows.groupBy(*same).agg(F.count("*").alias("n"), F.min("node").alias("hub")).where("n > 1").drop("n")
    groups = cut(groups, "shard-groups")  # so that both sides of the join below are shuffled for it, and a large group can be split
    tied = cut(rows.join(groups, same).select("node", "h", "hub"), "shard-tied")

    n = rows.count()
    room = {s: n // shards + (s < n % shards) for s in range(shards)}
    labels = tied.select("node", F.pmod("h", F.lit(shards)).cast("int").alias("label"))
    moved = propagate(labels, tied.select(F.col("node").alias("a"), F.col("hub").alias("b")), room, rounds, seed)

    cells = max(16, n // (min(shards, BLOCKS) * CELL_ROWS))
    placed = cut(ranked(moved.join(tied.select("node", "h"), "node"), "label", ["h", "node"], cells), "shard-tied")
    held = {r.label: r.n for r in placed.groupBy("label").agg(F.count("*").alias("n")).collect()}
    kept = {s: min(room[s], held.get(s, 0)) for s in range(shards)}
    limit = F.element_at(F.create_map(*[F.lit(x) for s in range(shards) for x in (s, kept[s])]), F.col("label"))
    stay = placed.where(F.col("rank") < limit).select("node", F.col("label").alias("shard"), F.col("rank").alias("slot"))

    fill = rows.join(stay.select("node"), "node", "left_anti").select("node", "h", F.pmod("h", F.lit(BLOCKS)).cast("int").alias("block"))
    fill = ranked(fill, "block", ["h", "node"], cells)
    sizes = {r.block: r.n for r in rows.join(stay.select("node"), "node", "left_anti").groupBy(F.pmod("h", F.lit(BLOCKS)).cast("int").alias("block")).agg(F.count("*").alias("n")).collect()}
    starts, at = [], 0
    for b in range(BLOCKS):
        starts += [b, at]
        at += sizes.get(b, 0)
    fill = fill.withColumn("at", F.element_at(F.create_map(*map(F.lit, starts)), F.col("block")) + F.col("rank"))
    free, at = [], 0
    for s in range(shards):
        if room[s] > kept[s]:
            free.append((s, at, at + room[s] - kept[s], kept[s]))
            at += room[s] - kept[s]
    spots = F.array(*[F.struct(F.lit(s).alias("shard"), F.lit(b).cast("long").alias("stop"), F.lit(k - a).cast("long").alias("shift")) for s, a, b, k in free]) if free else None
    if spots is None:
        done = stay
    else:
        spot = F.filter(spots, lambda x: x["stop"] > F.col("at"))[0]
        done = stay.unionByName(fill.withColumn("spot", spot).select("node", F.col("spot.shard").alias("shard"), (F.col("at") + F.col("spot.shift")).alias("slot")))
    return rows.join(done, "node").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    """Put every document into one of 40 shards of equal numbers of rows."""
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
