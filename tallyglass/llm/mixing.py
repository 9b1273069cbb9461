"""Mixing sources to target weights by Sainte-Lague apportionment.

The words to be taken are cut into equal blocks. Sources get blocks by highest
quotients of their targets, then each source's blocks go to its shards by
highest quotients of the shards' sizes. Within a shard the documents stand in an
order drawn from a seed, repeated as often as the quota holds the whole shard,
and the rest of the quota takes blocks from the front of that order.

Sources are counted first. Up to ``MOST_LISTED`` of them, a row each, are
apportioned on the driver; more are ranked, and their targets and quotas found,
by sums over the table of sources: bounds that are narrowed until the sums fit.
The shards of one source (``SHARDS`` rows) are apportioned in a task. Running sums
inside a shard go over cells of about ``CELL_WORDS`` words or ``CELL_ROWS`` rows:
sums of cells first, then rows within a cell.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.storage import cut

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
SHARDS = 64
CELL_WORDS, CELL_ROWS = 50_000, 2_000
MOST_LISTED = 10_000
#: Sources that stand in a row in one task while they are numbered.
RUN = 100_000
#: A block has MOST_BLOCK words, or fewer where that would make fewer than LEAST_BLOCKS blocks.
MOST_BLOCK, LEAST_BLOCKS = 1024, 1 << 17
SEED = 17
_WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: Sequence[int], weights: Sequence[float], most: float = MOST_TIMES) -> list[float]:
    """Shares of the sum of ``sizes`` by weight, none above ``most`` times its size; what is over goes to the rest."""
    out, open_ = [0.0] * len(sizes), list(range(len(sizes)))
    left = float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        share = {i: left * weights[i] / total for i in open_}
        full = [i for i in open_ if share[i] > most * sizes[i]]
        for i in full or open_:
            out[i] = float(most * sizes[i]) if full else share[i]
        if not full:
            break
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def sainte_lague(weights: Sequence[float], seats: int) -> list[int]:
    """Seats by the highest quotients weight / (2 * seats so far + 1); ties go to the first.

    A divisor gives all quotients above it at once; only the last few are handed
    out one by one, so the work does not grow with the number of seats.
    """
    total = float(sum(weights))
    if seats <= 0 or total <= 0:
        return [0] * len(weights)
    divisor = total / seats
    while sum(given := [-int(-(w / divisor + 0.5) // 1) - 1 if w > 0 else 0 for w in weights]) > seats:
        divisor *= 1 + max(1e-12, (sum(given) - seats) / (2 * seats))
    heap = [(-w / (2 * g + 1), i) for i, (w, g) in enumerate(zip(weights, given)) if w > 0]
    heapq.heapify(heap)
    for _ in range(seats - sum(given)):
        _, i = heap[0]
        given[i] += 1
        heapq.heapreplace(heap, (-weights[i] / (2 * given[i] + 1), i))
    return given


def _measured(docs: DataFrame, seed: int) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        size.alias("size"),
        F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.xxhash64("text")).alias("h"),
    )


def _multiway(low, high, fits, ways: int = 16, whole: bool = False):
    """The smallest value of [low, high] that fits, if all above it do; ``fits`` tests many at once. Stops at neighbouring numbers."""
    while True:
        between = [low + (high - low) * i / ways for i in range(1, ways)]
        tried = sorted({int(x) if whole else x for x in between if low < x < high} - {low, high})
        if not tried:
            return high
        good = fits(tried)
        for x, ok in zip(tried, good):
            if ok:
                high = x
                break
            low = x


def _ranked(sources: DataFrame, n: int) -> DataFrame:
    """``sources`` with ``sx``: its place by code point, null last, from 0."""
    spark = sources.sparkSession
    order = F.col("source").asc_nulls_last()
    ranged = cut(sources.repartitionByRange(max(1, -(-n // RUN)), order).withColumn("part", F.spark_partition_id()), "mixing-ranked")
    before, offsets = 0, []
    for r in sorted(ranged.groupBy("part").agg(F.count("*").alias("n")).collect()):
        offsets.append((r.part, before))
        before += r.n
    place = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return ranged.join(F.broadcast(spark.createDataFrame(offsets, "part int, before long")), "part").withColumn("sx", F.col("before") + place).drop("part", "before")


def _spread_targets(sources: DataFrame, total: int, most: float) -> DataFrame:
    """``sources`` (size, weight) with ``target``, as ``targets`` gives it."""
    size, weight = F.col("size").cast("double") * most, F.col("weight")
    left, open_ = float(total), None
    weights = sources.agg(F.sum("weight")).first()[0]
    while True:
        share = F.lit(left) * weight / F.lit(float(weights))
        full = (share > size) if open_ is None else (~open_ | (share > size))
        kept, rest = sources.agg(F.coalesce(F.sum(F.when(full, size)), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, weight)), F.lit(0.0))).first()
        if open_ is not None and rest == weights:
            return sources.withColumn("target", F.when(full, size).otherwise(share))
        if not rest:
            return sources.withColumn("target", size)
        left, open_, weights = float(total) - kept, ~full, rest


def _spread_seats(sources: DataFrame, seats: int) -> DataFrame:
    """``sources`` (sx, target) with ``blocks``: ``seats`` by highest quotients, ties to the first."""
    t = F.col("target")
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    if seats <= 0 or total <= 0:
        return sources.withColumn("blocks", F.lit(0).cast("long"))
    given = lambda d: F.when(t > 0, F.greatest(F.ceil(t / F.lit(float(d)) + 0.5) - 1, F.lit(0))).otherwise(0).cast("long")
    sums = lambda columns: [int(x or 0) for x in sources.agg(*[F.sum(c) for c in columns]).first()]
    divisor = _multiway(total / seats / 4, total * 4, lambda ds: [n <= seats for n in sums([given(d) for d in ds])])
    sources = sources.withColumn("blocks", given(divisor))
    rest = seats - sums([F.col("blocks")])[0]
    # what is left goes to the highest next quotients: nothing lies between the divisor and its lower neighbour but equal ones
    quotient = F.when(t > 0, t / (2 * F.col("blocks") + 1)).otherwise(0.0)
    sources = sources.withColumn("__q", quotient)
    while rest > 0:
        best = sources.agg(F.max("__q")).first()[0]
        tied = sources.where(F.col("__q") == best)
        n, last = tied.agg(F.count("*"), F.max("sx")).first()
        upto = last if n <= rest else _multiway(-1, last, lambda xs: [c >= rest for c in [int(x or 0) for x in tied.agg(*[F.count_if(F.col("sx") <= x) for x in xs]).first()]], whole=True)
        more = (F.col("__q") == best) & (F.col("sx") <= upto)
        sources = sources.withColumn("blocks", F.col("blocks") + F.when(more, 1).otherwise(0)).withColumn("__q", quotient)
        rest -= min(n, rest)
    return sources.drop("__q")


def _apportioned(sources: DataFrame, weights: Sequence[float], most_listed: int) -> tuple[DataFrame, int, bool]:
    """``sx, source, size, n, target, blocks`` of every source, the words in a block, and whether these are few rows."""
    spark = sources.sparkSession
    n, total = sources.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    block = max(1, min(MOST_BLOCK, total // LEAST_BLOCKS))
    if n <= most_listed:
        listed = sorted(((r.source, r.size, r.n) for r in sources.collect()), key=lambda x: (x[0] is None, x[0] or ""))
        goal = targets([x[1] for x in listed], [weights[i % len(weights)] for i in range(n)])
        blocks = sainte_lague(goal, round(total / block))
        rows = [(i, *x, float(t), b) for i, (x, t, b) in enumerate(zip(listed, goal, blocks))]
        return spark.createDataFrame(rows, "sx long, source string, size long, n long, target double, blocks long"), block, True
    ranked = _ranked(sources, n).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sx") % len(weights) + 1).cast("int")))
    aimed = cut(_spread_targets(cut(ranked, "mixing-sources"), total, MOST_TIMES), "mixing-targets")
    return cut(_spread_seats(aimed, round(total / block)), "mixing-blocks"), block, False


def _shard_quotas(block: int):
    """Words of each shard of a source: how often the whole shard, and how many more."""

    def run(rows: pa.Table) -> pa.Table:
        own, first = rows["words"].to_pylist(), {c: rows[c][0].as_py() for c in ("sx", "size", "target", "blocks")}
        order = sorted(range(len(own)), key=rows["shard"].to_pylist().__getitem__)
        seats = dict(zip(order, sainte_lague([own[i] for i in order], first["blocks"])))
        times, rest = [], []
        for i, n in enumerate(own):
            words = MOST_TIMES * n if first["target"] >= MOST_TIMES * first["size"] else min(seats[i] * block, MOST_TIMES * n)
            times.append(words // n if n else 0)
            rest.append(words - times[-1] * n)
        return pa.table([rows["sx"], rows["shard"], pa.array(times, pa.int64()), pa.array(rest, pa.int64())], names=["sx", "shard", "times", "rest"])

    return run


def _takes(rows: DataFrame, weights: Sequence[float], shards: int, most_listed: int) -> DataFrame:
    """``rows`` (doc_id, source, size, h) with ``source_size, target, taken``."""
    sources = cut(rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "mixing-sizes")
    aimed, block, few = _apportioned(sources, weights, most_listed)
    cells = F.greatest(F.ceil(F.col("size") / (shards * CELL_WORDS)), F.ceil(F.col("n") / (shards * CELL_ROWS)), F.lit(1)).cast("long")
    names = aimed.select("sx", F.col("source").alias("source_name"), F.col("size").alias("source_size"), "target", cells.alias("cells"))
    found = rows.join(F.broadcast(names) if few else names, F.col("source").eqNullSafe(F.col("source_name"))).drop("source_name", "source")
    found = found.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int")).withColumn("cell", F.pmod(F.shiftright("h", 16), F.col("cells")))

    key = ["sx", "shard", "cell"]
    before = Window.partitionBy("sx", "shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cell = cut(found.groupBy(key).agg(F.sum("size").alias("words")), "mixing-cells")
    whole = cell.groupBy("sx", "shard").agg(F.sum("words").alias("words")).join(aimed.select("sx", "size", "target", "blocks"), "sx")
    quota = whole.groupBy("sx").applyInArrow(_shard_quotas(block), "sx long, shard int, times long, rest long")
    cell = cell.join(quota, ["sx", "shard"])
    cell = cell.select(*key, "times", "rest", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("cell_start"))
    inside = Window.partitionBy(key).orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("cell_start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    part = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), F.col("rest") - start))
    return found.join(cell, key).withColumn("taken", F.col("times") * F.col("size") + part).select("doc_id", "h", "size", "source_size", "target", "taken")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, shards: int = SHARDS, seed: int = SEED, most_listed: int = MOST_LISTED) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``.

    Size is the number of words (null text: 0). Sources in code-point order, a
    null source last, have the weights in turn; see ``targets``. ``taken`` is the
    number of words the mix takes of this row, repeats counted, at most three
    times its size; rows without words take none. Repeated rows are rows of
    their own. The same rows in any order or partitioning give the same result.
    An empty table gives no rows; other columns are ignored.
    """
    found = _takes(cut(_measured(docs, seed), "mixing"), weights, shards, most_listed)
    return found.drop("h")


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, shards: int = SHARDS, seed: int = SEED, most_listed: int = MOST_LISTED) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each row as often as it is taken.

    A part of a document (at most one for each source and shard) keeps its first
    words, joined by single spaces; ``n_chars`` follows, if there is such a column.
    Documents without words, null or empty texts among them, are in no mix. Rows
    equal in doc_id and text share what they take evenly, rounded up. An empty
    table gives no rows. Other columns are carried along, whatever their names.
    """
    columns = docs.columns
    taken = _takes(cut(_measured(docs, seed), "mixing"), weights, shards, most_listed).where("taken > 0")
    taken = taken.groupBy("h", "size").agg(F.ceil(F.avg("taken")).cast("long").alias("taken"))
    text = F.col("row.text")
    h = F.xxhash64(F.lit(seed), F.col("row.doc_id").cast("long"), F.xxhash64(text))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")
    whole = F.array_repeat(text, (F.col("taken") / F.col("size")).cast("int"))
    part = F.array_join(F.slice(words, 1, F.pmod("taken", "size").cast("int")), " ")
    texts = F.when(F.pmod("taken", "size") == 0, whole).otherwise(F.concat(whole, F.array(part)))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    out = rows.withColumn("h", h).join(taken, "h").select("row", F.explode(texts).alias("one"))
    swap = {"text": F.col("one"), "n_chars": F.when(F.col("one") == text, F.col("row.n_chars")).otherwise(F.length("one")) if "n_chars" in columns else None}
    return out.select(*((swap[c] if c in swap else F.col(f"row.`{c}`")).alias(c) for c in columns))


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
