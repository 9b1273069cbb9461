"""Near copies: groups of documents joined by Jaccard similarity of 0.8 or more of their 5-word shingles.

The first candidates are the links of ``simhash``: meet-in-the-middle ball hashing of
the fingerprints, within three bits. Each is compared exactly, as fingerprints that
close do not always mean 0.8, and those that hold are joined.

At similarity 0.8 about ten bits differ, so near copies remain that no link joins. Their
candidates come from MinHash bands: ``BANDS`` keys for each set of shingles, each of
``ROWS`` minima; a pair at similarity 0.8 shares none with probability
(1 - 0.8^4)^25 = 2e-6, a closer one with less. Every candidate pair is then compared
exactly, already joined through others, or ruled out by a bound:

First each member of a band that is not joined with it yet is compared with the band's hub, the member that meets
most others over all its bands: in a family of near copies that is the text they come
from. So a large family costs a comparison for each member.

Then only members outside of their hub's group are left, with bands of their own. The
shingles of the sets in such bands are counted: *rare* ones are in at most ``RARE`` of
these sets. Similarity 0.8 asks for an overlap of 0.8 of either set and of 4/9 of both
sizes. So a partner of x shares one of any |x| - 0.8 |x| + 1 of its shingles; if so many
are rare, the rarest of them find every partner, at most ``RARE`` through each. Else x
may have a partner that shares no rare shingle, only some of the others, common(x); for
such a pair

    common(x) >= 4/9 (|x| + |y|), hence |y| <= 9/4 common(x) - |x|, and |y| >= 4/5 |x|,

and the same with x and y exchanged: these are formed by an equal join on band and step
of size within the limits, each pair in the least of the bands that it shares. A text that was edited too much to be near its source has
too many rare shingles for that. What remains of both is compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.llm.simhash import fingerprint, first_rows, links
from tallyglass.operators.components import connected_components
from tallyglass.storage import arrow_batches, cut

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 4
#: A shingle is rare in no more sets than this.
RARE = 64
#: Bytes of texts or sets that a Python stage takes at a time.
BATCH_BYTES = 8 << 20
#: Sizes that differ by less than this factor are in one step.
STEP = 1.04

_RANDOM = np.random.default_rng(42)
_TIMES = _RANDOM.integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(0, 2**63, BANDS * ROWS, np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The distinct XXH64 (seed 42) of the shingles of ``text``, sorted; words are those of ``simhash.fingerprint``.

    Fewer than five words, or none, are one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    joined = b" ".join(words)
    if len(words) <= WORDS:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts, stops = [0, *ends[:-WORDS].tolist()], (ends[WORDS - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, stops)), np.uint64, len(starts)))


def bands(hashes: np.ndarray) -> list[int]:
    """The band keys of a set of shingles, as signed longs."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 4096):
        np.minimum(least, (hashes[i : i + 4096, None] * _TIMES + _PLUS).min(axis=0), out=least)
    keys = [xxhash.xxh64_intdigest(x.tobytes(), k) for k, x in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def _name(hashes: np.ndarray) -> int:
    return int(np.array([xxhash.xxh64_intdigest(hashes.tobytes(), 42)], np.uint64).view(np.int64)[0])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        found, fps = [shingles(t) for t in texts], np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(fps), pa.array(map(_name, found), pa.int64()), pa.array(map(len, found), pa.int64()), pa.array(map(bands, found), pa.list_(pa.int64()))],
            names=["doc_id", "t", "fp", "s", "n", "keys"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(t) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(map(_name, found), pa.int64()), pa.array([h.tobytes() for h in found], pa.binary())], names=["s", "hashes"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(both >= SIMILARITY * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each set."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            own = batch.slice(at, 256)
            hashes = [np.frombuffer(x.as_buffer(), np.int64) for x in own.column(1)]
            names = np.repeat(own.column(0).to_numpy(), [len(x) for x in hashes])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes)), pa.array(names)], names=["h", "s"])


def _sets_of(wanted: DataFrame, docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``s, hashes`` of the sets named in ``wanted`` (s), from one text of each."""
    texts = rows.join(wanted.distinct(), "s", "left_semi").groupBy("s").agg(F.min("t").alias("__t")).select("__t").distinct()
    of = docs.select("text", F.xxhash64("text").alias("__t")).join(texts, "__t", "left_semi").select("text").distinct()
    return cut(of.mapInArrow(_sets, "s long, hashes binary").dropDuplicates(["s"]), "nearcopies-sets")


def _joined(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (``a, b``, names of sets) that are similar enough."""
    x = pairs.join(sets.select(F.col("s").alias("a"), F.col("hashes").alias("x")), "a").join(sets.select(F.col("s").alias("b"), F.col("hashes").alias("y")), "b")
    return cut(x.select("a", "b", "x", "y").mapInArrow(_alike, "a long, b long"), "nearcopies-edges")


def _close(n: str, m: str) -> Column:
    """Whether sets of these sizes may be similar enough; a little wider than the bound, as comparison is exact."""
    return F.least(n, m) >= F.lit(SIMILARITY) * F.greatest(n, m) - 1e-6


def _linked_pairs(rows: DataFrame) -> DataFrame:
    """``a, b``: sets whose texts have fingerprints within three bits, as ``simhash.links`` finds them.

    Of the sets of one fingerprint each is paired with the least, and the least
    ones along the links, so that copies make no pairs among each other.
    """
    of = cut(rows.select("fp", "s", "n").distinct(), "nearcopies-fp")
    heads = cut(of.groupBy("fp").agg(F.min(F.struct("s", "n")).alias("x")), "nearcopies-heads")
    same = heads.join(of, "fp").select("x", F.struct("s", "n").alias("y"))
    met = links(heads.select("fp")).join(heads.select(F.col("fp").alias("a"), "x"), "a").join(heads.select(F.col("fp").alias("b"), F.col("x").alias("y")), "b")
    pairs = same.unionByName(met.select("x", "y")).where((F.col("x.s") != F.col("y.s")) & _close("x.n", "y.n"))
    return pairs.select(F.least("x.s", "y.s").alias("a"), F.greatest("x.s", "y.s").alias("b")).distinct()


def _left_pairs(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b`` of the members of open bands that may still be similar enough; ``open_`` has key, s, n, c, hub_c."""
    who = open_.groupBy("s").agg(F.max("n").alias("n"), F.max("c").alias("c"), F.max(F.col("c") != F.col("hub_c")).alias("far"))
    spread = cut(sets.mapInArrow(_spread, "h long, s long"), "nearcopies-spread")
    rare = spread.join(spread.groupBy("h").agg(F.count("*").alias("df")).where(F.col("df") <= RARE), "h")
    rare = cut(rare.join(who, "s"), "nearcopies-rare")
    place = F.row_number().over(Window.partitionBy("s").orderBy("df", "h"))
    asked = rare.where("far").withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * F.lit(SIMILARITY) - 1e-6) + 1).where("df > 1")
    asked = asked.select("h", F.col("s").alias("a"), F.col("n").alias("an"), F.col("c").alias("ac"))
    other = rare.where("df > 1").select("h", F.col("s").alias("b"), F.col("n").alias("bn"), F.col("c").alias("bc"))
    lengths = F.least("an", "bn") >= F.lit(SIMILARITY) * F.greatest("an", "bn") - 1e-6
    found = asked.join(other, "h").where((F.col("ac") != F.col("bc")) & lengths).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    # the largest partner that shares no rare shingle, a little wider than the bound, as comparison is exact
    few = rare.groupBy("s").agg(F.count("*").alias("few"))
    x = open_.join(few, "s", "left").withColumn("most", F.floor(F.lit(9 / 4) * (F.col("n") - F.coalesce("few", F.lit(0))) - F.col("n") + 1e-6))
    x = x.withColumn("least", F.ceil(F.col("n") * F.lit(SIMILARITY) - 1e-6)).where("most >= least")
    x = cut(x.select("key", "s", "n", "c", "hub_c", "least", "most"), "nearcopies-room")
    x = cut(x.join(x.groupBy("s").agg(F.collect_set("key").alias("keys")), "s"), "nearcopies-room")  # 25 keys at most
    step = lambda c: F.floor(F.log(c) / F.lit(math.log(STEP)))
    steps = F.sequence(step(F.col("least")), step(F.least(F.col("most"), F.ceil(F.col("n") / SIMILARITY + 1e-6))))
    far = x.where("c <> hub_c").select("key", F.col("s").alias("a"), F.col("n").alias("an"), F.col("c").alias("ac"), F.col("least").alias("al"), F.col("most").alias("am"), F.col("keys").alias("ak"), F.explode(steps).alias("step"))
    rest = x.select("key", F.col("s").alias("b"), F.col("n").alias("bn"), F.col("c").alias("bc"), "hub_c", F.col("least").alias("bl"), F.col("most").alias("bm"), F.col("keys").alias("bk"), step(F.col("n")).alias("step"))
    apart = (F.col("ac") != F.col("bc")) & ((F.col("bc") == F.col("hub_c")) | (F.col("a") < F.col("b")))
    room = F.col("bn").between(F.col("al"), F.col("am")) & F.col("an").between(F.col("bl"), F.col("bm"))
    once = F.array_min(F.array_intersect("ak", "bk")) == F.col("key")  # in each band that they share a pair meets once: it counts in the least
    wide = far.join(rest, ["key", "step"]).where(apart & room & once).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return found.unionByName(wide).distinct()


def groups(docs: DataFrame) -> DataFrame:
    """``doc_id, t, s, root`` for every row of ``docs``: ``root`` names the group, ``s`` the set of shingles, ``t`` the text."""
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        return _groups(docs)


def _groups(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("t"))
    rows = cut(rows.mapInArrow(_signed, "doc_id long, t long, fp long, s long, n long, keys array<long>"), "nearcopies-rows")
    linked = cut(_linked_pairs(rows), "nearcopies-linked")
    edges = _joined(linked, _sets_of(linked.select(F.explode(F.array("a", "b")).alias("s")), docs, rows))
    found = connected_components(edges, "a", "b").select(F.col("node").alias("s"), F.col("component").alias("c"))

    members = rows.select("s", "n", F.explode("keys").alias("key")).distinct()
    sizes = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    met = cut(members.join(sizes, "key"), "nearcopies-met")
    meets = met.groupBy("s").agg(F.sum("size").alias("meets"))
    met = met.join(meets.join(found, "s", "left").withColumn("c", F.coalesce("c", "s")), "s")
    hubs = met.groupBy("key").agg(F.max(F.struct("meets", "s", "n", "c")).alias("hub")).select("key", F.col("hub.s").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.c").alias("hub_c"))
    met = cut(met.join(hubs, "key").select("key", "s", "n", "c", "hub", "hub_n", "hub_c"), "nearcopies-hubs")
    # those that the links have joined are done; sets whose sizes differ by more can't be similar enough
    first = met.where((F.col("c") != F.col("hub_c")) & _close("n", "hub_n"))
    first = cut(first.select(F.least("hub", "s").alias("a"), F.greatest("hub", "s").alias("b")).distinct(), "nearcopies-pairs")
    edges = edges.unionByName(_joined(first, _sets_of(first.select(F.explode(F.array("a", "b")).alias("s")), docs, rows)))

    found = connected_components(edges, "a", "b").select(F.col("node").alias("__s"), F.col("component").alias("c"))
    known = met.drop("c", "hub_c").join(found, F.col("s") == F.col("__s"), "left").withColumn("c", F.coalesce("c", "s")).drop("__s")
    heads = known.where("s = hub").select("key", F.col("c").alias("hub_c"))
    known = cut(known.join(heads, "key"), "nearcopies-known")
    open_ = cut(known.join(known.where("c <> hub_c").select("key").distinct(), "key", "left_semi").where("s <> hub"), "nearcopies-open")
    sets = _sets_of(open_.select("s"), docs, rows)
    second = cut(_left_pairs(open_, sets), "nearcopies-pairs")
    edges = edges.unionByName(_joined(second, sets))

    found = connected_components(edges, "a", "b").select(F.col("node").alias("__s"), F.col("component").alias("root"))
    rows = rows.join(found, F.col("s") == F.col("__s"), "left")
    return rows.select("doc_id", "t", "s", F.coalesce("root", "s").alias("root"))


def representatives(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group of near copies, with all its columns: that of the smallest doc_id (nulls last).

    Null and empty texts are one group, and so are equal texts. Of repeated rows
    one stays. An empty table gives no rows. Columns are those of ``docs``,
    whatever their names.
    """
    return first_rows(docs, groups(docs).select("doc_id", "t", "root"))
