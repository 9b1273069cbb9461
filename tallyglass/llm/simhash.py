"""SimHash fingerprints and exact linking within a Hamming radius of three.

Linking is meet-in-the-middle ball hashing. Two fingerprints x, y within three
bits share a *variant*: a value at distance <= 1 from one and <= 2 from the
other. So every fingerprint emits its ball of radius one, and the outer ring of
radius two is needed only where the distance is exactly three; there the two
have different bit parity, so only fingerprints of odd parity emit it. Of three
differing bits two lie in the same 32-bit half, so flipping pairs *within* a
half is enough (992 instead of 2016 variants).

Variants are not shuffled one by one. All variants with the same half agree on
that half, so the shuffle key is one half of the variant and a fingerprint
sends one row for all variants that keep the half plus 32 rows for those that
flip one of its bits; the other half is expanded after the shuffle, and only
where two rows share a key. Whoever meets in a full 64-bit variant is linked to
the smallest member at distance <= 1 from it (a star: such a member is within
three bits of everyone else there, by the triangle inequality), never in pairs.
The result has the same connected components as all pairs within three bits.
Keys with more than ``max_local`` rows send their variants through a second
shuffle on the whole variant, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.operators.components import connected_components
from tallyglass.storage import cut

#: Rows of one half-key that a task matches in memory (at most 529 variants each).
MAX_LOCAL = 2000


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of the 3-word shingles of ``text`` (unsigned).

    A-Z are lower-cased, words are runs of bytes other than ASCII white space,
    shingles are joined by one space and counted with repeats; one or two words
    are one shingle; no word (or null) gives 0. A bit is set if it is set in
    over half of the shingles' XXH64 (seed 42).
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    if len(words) < 3:
        starts, stops = [0], [len(joined)]
    else:
        starts = [0, *ends[:-3].tolist()]
        stops = (ends[2:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    half, total = len(starts) / 2, np.zeros(64, np.int64)
    for at in range(0, len(starts), 65536):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at : at + 65536], stops[at : at + 65536])], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(np.packbits(total > half, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps)], names=["doc_id", "t", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, t, fp`` for every row of ``docs``: a hash of the text, and the 64 bits as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("t"))
    return rows.mapInArrow(_fingerprints, "doc_id long, t long, fp long")


_FLIP = np.uint64(1) << np.arange(32, dtype=np.uint64)
_PAIR = np.array([a | b for a, b in combinations(_FLIP.tolist(), 2)], np.uint64)


def _expand(fp: np.ndarray, rest: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Variants of the other half: ``(variant, source fingerprint, outer)``.

    kind 0: the variant itself; 1: ball of radius one; 2: pairs only; 3: both.
    """
    out = [(rest[kind == 0], fp[kind == 0], np.zeros((kind == 0).sum(), bool))]
    for bit, masks, outer in ((1, np.concatenate([np.zeros(1, np.uint64), _FLIP]), False), (2, _PAIR, True)):
        on = (kind & bit) > 0
        v = (rest[on][:, None] ^ masks).ravel()
        out.append((v, np.repeat(fp[on], len(masks)), np.full(len(v), outer)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _stars(variant: np.ndarray, fp: np.ndarray, outer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each member of a variant to its smallest member at distance <= 1."""
    order = np.lexsort((fp, outer, variant))
    variant, fp, outer = variant[order], fp[order], outer[order]
    head = np.ones(len(variant), bool)
    head[1:] = variant[1:] != variant[:-1]
    at = np.maximum.accumulate(np.where(head, np.arange(len(variant)), 0))
    keep = ~outer[at] & (fp != fp[at])
    edges = np.unique(np.stack([fp[at][keep], fp[keep]], axis=1), axis=0)
    return edges[:, 0], edges[:, 1]


def _meet(max_local: int):
    """Match rows ``part, key, fp, rest, kind`` that arrive sorted by part and key."""

    def rows(a: np.ndarray, b: np.ndarray, variant: np.ndarray | None = None, outer: np.ndarray | None = None):
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(a.view(np.int64)),
                pa.array(b.view(np.int64)) if variant is None else pa.nulls(n, pa.int64()),
                pa.nulls(n, pa.int64()) if variant is None else pa.array(variant.view(np.int64)),
                pa.nulls(n, pa.bool_()) if outer is None else pa.array(outer),
            ],
            names=["a", "b", "variant", "outer"],
        )

    def spread(part, key, fp, rest, kind):
        for i in range(0, len(fp), 4096):
            v, f, o = _expand(fp[i : i + 4096], rest[i : i + 4096], kind[i : i + 4096])
            k = np.uint64(key)
            yield rows(f, f, (k << np.uint64(32)) | v if part == 0 else (v << np.uint64(32)) | k, o)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # rows of the last, unfinished key
        wide = None  # a key whose variants go through the second shuffle
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            cols = [c.view(np.uint64) if i in (1, 2, 3) else c for i, c in enumerate(cols)]
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            part, key = cols[0], cols[1]
            cutat = np.flatnonzero((part[1:] != part[:-1]) | (key[1:] != key[:-1])) + 1
            bounds = np.concatenate([[0], cutat, [len(key)]])
            last = bounds[-2]
            for a, b in _groups(bounds[:-1], wide is not None):
                yield from one([c[a:b] for c in cols], wide)
                wide = None
            held = [c[last:] for c in cols]
            if wide is not None and last > 0:
                wide = None
            if len(held[0]) > max_local:
                wide = (held[0][0], held[1][0])
                yield from spread(wide[0], wide[1], *held[2:])
                held = [h[:1] for h in held]  # keeps the key; sending a row twice does no harm
        if held is not None and (len(held[0]) > 1 or wide is not None):
            yield from one(held, wide)

    def _groups(bounds: np.ndarray, first: bool) -> Iterator[tuple[int, int]]:
        sizes = np.diff(bounds)
        for i in np.flatnonzero((sizes > 1) | ((np.arange(len(sizes)) == 0) & first)):
            yield bounds[i], bounds[i + 1]

    def one(cols, wide) -> Iterator[pa.RecordBatch]:
        part, key = cols[0][0], cols[1][0]
        if wide == (part, key) or len(cols[0]) > max_local:
            yield from spread(part, key, *cols[2:])
            return
        a, b = _stars(*_expand(*cols[2:]))
        if len(a):
            yield rows(a, b)

    return run


def links(fps: DataFrame, max_local: int = MAX_LOCAL) -> DataFrame:
    """Edges ``a, b`` between the distinct values of ``fps.fp``.

    Their connected components are those of the graph of all pairs that differ
    in three bits or fewer; the edges themselves are stars, not all pairs.
    """
    odd = (F.bit_count("fp") % 2) == 1
    hi, lo = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    flips = F.expr("transform(sequence(0, 31), i -> shiftleft(1L, i))")
    rows = []
    # part 0 keeps the high half and does all that lies within two bits, and pairs in the low half;
    # part 1 keeps the low half: only odd pairs in the high half against even balls of radius one.
    for part, key, rest in ((0, hi, lo), (1, lo, hi)):
        full = F.when(odd, 3 if part == 0 else 2).otherwise(1)
        near = F.lit(True) if part == 0 else ~odd
        keys = F.when(near, F.concat(F.array(F.lit(0).cast("long")), flips)).otherwise(F.array(F.lit(0).cast("long")))
        rows.append(
            fps.select("fp", rest.alias("rest"), key.alias("k"), full.alias("full"), F.explode(keys).alias("flip")).select(
                F.lit(part).alias("part"),
                F.col("k").bitwiseXOR(F.col("flip")).alias("key"),
                "fp",
                "rest",
                F.when(F.col("flip") == 0, F.col("full")).otherwise(0).alias("kind"),
            )
        )
    met = (
        rows[0]
        .unionByName(rows[1])
        .repartition(F.col("part"), F.col("key"))
        .sortWithinPartitions("part", "key")
        .mapInArrow(_meet(max_local), "a long, b long, variant long, outer boolean")
    )
    met = cut(met, "simhash-met")
    near = met.where("variant is null").select("a", "b")
    wide = met.where("variant is not null")
    hubs = wide.where("not outer").groupBy("variant").agg(F.min("a").alias("hub"))
    far = wide.join(hubs, "variant").select(F.col("hub").alias("a"), F.col("a").alias("b")).where("a <> b")
    return near.unionByName(far).distinct()


def _grouped(docs: DataFrame, max_local: int) -> DataFrame:
    """``doc_id, t, fp, root, component_id``: ``root`` names the component by a fingerprint."""
    rows = cut(fingerprints(docs), "simhash-fp")
    per_fp = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = connected_components(links(per_fp.select("fp"), max_local), "a", "b")
    linked = linked.select(F.col("node").alias("fp"), F.col("component").alias("root"))
    per_fp = per_fp.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    per_root = per_fp.groupBy("root").agg(F.min("least").alias("component_id"))
    named = per_fp.join(per_root, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "t", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, max_local: int = MAX_LOCAL) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over fingerprints that
    differ in at most three bits, its own row included. Null or empty texts have
    fingerprint 0 and are linked like any other. A null doc_id takes part in the
    linking but is never a component's id unless no row there has one. Repeated
    rows and ids are kept. An empty table gives no rows; other columns are ignored.
    """
    return _grouped(docs, max_local).select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, max_local: int = MAX_LOCAL) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: that of the smallest doc_id (nulls last).

    Null and empty texts are one component, as their fingerprints are equal. An
    empty table gives no rows.
    """
    return first_rows(docs, _grouped(docs, max_local).select("doc_id", "t", "root"))


def first_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The row of ``docs`` with the smallest doc_id (nulls last) of each ``root`` of ``rows``, which has ``doc_id, t, root`` for every row.

    Of rows with the same id and text the least by all other columns is taken, so
    that reruns agree. Columns are those of ``docs``, whatever their names.
    """
    rows = cut(rows, "first-rows")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("x"))
    copies = rows.groupBy(F.col("doc_id").alias("i"), F.col("t").alias("u"), "root").agg(F.count("*").alias("n"))
    chosen = first.select(F.col("x.doc_id").alias("id"), F.col("x.t").alias("t")).join(copies, F.col("id").eqNullSafe(F.col("i")) & (F.col("t") == F.col("u"))).select("id", "t", "n")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = packed.join(chosen, F.col("row.doc_id").cast("long").eqNullSafe(F.col("id")) & (F.xxhash64("row.text") == F.col("t")))
    again = found.where("n > 1").groupBy("id", "t").agg(F.min_by("row", F.to_json("row")).alias("row"))  # to_json: also where a column has no order
    return found.where("n = 1").select("row").unionByName(again.select("row")).select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
