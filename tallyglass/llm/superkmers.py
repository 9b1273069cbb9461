"""Repeated passages: windows of words that already start in an earlier document, by super-k-mers.

A window is ``width`` consecutive words. Its minimiser is the least hash of the
``mer`` words in a row within it; equal windows have equal minimisers, and
consecutive windows mostly share theirs. So a stretch of windows with one
minimiser (a super-k-mer) goes as one string to the bucket of that minimiser, which
holds all copies of each of its windows.

What travels is kept small, without leaving out a window:

* First only marks do: minimiser, document, place and a 128-bit digest of the string,
  about a sixth of the text. Equal strings become one, with their first document,
  by a grouped minimum; a passage with a million copies is one row from each task.
  Strings of minimisers that only one document has go no further.
* In a bucket with one distinct string all windows have the string's first document.
  Only buckets with several strings (where passages begin and end) get the strings
  themselves, one for each digest, and count their windows exactly: the words
  of a bucket are ranked, ranks of pairs give those of strings twice as long, and so
  on to the window; windows of equal rank are equal.
* A bucket of more than ``most`` words is not held by one task. Its strings are cut
  into pieces of a few windows, at fixed distances from the minimiser, so that copies
  are cut alike; digests of pieces, and of the windows of those pieces that still differ, find
  their first document by grouped minima.

A later occurrence of a string loses all its windows; in the first document a
window goes if it starts in an earlier document through another string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.storage import cut

#: Words of a window, and of the strings among which its minimiser is chosen.
WIDTH, MER = 50, 8
#: Words of a bucket that one task ranks.
MOST = 20_000
#: Words of the buckets that a task ranks together.
TOGETHER = 500_000
#: Windows of a piece of a string in a larger bucket.
PIECE = 8
#: Stands for a null doc_id: later than all others.
_LAST = 2**63 - 1

_TIMES = np.random.default_rng(13).integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def mers(words: list[bytes], mer: int = MER) -> np.ndarray:
    """The hash of each string of ``mer`` words."""
    n = len(words) - mer + 1
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    least = np.zeros(n, np.uint64)
    for j in range(mer):
        least += h[j : n + j] * _TIMES[j % 64]
    least ^= least >> np.uint64(31)
    least *= _TIMES[-1]
    least ^= least >> np.uint64(29)
    return least


def minimisers(words: list[bytes], width: int = WIDTH, mer: int = MER) -> np.ndarray:
    """The minimiser of each window."""
    least = mers(words, mer)
    held, room = 1, width - mer + 1  # values that each minimum has seen
    while held < room:
        step = min(held, room - held)
        least = np.minimum(least[:-step], least[step:])
        held += step
    return least


def super_kmers(words: list[bytes], width: int = WIDTH, mer: int = MER) -> Iterator[tuple[int, int, int]]:
    """Minimiser, first window and number of windows of each stretch with one minimiser."""
    if len(words) < width:
        return
    least = minimisers(words, width, mer)
    edges = [0, *(np.flatnonzero(least[1:] != least[:-1]) + 1).tolist(), len(least)]
    signed = least.view(np.int64)
    for a, b in zip(edges, edges[1:]):
        yield int(signed[a]), a, b - a


def _digest(text: bytes) -> tuple[int, int]:
    x = hashlib.blake2b(text, digest_size=16).digest()
    return int.from_bytes(x[:8], "little", signed=True), int.from_bytes(x[8:], "little", signed=True)


_MARK = "doc long, t long, start int, n int, key long, s1 long, s2 long"


def _marks(width: int, mer: int):
    names = [x.split()[0] for x in _MARK.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, (doc, t) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                words = (batch.column(2)[i].as_py() or b"").split()
                for key, start, n in super_kmers(words, width, mer):
                    rows.append((doc, t, start, n, key, *_digest(b" ".join(words[start : start + n + width - 1]))))
                if len(rows) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, y) for c, y in zip(zip(*rows), types)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, y) for c, y in zip(zip(*rows), types)], names=names)

    return run


def _strings(width: int):
    """The strings that are asked for, from the texts that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = (batch.column(0)[i].as_py() or b"").split()
                asked = batch.column(1)[i].as_py()
                texts = [b" ".join(words[x["start"] : x["start"] + x["n"] + width - 1]) for x in asked]
                columns = [pa.array([x[c] for x in asked], pa.bool_() if c == "hot" else pa.int64()) for c in ("key", "hot", "first", "s1", "s2")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary())], names=["key", "hot", "first", "s1", "s2", "words"])

    return run


def window_ranks(words: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the windows of a sequence of numbers: equal where all words are."""
    rank, held = words.astype(np.int64), 1
    while held < width:
        step = min(held, width - held)
        pairs = rank[:-step] * (int(rank.max(initial=0)) + 1) + rank[step:]
        rank = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        held += step
    return rank


def _covered(strings: list[tuple[int, int, int, list[bytes]]], width: int) -> Iterator[tuple[int, int, int, int]]:
    """``s1, s2, a, b`` for stretches of windows (a to b - 1) of a string that start in an earlier document than its first; ``strings`` (first, s1, s2, words) have all copies."""
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for x in strings for w in x[3]], np.int64)
    if len(ids) < width:
        return
    ends = np.cumsum([len(x[3]) for x in strings])
    starts = np.concatenate([[0], ends[:-1]])
    of = np.repeat(np.arange(len(strings)), ends - starts)
    ranks = window_ranks(ids, width)
    at = np.flatnonzero(of[: len(ranks)] == of[width - 1 :])  # windows within a string
    rank, of = ranks[at], of[at]
    docs = np.array([x[0] for x in strings], np.int64)[of]
    first = np.full(int(rank.max()) + 1, _LAST, np.int64)
    np.minimum.at(first, rank, docs)
    gone = first[rank] < docs
    hits, where = at[gone], of[gone]
    if not len(hits):
        return
    breaks = np.flatnonzero((np.diff(hits) != 1) | (np.diff(where) != 0)) + 1
    for a, b in zip([0, *breaks.tolist()], [*breaks.tolist(), len(hits)]):
        x = strings[int(where[a])]
        yield x[1], x[2], int(hits[a] - starts[where[a]]), int(hits[b - 1] - starts[where[a]]) + 1


_SPAN = "s1 long, s2 long, a int, b int"


def _ranked(width: int):
    """Spans of earlier windows in buckets that come whole, one after the other."""

    def spans(strings) -> pa.RecordBatch:
        found = list(_covered(strings, width)) if len(strings) > 1 else []
        columns = list(zip(*found)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, y) for c, y in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["s1", "s2", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings, held, last = [], 0, None
        for batch in batches:
            for key, first, s1, s2, words in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if held > TOGETHER and key != last:
                    yield spans(strings)
                    strings, held = [], 0
                strings.append((first, s1, s2, words.split()))
                held, last = held + len(strings[-1][3]), key
        if strings:
            yield spans(strings)

    return run


def pieces(words: list[bytes], key: int, width: int = WIDTH, mer: int = MER) -> Iterator[tuple[int, int, int]]:
    """Number, first window and end of the pieces of a super-k-mer with the minimiser ``key``: windows in a row at like distances (``PIECE``) from it."""
    places = np.flatnonzero(mers(words, mer).view(np.int64) == key)
    at = np.arange(len(words) - width + 1)
    before = places[np.searchsorted(places, at)]
    number = (before - at) // PIECE
    edges = [0, *(np.flatnonzero((np.diff(before) != 0) | (np.diff(number) != 0)) + 1).tolist(), len(at)]
    for a, b in zip(edges, edges[1:]):
        yield int(number[a]), a, b


_PIECE = "key long, number long, first long, s1 long, s2 long, a int, p1 long, p2 long, w array<struct<w1:long,w2:long>>"


def _pieces(width: int, mer: int):
    """The pieces of strings, with digests of them and of their windows."""
    names = [x.split()[0] for x in _PIECE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, first, s1, s2, text in zip(*(batch.column(c).to_pylist() for c in range(5))):
                words = text.split()
                rows, digests = [], []
                for number, a, b in pieces(words, key, width, mer):
                    own = [_digest(b" ".join(words[i : i + width])) for i in range(a, b)]
                    rows.append((key, number, first, s1, s2, a, *_digest(b" ".join(words[a : b + width - 1]))))
                    digests.append(own)
                flat = np.array([d for own in digests for d in own], np.int64).reshape(-1, 2)
                windows = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, j])) for j in (0, 1)], names=["w1", "w2"])
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in digests])]), pa.int32())
                columns = [pa.array(c, pa.int32() if n == "a" else pa.int64()) for c, n in zip(zip(*rows), names)]
                yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(offsets, windows)], names=names)

    return run


def _spread(texts: DataFrame, width: int, mer: int) -> DataFrame:
    """Spans of earlier windows in buckets that no task holds."""
    rows = cut(texts.select("key", "first", "s1", "s2", "words").mapInArrow(_pieces(width, mer), _PIECE), "superkmer-pieces")
    differ = (F.min("p1") != F.max("p1")) | (F.min("p2") != F.max("p2"))
    several = rows.groupBy("key", "number").agg(differ.alias("several")).where("several").select("key", "number")
    earliest = rows.groupBy("p1", "p2").agg(F.min("first").alias("x"))
    rows = cut(rows.join(earliest, ["p1", "p2"]), "superkmer-pieces")
    later = rows.where("x < first").select("s1", "s2", "a", (F.col("a") + F.size("w")).alias("b"))
    windows = rows.where("x = first").join(several, ["key", "number"]).select("first", "s1", "s2", "a", F.posexplode("w").alias("i", "w")).select("first", "s1", "s2", (F.col("a") + F.col("i")).alias("a"), "w.*")
    windows = cut(windows, "superkmer-windows")
    earliest = windows.groupBy("w1", "w2").agg(F.min("first").alias("x"), F.max("first").alias("y")).where("x < y").select("w1", "w2", "x")
    return later.unionByName(windows.join(earliest, ["w1", "w2"]).where("x < first").select("s1", "s2", "a", (F.col("a") + 1).alias("b")))


def spans(docs: DataFrame, width: int = WIDTH, mer: int = MER, most: int = MOST) -> DataFrame:
    """``doc, t, a, b``: stretches of windows of a document (a to b - 1) that start in one with a smaller doc_id as well; ``docs`` is ``doc, t, text``."""
    marks = cut(docs.select("doc", "t", F.col("text").cast("binary").alias("text")).mapInArrow(_marks(width, mer), _MARK), "superkmer-marks")
    differ = (F.min("s1") != F.max("s1")) | (F.min("s2") != F.max("s2"))
    keys = marks.groupBy("key").agg(F.min("doc").alias("x"), F.max("doc").alias("y"), differ.alias("several")).where("x < y").select("key", "several")
    marks = cut(marks.join(keys, "key"), "superkmer-shared")
    strings = cut(marks.groupBy("s1", "s2", "several").agg(F.min("doc").alias("first"), F.max("doc").alias("last")), "superkmer-strings")

    one = marks.where("several").groupBy("key", "s1", "s2").agg(F.min(F.struct("doc", "t", "start")).alias("at"), F.max("n").alias("n"))
    one = cut(one.select("key", "s1", "s2", "at.*", "n"), "superkmer-one")
    sizes = one.groupBy("key").agg((F.sum("n") + F.count("*") * (width - 1) > most).alias("hot"))
    asked = one.join(sizes, "key").groupBy("doc", "t").agg(F.collect_list(F.struct("start", "n", "key", "hot", F.col("doc").alias("first"), "s1", "s2")).alias("asked"))
    # of repeated rows one has the strings
    texts = docs.join(asked.withColumnsRenamed({"doc": "__d", "t": "__t"}), (F.col("doc") == F.col("__d")) & (F.col("t") == F.col("__t")))
    texts = texts.select(F.col("text").cast("binary").alias("text"), "asked").mapInArrow(_strings(width), "key long, hot boolean, first long, s1 long, s2 long, words binary")
    texts = cut(texts, "superkmer-texts")
    here = texts.where("not hot").select("key", "first", "s1", "s2", "words").repartition("key").sortWithinPartitions("key").mapInArrow(_ranked(width), _SPAN)
    partly = here.unionByName(_spread(texts.where("hot"), width, mer)).distinct()

    found = marks.join(strings.where("first < last").select("s1", "s2", "first"), ["s1", "s2"]).where("doc > first").select("doc", "t", F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b"))
    owned = strings.where("several").select("s1", "s2", "first").join(partly, ["s1", "s2"])
    own = marks.where("several").join(owned, ["s1", "s2"]).where("doc = first").select("doc", "t", (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b")).alias("b"))
    return found.unionByName(own)


def kept_words(words: list[bytes], found: list[tuple[int, int]], width: int = WIDTH) -> tuple[int, bytes]:
    """How many words the windows ``a`` to ``b - 1`` of some spans cover, and the others joined by one space."""
    if not found:
        return 0, b" ".join(words)
    gone = np.zeros(len(words), bool)
    for a, b in found:
        gone[a : b + width - 1] = True
    return int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist()) if not g])


def deduplicated(docs: DataFrame, width: int = WIDTH, mer: int = MER, most: int = MOST) -> DataFrame:
    """``doc_id, n_words, n_removed, text`` for every row of ``docs``: its words without those that a repeated window covers, joined by one space.

    Words are what ASCII white space separates, unchanged. A window of ``width`` words
    is repeated if the same words also start in a document with a smaller doc_id
    (null: later than all others); windows are judged as they are in the input. Rows of one
    doc_id don't count as repeats of each other, whether their texts are equal or
    not. A null text has no words; texts of fewer words than a window keep them all; other
    columns are ignored; no rows give no rows. Texts are taken whole. Equal text
    hashes (64 bits) of one doc_id and equal 128-bit digests stand for equal texts and strings.
    """
    if not 0 < mer <= width:
        raise ValueError("a minimiser has at least one word and at most a window's")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("t"), "text")
    found = spans(rows, width, mer, most).groupBy("doc", "t").agg(F.collect_list(F.struct("a", "b")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, texts = [], [], []
            for i in range(batch.num_rows):
                words = (batch.column(1)[i].as_py() or b"").split()
                gone, text = kept_words(words, [(x["a"], x["b"]) for x in batch.column(2)[i].as_py() or ()], width)
                n.append(len(words)), removed.append(gone), texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary())], names=["doc_id", "n_words", "n_removed", "text"])

    both = rows.join(found.withColumnsRenamed({"doc": "__d", "t": "__t"}), (F.col("doc") == F.col("__d")) & (F.col("t") == F.col("__t")), "left")
    out = both.select("doc_id", F.col("text").cast("binary").alias("text"), "spans").mapInArrow(run, "doc_id long, n_words long, n_removed long, text binary")
    return out.withColumn("text", F.col("text").cast("string"))


def op13_superkmers(spark, sf_dir: str) -> DataFrame:
    """Every document without the passages of 50 words or more that an earlier one has."""
    out = deduplicated(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
v AS (SELECT doc_id, w, unnest(range(len(w) - 49)) AS a FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, a, array_to_string(w[a + 1:a + 50], ' ') AS x FROM v),
f AS (SELECT x, min(doc_id) AS first FROM h GROUP BY x),
g AS (SELECT DISTINCT doc_id, unnest(range(a, a + 50)) AS i FROM h JOIN f USING (x) WHERE doc_id > first),
t AS (SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS word FROM d),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM t ANTI JOIN g USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
