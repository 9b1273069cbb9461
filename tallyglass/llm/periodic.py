"""Runs: stretches of a text's words that repeat themselves at once, and the text without the repeats.

A run is a stretch whose words ``period`` apart are identical (the smallest such
period), at least twice as long as that and at least ``least`` words, that no
neighbouring word extends.

They are found on a suffix automaton. A state stands for a string of ``length`` words
and the places where it ends; a state's places are those of its children in the
tree of suffix links, put together from the smaller sets into the largest. Two places
that become neighbours at distance d <= length are a square: the string starts again
before it has ended, or just after it. Each such seed is extended both ways to the
whole run, unless a run of that period holds it already. Neighbours are taken from
the finished set, so no occurrence lies between them and d is the smallest period.

A run of L words and period p has L - p >= least/2 words in a row that occur again p
later. So only stretches all of whose words lie in strings of that length that
repeat within the stretch can hold a run; these are found for a whole batch of texts
at once by sorting hashes, again and again until none shrinks. Ordinary texts have
none; the automaton is built for what stays. Words are compared themselves there,
so a hash that two strings share costs time but changes nothing.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The least length of a run, in words.
LEAST = 12
#: Texts of so many words in all are looked through together.
TOGETHER = 200_000
_BLOCK = 512
_MIX = np.random.default_rng(11).integers(0, 2**63, 4096, np.uint64) * np.uint64(2) + np.uint64(1)


class Places:
    """An ordered set of integers, in blocks so that an insertion moves few."""

    __slots__ = ("blocks", "tops", "size")

    def __init__(self, place: int):
        self.blocks, self.tops, self.size = [[place]], [place], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def add(self, place: int) -> None:
        at = min(bisect_left(self.tops, place), len(self.tops) - 1)
        block = self.blocks[at]
        insort(block, place)
        self.size += 1
        if len(block) > 2 * _BLOCK:
            self.blocks[at : at + 1] = [block[:_BLOCK], block[_BLOCK:]]
            self.tops[at : at + 1] = [block[_BLOCK - 1], block[-1]]
        else:
            self.tops[at] = block[-1]

    def neighbours(self, place: int) -> tuple[int | None, int | None]:
        """The next smaller and the next greater member of a member."""
        at = bisect_left(self.tops, place)
        block = self.blocks[at]
        i = bisect_left(block, place)
        below = block[i - 1] if i else self.blocks[at - 1][-1] if at else None
        above = block[i + 1] if i + 1 < len(block) else self.blocks[at + 1][0] if at + 1 < len(self.blocks) else None
        return below, above


def _automaton(words: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix link, length and end (-1 for a clone) of every state."""
    moves, link, length, end, last = [{}], [-1], [0], [-1], 0
    for i, c in enumerate(words):
        new = len(moves)
        moves.append({})
        length.append(i + 1)
        end.append(i)
        link.append(0)
        at = last
        while at >= 0 and c not in moves[at]:
            moves[at][c] = new
            at = link[at]
        if at >= 0:
            to = moves[at][c]
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                clone = len(moves)
                moves.append(moves[to].copy())
                length.append(length[at] + 1)
                end.append(-1)
                link.append(link[to])
                while at >= 0 and moves[at].get(c) == to:
                    moves[at][c] = clone
                    at = link[at]
                link[to] = link[new] = clone
        last = new
    return link, length, end


def _seeds(words: Sequence[int], least: int) -> Iterator[tuple[int, int, int]]:
    """``end, distance, length``: a string of that length ends at ``end`` and, next, ``distance`` later, within its own length. Only for lengths of half of ``least`` on."""
    link, length, end = _automaton(words)
    shortest = -(-least // 2)
    children: dict[int, list[Places]] = {}
    for v in np.argsort(-np.array(length), kind="stable").tolist():
        if length[v] < shortest:
            return
        sets = children.pop(v, [])
        if end[v] >= 0:
            sets.append(Places(end[v]))
        places = max(sets, key=lambda x: x.size)
        added = [x for s in sets if s is not places for x in s]
        for x in added:
            places.add(x)
        for x in added:
            below, above = places.neighbours(x)
            if below is not None and x - below <= length[v]:
                yield below, x - below, length[v]
            if above is not None and above - x <= length[v]:
                yield x, above - x, length[v]
        if length[link[v]] >= shortest:
            children.setdefault(link[v], []).append(places)


def _same(ids: np.ndarray, at: int, distance: int, step: int) -> int:
    """How many words from ``at`` on, upwards or downwards, equal those ``distance`` after them."""
    n, size = 0, 32
    room = len(ids) - distance - at if step > 0 else at + 1
    while n < room:
        size = min(size, room - n)
        a = at + n if step > 0 else at - n - size + 1
        other = ids[a : a + size] != ids[a + distance : a + distance + size]
        if other.any():
            return n + int(other.argmax() if step > 0 else other[::-1].argmax())
        n, size = n + size, size * 4
    return n


def runs(words: Sequence, least: int = LEAST) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all runs of a sequence, in order."""
    number: dict = {}
    named = [number.setdefault(w, len(number)) for w in words]
    ids = np.array(named, np.int64)
    known: dict[int, tuple[list[int], list[int]]] = {}  # by period: starts and ends, in order
    for end, period, length in _seeds(named, least):
        starts, ends = known.setdefault(period, ([], []))
        at = bisect_right(starts, end - period + 1) - 1
        if at >= 0 and ends[at] > end + period:
            continue
        start = end - length + 1 - _same(ids, end - length, period, -1)
        stop = end + 1 + period + _same(ids, end + 1, period, 1)
        at = bisect_left(starts, start)
        starts.insert(at, start)
        ends.insert(at, stop)
    return sorted((s, e - s, p) for p, (starts, ends) in known.items() for s, e in zip(starts, ends) if e - s >= least)


def _stretches(hashes: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches (from, to) of the words of some texts that may hold runs; ``text`` numbers the text of each word."""
    k = -(-least // 2)
    at, label = np.arange(len(hashes)), text
    while len(at) >= least:
        n = len(at) - k + 1
        grams = label[:n].astype(np.uint64) * _MIX[-1]
        for j in range(k):
            grams += hashes[j : n + j] * _MIX[j % 4000]
        grams ^= grams >> np.uint64(32)
        whole = np.flatnonzero(label[:n] == label[k - 1 :])
        order = whole[np.argsort(grams[whole])]
        same = grams[order[1:]] == grams[order[:-1]]
        again = np.zeros(len(at) + 1, np.int64)
        hit = np.zeros(len(order), bool)
        hit[1:] |= same
        hit[:-1] |= same
        np.add.at(again, order[hit], 1)
        np.add.at(again, order[hit] + k, -1)
        keep = np.cumsum(again[:-1]) > 0
        # a stretch ends where a word is left out or the label changes
        fresh = np.ones(len(at), bool)
        fresh[1:] = (label[1:] != label[:-1]) | ~keep[:-1]
        label = np.cumsum(fresh & keep)
        sizes = np.bincount(label[keep])
        keep &= sizes[label] >= least if len(sizes) else False
        if keep.all():
            break
        at, label, hashes = at[keep], label[keep], hashes[keep]
    else:
        return []
    edges = np.flatnonzero(np.diff(label)) + 1
    return [(int(at[a]), int(at[b - 1]) + 1) for a, b in zip([0, *edges], [*edges, len(at)])]


def runs_of_texts(texts: Sequence[list[bytes]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """``runs`` for each of some lists of words."""
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(sizes) - sizes
    hashes = np.fromiter((hash(w) for t in texts for w in t), np.int64, int(sizes.sum())).view(np.uint64)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in _stretches(hashes, np.repeat(np.arange(len(texts)), sizes), least):
        of = int(np.searchsorted(first, a, "right")) - 1
        a, b = a - int(first[of]), b - int(first[of])
        found[of] += [(s + a, n, p) for s, n, p in runs(texts[of][a:b], least)]
    return [sorted(x) for x in found]


def collapsed(words: list[bytes], found: Sequence[tuple[int, int, int]]) -> bytes:
    """The words that stay, joined by one space: of each run the first period."""
    if not found:
        return b" ".join(words)
    drop = np.zeros(len(words), bool)
    for start, length, period in found:
        drop[start + period : start + length] = True
    return b" ".join([w for w, d in zip(words, drop.tolist()) if not d])


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, runs, text`` for every row of ``docs``: its runs (``start, length, period`` in words, from 0) and the text without what they repeat.

    Words are what ASCII white space separates, compared byte by byte. A null or empty
    text has no runs and becomes empty; a null doc_id stays null; repeated rows have
    repeated results, other columns are ignored, no rows give no rows. Texts are
    taken whole: a run may be as long as its text. Memory is a task's batch, and
    about half a kilobyte for each word of its longest periodic stretch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, at, held = [], 0, 0
            for i in range(batch.num_rows):
                words.append((batch.column(1)[i].as_py() or b"").split())
                held += len(words[-1])
                if held >= TOGETHER or i + 1 == batch.num_rows:
                    found = runs_of_texts(words, least)
                    flat = np.array([x for r in found for x in r], np.int64).reshape(-1, 3)
                    spans = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, j])) for j in range(3)], names=["start", "length", "period"])
                    offsets = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
                    texts = pa.array([collapsed(w, r) for w, r in zip(words, found)], pa.binary())
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(words)), pa.ListArray.from_arrays(pa.array(offsets), spans), texts], names=["doc_id", "runs", "text"])
                    words, at, held = [], i + 1, 0

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    found = rows.mapInArrow(run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, text binary")
    return found.withColumn("text", F.col("text").cast("string"))


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of ``docs``, where a tenth of the texts (by CRC-32 of the doc_id) repeat a stretch of words from some word on; a null doc_id is left alone."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    text = F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")).otherwise(F.col("text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def longest(found: Column) -> Column:
    """The run of greatest length, of these the first, then that of the least period."""
    return F.array_max(F.transform(found, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))


def op11_periodic(spark, sf_dir: str) -> DataFrame:
    """Runs of every document (some with planted ones) and what stays without them, as digests."""
    found = periodic_runs(planted(spark.read.parquet(f"{sf_dir}/documents.parquet"))).withColumn("top", longest(F.col("runs")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.before")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.shorter")).alias("period"),
        F.expr("1000 * top.length div -top.shorter").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


ORACLE = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(doc_id::VARCHAR, '')]) AS steps FROM documents),
h AS (
  SELECT k, doc_id, w, len(w) AS n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, steps),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS h FROM d),
a AS (SELECT *, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM h),
p AS (SELECT *, CASE WHEN n > 0 AND h % 10 = 0 THEN 1 + (n - a) // (3 + (h // 10) % 8) END AS p FROM a),
i AS (SELECT k, w, n, a, p, unnest(range(n)) AS i FROM p),
t AS MATERIALIZED (SELECT k, n, i, CASE WHEN p IS NULL OR i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END AS word FROM i),
m AS (SELECT x.k, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.k = y.k AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // 2),
g AS (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS g FROM m),
s AS MATERIALIZED (SELECT k, q, min(i) AS s, count(*) + q AS l FROM g GROUP BY k, q, g HAVING count(*) >= q),
r AS (
  SELECT k, s AS start, l AS length, q AS period FROM s WHERE l >= 12 AND NOT EXISTS (
    SELECT 1 FROM s z WHERE z.k = s.k AND z.q < s.q AND z.s <= s.s AND z.s + z.l >= s.s + s.l)),
gone AS (SELECT DISTINCT k, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (SELECT k, string_agg(word, ' ' ORDER BY i) AS text FROM t ANTI JOIN gone USING (k, i) GROUP BY k),
e AS (
  SELECT k, count(*) AS n_runs, arg_min(struct_pack(start, length, period), (-length, start, period)) AS top,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY k)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.start AS start, top.length AS length, top.period AS period,
  1000 * top.length // top.period AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN e USING (k) LEFT JOIN kept USING (k)
"""
