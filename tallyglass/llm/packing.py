"""Packing token streams into sequences by an order-preserving dynamic program.

Documents are dealt to shards by a hash of doc_id and text, about
``DOCS_PER_SHARD`` each, and laid end to end in order of doc_id. A shard's
stream is cut into windows of at most 1024 ids. Cuts may fall at document ends
(free), at sentence ends (a small penalty) and, within stretches that have
neither for long, at fixed distances (a larger penalty). The program minimises
padding plus penalties plus a fixed cost for each window:

    f(j) = penalty(j) + window + min over i of f(i) + padding(p_j - p_i)

Padding is 1024 minus the length, so the minimum over all i within 1024 is a
sliding minimum of f(i) + p_i, kept by a monotone queue; a length that is a
power of two has no padding, which adds at most ten direct transitions.

A stream is worked off in pieces of memory: after ``HELD_CHARS`` characters the
windows on which all cuts that may still follow agree are given out, and what is
behind them is kept. The result is that of the whole stream at once. A document
by itself is held whole.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.storage import per_process

#: The file of the vocabulary; each machine has it, only its name is sent.
VOCABULARY = "byte_bpe_50k.tiktoken"
WINDOW = 1024
DOCS_PER_SHARD = 256
#: Shards that a task packs, one after the other.
SHARDS_PER_TASK = 64
#: Characters of a shard that are laid out at a time.
HELD_CHARS = 8_000_000
END_ID = 0
SENTENCE_PENALTY, HARD_PENALTY, WINDOW_COST = 4, 24, 64
#: In a stretch of more than GAP ids without a document or sentence end, every STEP-th place is a possible cut.
GAP, STEP = 256, 64
_CHUNK = re.compile(r" ?\S+|\s+(?!\S)|\s+")
_SENTENCE_ENDS = frozenset(".!?…。！？")  # as single characters


class _Chunks(dict):
    """Numbers for chunks of text as they are met; number 0 is a document's end."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []
        self.size = 1

    def __missing__(self, key: str) -> int:
        self[key] = n = self.size
        self.size += 1
        self.new.append(key)
        return n


class Encoder:
    """Byte-level BPE ids of many texts, each distinct chunk encoded once.

    A chunk is what lies between white space, with the one space before it; the
    vocabulary's own splitting never crosses such a border.
    """

    def __init__(self, vocabulary: str, most: int = 400_000):
        with open(public_tokenizers.path(vocabulary), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, n in ranks.items():
            self.width[n] = len(piece)
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.chunks = _Chunks()
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 1
        self.ids[0] = END_ID
        self.start, self.count, self.ends = [np.zeros(1, np.int64)], [np.ones(1, np.int64)], [np.zeros(1, bool)]

    def _learn(self) -> None:
        """Encode the chunks met since the last call.

        What starts with one space or line feed and ends in neither is split the
        same among others as alone, so such chunks are encoded in one go.
        """
        new = self.chunks.new
        if not new:
            return
        alone = np.fromiter((x[0] == "\x1f" for x in new), bool, len(new))
        among = [x if x[0] == "\n" else " " + x for x, y in zip(new, alone) if not y]
        count = np.zeros(len(new), np.int64)
        joint = np.array(self.bpe.encode_ordinary("".join(among)), np.int64)
        stop = np.cumsum(np.fromiter((len(x.encode()) for x in among), np.int64, len(among)))
        count[~alone] = np.diff(np.searchsorted(np.cumsum(self.width[joint]), stop) + 1, prepend=0)
        each = [self.bpe.encode_ordinary(x[1:]) for x, y in zip(new, alone) if y]
        count[alone] = [len(x) for x in each]
        is_alone = np.repeat(alone, count)
        ids = np.empty(len(is_alone), np.int64)
        ids[is_alone], ids[~is_alone] = [i for x in each for i in x], joint
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.start.append(self.used + np.cumsum(count) - count)
        self.count.append(count)
        self.ends.append(np.fromiter((x.rstrip("\"')]»”")[-1:] in _SENTENCE_ENDS for x in new), bool, len(new)))
        self.used += len(ids)
        self.chunks.new = []

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids end to end, each text's number of ids (with its end id), and the places of sentence ends."""
        if self.chunks.size > self.most:
            self._forget()
        codes: list[int] = []
        number = self.chunks.__getitem__
        for text in texts:
            if text:
                if " ".join(text.split()) == text.replace("\n", " "):
                    codes.extend(map(number, ("\x1f" + text.replace("\n", " \n")).split(" ")))
                elif re.search("[\x1c-\x1f]", text):  # white space to one library and not to the other
                    codes.append(number("\x1f" + text))
                else:
                    codes.extend(number("\x1f" + x) for x in _CHUNK.findall(text))
            codes.append(0)
        self._learn()
        if len(self.start) > 1:
            self.start, self.count, self.ends = ([np.concatenate(x)] for x in (self.start, self.count, self.ends))
        code = np.array(codes, np.int64)
        count = self.count[0][code]
        stop = np.cumsum(count)
        ids = self.ids[np.repeat(self.start[0][code] - stop + count, count) + np.arange(stop[-1])]
        doc_stop = stop[code == 0]
        return ids, np.diff(np.concatenate([[0], doc_stop])), stop[self.ends[0][code]]


def candidates(doc_stop: np.ndarray, sentence_stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Possible cuts, increasing, with their penalties; the first is 0."""
    at = np.concatenate([[0], doc_stop, sentence_stop])
    penalty = np.concatenate([np.zeros(len(doc_stop) + 1, np.int64), np.full(len(sentence_stop), SENTENCE_PENALTY)])
    order = np.lexsort((penalty, at))
    at, penalty = at[order], penalty[order]
    keep = np.concatenate([[True], at[1:] != at[:-1]])
    at, penalty = at[keep], penalty[keep]
    gap = np.diff(at)
    hard = [np.arange(at[i] + STEP, at[i + 1], STEP) for i in np.flatnonzero(gap > GAP)]
    if hard:
        extra = np.concatenate(hard)
        at, penalty = np.concatenate([at, extra]), np.concatenate([penalty, np.full(len(extra), HARD_PENALTY)])
        order = np.argsort(at, kind="stable")
        at, penalty = at[order], penalty[order]
    return at, penalty


def best_cuts(at: np.ndarray, penalty: np.ndarray, window: int = WINDOW, last: bool = True) -> np.ndarray:
    """The ends of the windows, by the dynamic program of the module's text.

    If the stream goes on behind its ``last`` place, only those ends on which the
    best ways to all places that a later cut can follow agree.
    """
    place = np.full(int(at[-1]) + 1, -1, np.int64)
    place[at] = np.arange(len(at))
    also: dict[int, list[int]] = {}
    size = 1
    while size < window:
        j = np.flatnonzero(at >= size)
        i = place[at[j] - size]
        for a, b in zip(j[i >= 0].tolist(), i[i >= 0].tolist()):
            also.setdefault(a, []).append(b)
        size *= 2
    p, fine = at.tolist(), (penalty + WINDOW_COST).tolist()
    f, came = [0] * len(p), [0] * len(p)
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])  # f + p, p, index
    for j in range(1, len(p)):
        here = p[j]
        while queue[0][1] < here - window:
            queue.popleft()
        cost, _, i = queue[0]
        cost += window - here
        if j in also:
            for k in also[j]:
                if f[k] < cost:
                    cost, i = f[k], k
        f[j] = cost = cost + fine[j]
        came[j] = i
        cost += here
        while queue and queue[-1][0] >= cost:
            queue.pop()
        queue.append((cost, here, j))
    j = len(p) - 1
    if not last:
        open_ = {i for i in range(int(np.searchsorted(at, at[-1] - window, "right")), len(p))}
        while len(open_) > 1:
            j = max(open_)
            open_.remove(j)
            open_.add(came[j])
        (j,) = open_
    ends = []
    while j:
        ends.append(p[j])
        j = came[j]
    return np.array(ends[::-1], np.int64)


class _Stream:
    """One shard's ids, laid end to end; what is behind the last settled window is held."""

    def __init__(self, shard: int):
        self.shard, self.sequence = shard, 0
        self.tokens = np.zeros(0, np.uint32)
        self.at, self.penalty = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.doc_ids = pa.array([], pa.int64())
        self.stop, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, encoder: Encoder, ids: list, texts: list) -> None:
        tokens, size, sentence = encoder.encode(texts)
        held, stop = len(self.tokens), np.cumsum(size)
        at, penalty = candidates(stop, sentence)
        self.tokens = np.concatenate([self.tokens, tokens])
        self.at, self.penalty = np.concatenate([self.at, at[1:] + held]), np.concatenate([self.penalty, penalty[1:]])
        self.doc_ids = pa.concat_arrays([self.doc_ids, pa.array(ids, pa.int64())])
        self.stop, self.size = np.concatenate([self.stop, stop + held]), np.concatenate([self.size, size])

    def settled(self, last: bool) -> pa.RecordBatch | None:
        """The pieces in windows that are final (all, if these were the ``last`` documents)."""
        if not len(self.stop):
            return None
        ends = best_cuts(self.at, self.penalty, last=last)
        if not len(ends):
            return None
        done, stop, size = int(ends[-1]), self.stop, self.size
        edge = np.union1d(stop[stop <= done], ends)
        begin = np.concatenate([[0], edge[:-1]])
        doc, win = np.searchsorted(stop, begin, "right"), np.searchsorted(ends, begin, "right")
        columns = [
            self.doc_ids.take(pa.array(doc)),
            pa.array(begin - (stop - size)[doc]),
            pa.array(edge - begin),
            pa.array([zlib.crc32(self.tokens[a:b]) for a, b in zip(begin.tolist(), edge.tolist())], pa.int64()),
            pa.array(size[doc]),
            pa.array((self.shard << 32) + self.sequence + win),
            pa.array(begin - np.concatenate([[0], ends[:-1]])[win]),
        ]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        self.sequence += len(ends)
        self.tokens = self.tokens[done:]
        keep = self.at >= done
        self.at, self.penalty = self.at[keep] - done, self.penalty[keep]
        open_ = stop > done
        self.doc_ids, self.stop, self.size = self.doc_ids.filter(pa.array(open_)), stop[open_] - done, size[open_]
        return pa.RecordBatch.from_arrays(columns, names=names)


def _pack(vocabulary: str, held_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(f"encoder {vocabulary}", lambda: Encoder(vocabulary))
        stream, ids, texts, held = None, [], [], 0

        def laid(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, texts, held
            if texts:
                stream.add(encoder, ids, texts)
            ids, texts, held = [], [], 0
            out = stream.settled(last)
            if out is not None:
                yield out

        for batch in batches:
            for shard, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if stream is None or shard != stream.shard:
                    if stream is not None:
                        yield from laid(True)
                    stream = _Stream(shard)
                ids.append(doc_id)
                texts.append(text)
                held += len(text or "")
                if held >= held_chars:
                    yield from laid(False)
        if stream is not None:
            yield from laid(True)

    return run


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, held_chars: int = HELD_CHARS) -> DataFrame:
    """A row for each piece of a document in a sequence.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. A null
    or empty text has the end id alone. Strings of special tokens are ordinary
    text: the vocabulary's splitting and merges are all that is applied to them.
    A null doc_id is kept as it is; repeated rows are packed each. Equal doc_ids
    lie in order of text. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    shards = max(1, -(-docs.count() // DOCS_PER_SHARD))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shards // SHARDS_PER_TASK))
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards))
    return (
        docs.select(F.col("doc_id").cast("long"), "text")
        .select(shard.alias("shard"), "doc_id", "text")
        .repartition(tasks, "shard")
        .sortWithinPartitions("shard", "doc_id", "text")
        .mapInArrow(
            _pack(vocabulary, held_chars),
            "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
        )
    )


def op4_packing(spark, sf_dir: str) -> DataFrame:
    """Pack every document into sequences of 1024 ids.

    Ids are the vocabulary's own: ``<|endoftext|>`` and its like inside a text
    are encoded as the text they are, never as special ids, which the
    documents' public tokenizers ask for (``encode_special_tokens``).
    """
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
