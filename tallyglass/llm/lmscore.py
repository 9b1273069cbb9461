"""Document likelihood over all segmentations into the pieces of a vocabulary.

The vocabulary is an existing one, of the byte-pair kind (none of the public files
has unigram log probabilities): its scores are the ranks of its merges. Their order
gives the starting weights, 1 / (rank + 10), and one round of
expectation-maximisation over all training words gives those that are used. A word's probability is the sum over all
its segmentations, by a forward recursion in log space; a document's is the
product over its words and its end.

Texts are never shuffled. Tasks cut them into chunks of bounded size and number
the distinct tokens of a chunk, so that what is joined with the corpus counts is
a row for each chunk and distinct token, and what comes back to a chunk's
documents is numbers only. A token's count is a sum that is combined before the
shuffle, and its weight is computed once; both go to the chunks by an equal join,
whose hot tokens the adaptive skew join can split. Only sums over the corpus and one number for each piece of the
vocabulary come to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.storage import cut, per_process, shuffle_partitions

VOCABULARY = "piece_bpe_32k.model"
CHUNK_BYTES = 32 << 20
#: Rows of chunks and tokens that a shuffle partition is meant to hold.
PARTITION_ROWS = 2_000_000
#: Added to a piece's starting weight's rank, and the weight of the starting distribution in counts of pieces.
RANK_OFFSET, PRIOR = 10, 1000.0
#: The end of a document, as a token: no word is empty.
END = ""
_SPACE = "▁"


class Pieces:
    """The strings of a vocabulary: numbers of the pieces, of the 256 bytes, and of the end."""

    def __init__(self, name: str):
        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        self.number: dict[str, int] = {}
        self.bytes = [0] * 256
        ranks = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            ranks.append(-model.get_score(i) if not (model.is_control(i) or model.is_unknown(i)) else None)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                ranks[-1] = float(model.get_piece_size())
            elif ranks[-1] is not None and piece:
                self.number[piece] = i
        self.end, self.size = model.eos_id(), model.get_piece_size()
        #: The pieces as a tree of characters; where one ends, its number is under 0.
        self.tree: dict = {}
        for piece, i in self.number.items():
            node = self.tree
            for character in piece:
                node = node.setdefault(character, {})
            node[0] = i
        start = np.array([0.0 if r is None else 1.0 / (r + RANK_OFFSET) for r in ranks])
        start[self.end] = start.max()
        self.start = start / start.sum()


def pieces(name: str = VOCABULARY) -> Pieces:
    """The vocabulary, loaded once in a process."""
    return per_process(f"pieces {name}", lambda: Pieces(name))


def _sum(terms: Sequence[float]) -> float:
    if len(terms) == 1:
        return terms[0]
    most = max(terms)
    return most + math.log(sum([math.exp(t - most) for t in terms]))


class Lattice:
    """Marginal log probabilities of tokens under weights of the pieces."""

    def __init__(self, vocabulary: Pieces, weights: np.ndarray):
        self.vocabulary = vocabulary
        weights = np.maximum(weights, 1e-300)
        self.weight, self.log = weights.tolist(), np.log(weights).tolist()
        self.bytes = [self.log[i] for i in vocabulary.bytes]
        self.end = self.log[vocabulary.end]

    def _spelt(self, character: str) -> float:
        return sum(self.bytes[b] for b in character.encode("utf-8", "surrogatepass"))

    def score(self, token: str) -> float:
        """Natural log of the probability, summed over all segmentations."""
        if token == END:
            return self.end
        text, tree, logs, exp, log1p = _SPACE + token, self.vocabulary.tree, self.log, math.exp, math.log1p
        n = len(text)
        to: list[float | None] = [0.0] + [None] * n
        for i in range(n):
            here, j = to[i], i
            node = tree.get(text[i])
            if node is None or 0 not in node:  # a character that is no piece is spelt in bytes
                x, old = here + self._spelt(text[i]), to[i + 1]
                to[i + 1] = x if old is None else old + log1p(exp(x - old)) if old > x else x + log1p(exp(old - x))
            while node is not None:
                j += 1
                piece = node.get(0)
                if piece is not None:
                    x, old = here + logs[piece], to[j]
                    to[j] = x if old is None else old + log1p(exp(x - old)) if old > x else x + log1p(exp(old - x))
                if j == n:
                    break
                node = node.get(text[j])
        return to[n]

    def expect(self, token: str, count: float, into: list[float]) -> None:
        """Add to ``into`` the expected number of each piece in ``count`` times ``token``.

        Short tokens are summed as they are; where that would leave the range of a
        double, in log space.
        """
        v = self.vocabulary
        if token == END:
            into[v.end] += count
            return
        text, tree, weight = _SPACE + token, v.tree, self.weight
        n = len(text)
        before = [0.0] * (n + 1)
        before[0] = 1.0
        edges: list[tuple[int, int, int, float]] = []
        for i in range(n):
            here, j = before[i], i
            node = tree.get(text[i])
            if node is None or 0 not in node:
                p = math.exp(self._spelt(text[i]))
                before[i + 1] += here * p
                edges.append((i, i + 1, -1, p))
            while node is not None:
                j += 1
                piece = node.get(0)
                if piece is not None:
                    p = weight[piece]
                    before[j] += here * p
                    edges.append((i, j, piece, p))
                if j == n:
                    break
                node = node.get(text[j])
        if before[n] > 1e-250:
            after = [0.0] * n + [count / before[n]]
            for i, j, number, p in reversed(edges):
                x = p * after[j]
                after[i] += x
                if number >= 0:
                    into[number] += x * before[i]
                else:
                    self._add_bytes(into, text[i], x * before[i])
            return
        for i, number, x in self._long_shares(n, count, edges, text):
            if number >= 0:
                into[number] += x
            else:
                self._add_bytes(into, text[i], x)

    def _add_bytes(self, into: list[float], character: str, x: float) -> None:
        for b in character.encode("utf-8", "surrogatepass"):
            into[self.vocabulary.bytes[b]] += x

    def _long_shares(self, n: int, count: float, edges: list, text: str) -> list[tuple[int, int, float]]:
        """The shares of the edges, forward and backward in log space."""
        logs = [self._spelt(text[i]) if number < 0 else math.log(p) for i, _, number, p in edges]
        ends: list[list[float]] = [[] for _ in range(n + 1)]
        before, after = [0.0] * (n + 1), [0.0] * (n + 1)
        done = 0
        for (i, j, _, _), p in zip(edges, logs):
            if i > done:
                before[i], done = _sum(ends[i]), i
            ends[j].append(before[i] + p)
        whole = _sum(ends[n])
        starts: list[list[float]] = [[] for _ in range(n + 1)]
        done = n
        for (i, j, _, _), p in zip(reversed(edges), reversed(logs)):  # edges from a place come together, later places first
            while done > i + 1:
                done -= 1
                after[done] = _sum(starts[done])
            starts[i].append(p + after[j])
        return [(i, number, count * math.exp(before[i] + p + after[j] - whole)) for (i, j, number, _), p in zip(edges, logs)]


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class _Numbers(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


_CHUNKED = "kind int, chunk long, doc_id long, held_out boolean, n_tokens long, step binary, times binary, ix int, token string, tf long"


def _chunked(chunk_bytes: int):
    """Documents as numbered tokens (kind 0) and each chunk's tokens with their training counts (kind 1)."""

    def rows(docs: list, names: _Numbers, chunk: int) -> Iterator[pa.RecordBatch]:
        tf = np.zeros(len(names), np.int64)
        ids, held, sizes, steps, times = [], [], [], [], []
        for doc_id, out, codes in docs:
            ix, n = np.unique(codes, return_counts=True)
            if not out:
                tf[ix] += n
            ids.append(doc_id)
            held.append(out)
            sizes.append(len(codes))
            steps.append(np.diff(ix, prepend=0).astype(np.uint32).tobytes())
            times.append(n.astype(np.uint32).tobytes())
        fields = _CHUNKED.replace(" int", ":i").split(", ")
        names_ = [f.split()[0].split(":")[0] for f in fields]
        for kind, n in ((0, len(docs)), (1, len(names))):
            own = {"kind": pa.array(np.full(n, kind, np.int32)), "chunk": pa.array(np.full(n, chunk, np.int64))}
            if kind == 0:
                own |= {
                    "doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(held, pa.bool_()), "n_tokens": pa.array(sizes, pa.int64()),
                    "step": pa.array(steps, pa.binary()), "times": pa.array(times, pa.binary()),
                }
            else:
                own |= {"ix": pa.array(np.arange(n, dtype=np.int32)), "token": pa.array([t.decode("utf-8", "replace") for t in names], pa.string()), "tf": pa.array(tf)}
            kinds = {"doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "step": pa.binary(), "times": pa.binary(), "ix": pa.int32(), "token": pa.string(), "tf": pa.int64()}
            yield pa.RecordBatch.from_arrays([own[x] if x in own else pa.nulls(n, kinds[x]) for x in names_], names=names_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, turn = TaskContext.get().partitionId(), 0
        docs, names, used = [], _Numbers({b"": 0}), 0
        for batch in batches:
            for doc_id, text, out in zip(*(c.to_pylist() for c in batch.columns)):
                words = tokens(text)
                docs.append((doc_id, out, np.fromiter(map(names.__getitem__, [*words, b""]), np.int32, len(words) + 1)))
                used += len(text or "") + 16
                if used >= chunk_bytes:
                    yield from rows(docs, names, part << 24 | turn)
                    docs, names, used, turn = [], _Numbers({b"": 0}), 0, turn + 1
        if docs:
            yield from rows(docs, names, part << 24 | turn)

    return run


def _fit(counted: DataFrame, name: str) -> np.ndarray:
    """Weights of the pieces after one round over ``token, c``; the table has each training token once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = pieces(name)
        lattice, total = Lattice(v, v.start), [0.0] * v.size
        for batch in batches:
            for token, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lattice.expect(token, c, total)
        found = np.array(total)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(found[some])], names=["piece", "n"])

    sums = counted.select("token", "c").mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    v = pieces(name)
    weights = v.start * PRIOR
    for r in sums:
        weights[r.piece] += r.n
    return weights / weights.sum()


def _weigh(name: str, weights: np.ndarray):
    """Add each token's log10 probability to ``token, c``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces(name), weights)
        for batch in batches:
            found = np.fromiter(map(lattice.score, batch.column(0).to_pylist()), np.float64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found / math.log(10))], names=["token", "c", "weight"])

    return run


def _total(n_all: int, n_distinct: int):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        ix = words["ix"].to_numpy()
        c, weight = np.zeros(len(ix), np.int64), np.zeros(len(ix))
        c[ix], weight[ix] = words["c"].to_numpy(), words["weight"].to_numpy()
        log_c, log_all = np.log10(c + 1.0), math.log10(n_all + n_distinct + 1)
        known, base, score = [], [], []
        for step, times, n in zip(*(docs[x].to_pylist() for x in ("step", "times", "n_tokens"))):
            at, m = np.cumsum(np.frombuffer(step, np.uint32).astype(np.int64)), np.frombuffer(times, np.uint32).astype(np.int64)
            known.append(int(m[c[at] > 0].sum()))
            base.append(float(m @ log_c[at]) - n * log_all)
            score.append(float(m @ weight[at]))
        rows = len(known)
        columns = [docs["doc_id"], docs["held_out"], docs["n_tokens"], known, np.full(rows, n_all), base, score]
        return pa.table([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def score(docs: DataFrame, vocabulary: str = VOCABULARY, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Training rows are those with ``held_out`` false, a column of ``docs`` beside
    ``doc_id`` and ``text``. A null text is empty: its end is its only token.
    ``base_score`` is the add-one unigram log10 probability of its tokens,
    ``score`` the lattice's. Without training rows nothing is known and the
    weights are the vocabulary's own. Repeated rows are scored each. An empty
    table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.col("held_out").cast("boolean"))
    chunks = cut(docs.mapInArrow(_chunked(chunk_bytes), _CHUNKED), "lm-chunks", "zstd")
    n_chunks, n_rows = chunks.where("kind = 1").agg(F.count_if(F.col("ix") == 0), F.count("*")).first()
    own = chunks.where("kind = 1").select("chunk", "ix", "token", "tf")
    with shuffle_partitions(spark, -(-n_rows // PARTITION_ROWS)):
        counted = cut(own.groupBy("token").agg(F.sum("tf").alias("c")), "lm-tokens", "zstd")
        n_distinct, n_all = counted.where("c > 0").agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
        weights = _fit(counted.where("c > 0"), vocabulary)
        scored = cut(counted.mapInArrow(_weigh(vocabulary, weights), "token string, c long, weight double"), "lm-weights", "zstd")
        words = cut(own.join(scored, "token").select("chunk", "ix", "c", "weight"), "lm-words", "zstd")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_chunks)
    numbered = chunks.where("kind = 0").select("chunk", "doc_id", "held_out", "n_tokens", "step", "times")
    return (
        numbered.repartition(tasks, "chunk")
        .groupBy("chunk")
        .cogroup(words.repartition(tasks, "chunk").groupBy("chunk"))
        .applyInArrow(
            _total(n_all, n_distinct),
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )


def op9_lmscore(spark, sf_dir: str) -> DataFrame:
    """Score every document, learning from those that are not held out."""
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs.select("doc_id", "text", held_out.alias("held_out")))
