import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyglass.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


ODD = [
    None, "", " ", "a", " a  b\n\nc ", "x\ty\r\nz", "don't 'll stop.  Now!", "tab\x1funit\x1c x", "über\xa0alles z 日本語。 ok",
    "<|endoftext|> a", "12 345 ½² a_b", "no\n next", "\nlead", "trail\n", "w" * 5000, "a b. " * 3000, "́x \U0001f600‍", "\x00 \x85 q",
]


def test_ids_equal_the_tokenizer(tokenizer):
    encoder = P.Encoder(P.VOCABULARY)
    for texts in (ODD, ODD[::-1], [t for t in ODD for _ in range(2)]):
        ids, size, _ = encoder.encode(texts)
        stop = np.cumsum(size)
        for t, a, b in zip(texts, stop - size, stop):
            assert ids[a:b].tolist() == [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], t


def slow_cost(at, penalty, window):
    f = [0]
    for j in range(1, len(at)):
        f.append(min(f[i] + (0 if (n := at[j] - at[i]) & (n - 1) == 0 else window - n) for i in range(j) if at[j] - at[i] <= window) + penalty[j] + P.WINDOW_COST)
    return f[-1]


def test_cuts_are_optimal():
    r = np.random.default_rng(3)
    for _ in range(60):
        at = np.unique(np.concatenate([[0], r.integers(1, 400, r.integers(20, 80)), np.arange(0, 400, 25)]))
        penalty = r.integers(0, 9, len(at))
        ends = P.best_cuts(at, penalty, 32)
        begin = np.concatenate([[0], ends[:-1]])
        n = ends - begin
        cost = sum(penalty[np.searchsorted(at, e)] + P.WINDOW_COST for e in ends) + sum(0 if x & (x - 1) == 0 else 32 - x for x in n.tolist())
        assert n.max() <= 32 and cost == slow_cost(at.tolist(), penalty.tolist(), 32)


def verify(rows, texts, tokenizer):
    """rows: pieces; texts: list of (doc_id, text). Every id in one piece, sequences gapless."""
    want = sorted(((i is None, i or 0), zlib.crc32(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], np.uint32)), t) for i, t in texts)
    ids = defaultdict(list)
    for i, t in texts:
        ids[i].append(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], np.uint32))
    seqs, total = defaultdict(list), 0
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        total += r.length
        assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length]) == r.ids_crc32 for x in ids[r.doc_id])
    assert total == sum(len(x) for v in ids.values() for x in v) and len(want) == len(texts)
    padded = 0
    for pieces in seqs.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
        padded += 0 if at & (at - 1) == 0 else 1024 - at
    return padded, total


def test_edge_rows(spark, tokenizer):
    texts = [(i if i % 5 else None, t) for i, t in enumerate(ODD)] + [(3, "a"), (3, "a"), (3, "b")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, shard int")
    verify(P.pack(docs).collect(), texts, tokenizer)
    assert P.pack(docs.limit(0)).count() == 0


def test_query(spark, tokenizer):
    d = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    padded, total = verify(P.op4_packing(spark, d).collect(), texts, tokenizer)
    assert padded < 0.02 * total


def test_speed_path_on_whole_texts(tokenizer, spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300).collect()]
    encoder = P.Encoder(P.VOCABULARY, most=20_000)
    for i in range(0, 300, 60):
        ids, size, _ = encoder.encode(texts[i : i + 60])
        assert ids.tolist() == [x for t in texts[i : i + 60] for x in [*tokenizer.encode(t, add_special_tokens=False).ids, 0]]


@pytest.mark.parametrize("held", [1, 40, 3000])
def test_held_pieces_give_the_whole_stream(spark, held):
    r = np.random.default_rng(4)
    texts = [(i, " ".join("word. " if x % 9 == 0 else "wörd" * (x % 4 + 1) for x in r.integers(0, 40, r.integers(0, 900)))) for i in range(120)]
    docs = spark.createDataFrame(texts + [(500, "long " * 40_000), (501, None)], "doc_id long, text string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(P.pack(docs, held_chars=held)) == rows(P.pack(docs, held_chars=10**12))
