import hashlib
import io
import struct
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tallyglass.llm import media as M


@pytest.mark.parametrize("shape", [(1, 1), (5, 7), (8, 64), (3, 66)])
def test_round_trips(shape):
    pixels = np.random.default_rng(0).integers(0, 256, shape).astype(np.uint8)
    for encode in (M.encode_pgm, M.encode_bmp):
        assert (M.decode(encode(pixels)) == pixels).all()


def test_other_forms():
    assert M.decode(b"P2 # c\n2 2\n# d\n15\n0 15\n5 10\n").tolist() == [[0, 255], [85, 170]]
    assert M.decode(b"P3\n1 1\n255\n1 2 3\n").tolist() == [[[1, 2, 3]]]
    assert M.decode(b"P6\n1 1\n255\n\x01\x02\x03").tolist() == [[[1, 2, 3]]]
    assert M.decode(b"P1\n3 1\n1 0 1\n").tolist() == [[0, 255, 0]]
    assert M.decode(b"P4\n3 1\n\xa0").tolist() == [[0, 255, 0]]
    assert M.decode(b"P5\n1 1\n65535\n\xff\xff").tolist() == [[255]]
    bmp = M.encode_bmp(np.full((2, 2), 200, np.uint8))
    few = bytearray(bmp)
    few[46:50] = struct.pack("<I", 100)  # a palette that the pixels go beyond
    empty = M.encode_bmp(np.zeros((0, 0), np.uint8))
    for bad in (b"", b"GIF", b"P5\n9 9\n255\n", b"P5\n1", b"P5\n0 0\n255\n", b"P5\n1 0\n255\n", b"P5\n1 1\n0\na", b"P5\n1 1\n70000\nab", b"P4\n0 1\n", b"BM", bmp[:20], bmp[:60], bmp[:-1], bytes(few), empty):
        with pytest.raises(ValueError):
            M.decode(bad)
    with pytest.raises(ValueError):
        M.area_resize(np.zeros((0, 4), np.uint8))


@pytest.mark.parametrize("shape", [(1, 64), (3, 5), (16, 18), (37, 64)])
def test_area_sums(shape):
    pixels = np.random.default_rng(1).integers(0, 256, shape).astype(np.uint8)
    fine = np.repeat(np.repeat(pixels.astype(np.int64), 8, 0), 9, 1)
    want = fine.reshape(8, shape[0], 9, shape[1]).sum((1, 3))
    assert (M.area_sums(pixels, 8, 9) == want).all()


def test_rows(spark):
    texts = ["", None, "a", "ü" * 31, "x" * 64, "x" * 65, "long " * 100_000, "a", "\x00"]
    docs = spark.createDataFrame([(i if i else None, t, b"z") for i, t in enumerate(texts)], "doc_id long, text string, media binary")
    for form in ("pgm", "bmp", None):
        stored = M.store(docs, form).collect()
        rows = M.features(M.store(docs, form)).collect()
        for t, s, r in zip(texts, stored, rows):
            raw = (t or "").encode()
            payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
            assert (r.doc_id, r.n_bytes, r.payload_bytes) == (s.doc_id, len(raw), len(payload))
            assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])
            assert r.media_bytes == len(s.media) and r.media_sha256 == hashlib.sha256(bytes(s.media)).hexdigest()
            tile = np.load(io.BytesIO(bytes(r.tile)))
            assert tile.shape == (8, 9) and M.difference_hash(tile) == r.feature and len(r.feature) == 16
    assert rows[2].feature == rows[7].feature and M.features(M.store(docs.limit(0))).count() == 0
    none = spark.createDataFrame([(1, 2, None)], "doc_id long, n_bytes long, media binary")
    assert M.features(none).first().feature is None


def slow_hash(payload):
    """The difference hash by plain loops: every pixel's overlap with every cell, as a fraction."""
    height = len(payload) // 64
    shares = lambda n, parts: [[(i, w) for i in range(n) if (w := min(Fraction((p + 1) * n, parts), i + 1) - max(Fraction(p * n, parts), i)) > 0] for p in range(parts)]
    down, across = shares(height, 8), shares(64, 9)
    area = Fraction(height, 8) * Fraction(64, 9)
    cells = [[int(sum(payload[y * 64 + x] * a * b for y, a in ys for x, b in xs) / area + Fraction(1, 2)) for xs in across] for ys in down]
    return f"{int(''.join(str(int(row[x] < row[x + 1])) for row in cells for x in range(8)), 2):016x}"


def test_query(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    out = M.op3_media(spark, d).collect()
    assert len(out) == len(texts)
    for r in out:
        n, pixels = M.payload_pixels(texts[r.doc_id])
        assert r.n_bytes == n and r.payload_sha256 == hashlib.sha256(pixels.tobytes()).hexdigest()
        assert r.media_sha256 in {hashlib.sha256(e(pixels)).hexdigest() for e in (M.encode_pgm, M.encode_bmp)}
        assert M.difference_hash(np.load(io.BytesIO(bytes(r.tile)))) == r.feature
        if n < 4000:
            assert r.feature == slow_hash(pixels.tobytes())
    stored = M.store(spark.read.parquet(f"{d}/documents.parquet")).collect()
    assert {bytes(r.media[:2]) for r in stored} == {b"P5", b"BM"}
    by_text = {}
    assert all(by_text.setdefault(texts[r.doc_id], r.media) == r.media for r in stored)
