"""Media columns: Netpbm and BMP images as numpy arrays, area-resized tiles and difference hashes.

Images travel as binary columns. Decoding gives uint8 arrays of (height, width)
or (height, width, 3); resizing averages exact areas with an integral image, in
whole numbers, so results do not depend on rounding; tiles are written as NPY.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.storage import cut

WIDTH = 64
TILE_HEIGHT, TILE_WIDTH = 8, 9
_TOKEN = re.compile(rb"(?:\s|#[^\n]*\n)*([^\s#]+)")


def encode_pgm(pixels: np.ndarray) -> bytes:
    """A binary PGM (P5, 8 bits) of a (height, width) array."""
    return b"P5\n%d %d\n255\n" % (pixels.shape[1], pixels.shape[0]) + np.ascontiguousarray(pixels, np.uint8).tobytes()


def encode_bmp(pixels: np.ndarray) -> bytes:
    """An uncompressed 8-bit grey BMP of a (height, width) array."""
    height, width = pixels.shape
    rows = np.zeros((height, -(-width // 4) * 4), np.uint8)
    rows[:, :width] = pixels[::-1]
    palette = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 4, 1)
    palette[:, 3] = 0
    head = 14 + 40 + 1024
    return struct.pack("<2sIHHIIiiHHIIiiII", b"BM", head + rows.size, 0, 0, head, 40, width, height, 1, 8, 0, rows.size, 2835, 2835, 256, 0) + palette.tobytes() + rows.tobytes()


def _netpbm(data: bytes) -> np.ndarray:
    kind, at, numbers = data[:2], 2, []
    want = 2 if kind in (b"P1", b"P4") else 3
    while len(numbers) < want:
        m = _TOKEN.match(data, at)
        if not m:
            raise ValueError("a Netpbm header ends early")
        numbers.append(int(m[1]))
        at = m.end()
    width, height = numbers[:2]
    most = numbers[2] if want == 3 else 1
    if not width or not height or not 0 < most < 65536:
        raise ValueError("a Netpbm image without pixels, or of a depth that is none")
    colours = 3 if kind in (b"P3", b"P6") else 1
    n = width * height * colours
    if kind == b"P4":
        bits = np.frombuffer(data, np.uint8, -(-width // 8) * height, at + 1).reshape(height, -1)
        return (1 - np.unpackbits(bits, axis=1)[:, :width]) * np.uint8(255)
    if kind in (b"P5", b"P6"):
        values = np.frombuffer(data, np.uint8 if most < 256 else ">u2", n, at + 1)
    elif kind == b"P1":
        values = 1 - np.frombuffer(re.sub(rb"#[^\n]*\n|\s", b"", data[at:])[:n], np.uint8) + 48
    else:
        values = np.array(re.sub(rb"#[^\n]*\n", b" ", data[at:]).split()[:n], np.int64)
    if len(values) < n:
        raise ValueError("a Netpbm image ends early")
    if most != 255:
        values = (values.astype(np.int64) * 255 + most // 2) // most
    return values.astype(np.uint8).reshape((height, width, 3) if colours == 3 else (height, width))


def _bmp(data: bytes) -> np.ndarray:
    if len(data) < 54:
        raise ValueError("a BMP header ends early")
    start, header, width, height = struct.unpack_from("<I", data, 10) + struct.unpack_from("<Iii", data, 14)
    bits, packing = struct.unpack_from("<HI", data, 28)
    if width <= 0 or not height:
        raise ValueError("a BMP without pixels")
    if packing or bits not in (8, 24, 32):
        raise ValueError("only uncompressed BMP of 8, 24 or 32 bits is read")
    stride = -(-width * bits // 32) * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(height), start).reshape(abs(height), stride)
    if height > 0:
        rows = rows[::-1]
    if bits > 8:
        return rows[:, : width * bits // 8].reshape(abs(height), width, bits // 8)[:, :, 2::-1].copy()
    used = struct.unpack_from("<I", data, 46)[0] or 256
    palette = np.frombuffer(data, np.uint8, used * 4, 14 + header).reshape(used, 4)[:, 2::-1]
    if rows[:, :width].max() >= used:
        raise ValueError("a BMP pixel is beyond the palette")
    pixels = palette[rows[:, :width]]
    return pixels[:, :, 0].copy() if (pixels == pixels[:, :, :1]).all() else pixels


def decode(data: bytes) -> np.ndarray:
    """Pixels of a Netpbm (P1 to P6) or BMP image; other bytes, and images cut short or without pixels, raise ValueError."""
    if data[:1] == b"P" and data[1:2] in b"123456" and len(data) > 2:
        return _netpbm(data)
    if data[:2] == b"BM":
        return _bmp(data)
    raise ValueError("neither Netpbm nor BMP")


def area_sums(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """Exact sums over a height x width grid of equal areas, times height * width.

    Pixels on a border count in part. The integral image is read at fractions of
    a pixel by linear steps, scaled to whole numbers.
    """
    def borders(n: int, parts: int):
        at = np.arange(parts + 1, dtype=np.int64) * n
        whole = at // parts
        return whole, at % parts, np.minimum(whole + 1, n)

    y, fy, y1 = borders(pixels.shape[0], height)
    x, fx, x1 = borders(pixels.shape[1], width)
    # sums down the columns are needed at few rows only
    column = np.zeros((pixels.shape[0] + 1, pixels.shape[1]), np.int64)
    np.cumsum(pixels, axis=0, out=column[1:], dtype=np.int64)
    at_y = column[y] * (height - fy)[:, None] + column[y1] * fy[:, None]
    row = np.zeros((height + 1, pixels.shape[1] + 1), np.int64)
    np.cumsum(at_y, axis=1, out=row[:, 1:])
    at = row[:, x] * (width - fx) + row[:, x1] * fx
    return np.diff(np.diff(at, axis=0), axis=1)


def area_resize(pixels: np.ndarray, height: int = TILE_HEIGHT, width: int = TILE_WIDTH) -> np.ndarray:
    """The mean of each area, rounded half up, as uint8. Colours are averaged to grey first; there must be a pixel."""
    if not pixels.size:
        raise ValueError("an image without pixels")
    if pixels.ndim == 3:
        pixels = (pixels.astype(np.int64).sum(2) + 1) // 3
    n = pixels.shape[0] * pixels.shape[1]
    return ((2 * area_sums(pixels, height, width) + n) // (2 * n)).astype(np.uint8)


def difference_hash(tile: np.ndarray) -> str:
    """64 bits, row by row: set where a cell is darker than the one to its right."""
    return np.packbits(tile[:, :-1] < tile[:, 1:]).tobytes().hex()


def npy(tile: np.ndarray) -> bytes:
    """The tile in NPY format."""
    out = io.BytesIO()
    np.save(out, tile, allow_pickle=False)
    return out.getvalue()


def payload_pixels(text: str | None) -> tuple[int, np.ndarray]:
    """Bytes of the UTF-8 text, and these bytes, padded by 0 to a positive multiple of 64, as rows of 64 pixels."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    size = max(1, -(-len(raw) // WIDTH)) * WIDTH
    return len(raw), np.frombuffer(raw.ljust(size, b"\0"), np.uint8).reshape(-1, WIDTH)


def store(docs: DataFrame, form: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, media``: every text as an 8-bit image, a PGM ("pgm") or BMP ("bmp").

    Without ``form`` the text decides: by a bit of its CRC-32 half of the texts
    become the one, half the other, equal texts the same. A null text is stored
    like an empty one, as one row of zeros. Rows are kept one for one, repeated
    or not; an empty table gives no rows; other columns are ignored.
    """
    encoders = {"pgm": (encode_pgm,) * 2, "bmp": (encode_bmp,) * 2, None: (encode_pgm, encode_bmp)}[form]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 512):
                own = batch.slice(part, 512)
                sizes, images = [], []
                for text in own.column(1).to_pylist():
                    n, pixels = payload_pixels(text)
                    sizes.append(n)
                    images.append(encoders[zlib.crc32(pixels) & 1](pixels))
                yield pa.RecordBatch.from_arrays([own.column(0), pa.array(sizes, pa.int64()), pa.array(images, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def features(media: DataFrame) -> DataFrame:
    """Decode a ``media`` column: its row's ``doc_id, n_bytes`` and what the image holds.

    ``payload_bytes, payload_sha256, tail_crc32`` are of the pixels, ``media_bytes,
    media_sha256`` of the stored form, ``feature`` is the difference hash and
    ``tile`` the resized image as NPY. A null image gives nulls; bytes that are no
    image, or one without pixels, raise ValueError. Rows are kept one for one,
    repeated or not; an empty table gives no rows; other columns are ignored.
    """
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "tile"]

    def one(data: bytes | None):
        if data is None:
            return (None,) * 7
        pixels = decode(data)
        raw, tile = pixels.tobytes(), area_resize(pixels)
        return len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-64:]), len(data), hashlib.sha256(data).hexdigest(), difference_hash(tile), npy(tile)

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(x.as_py()) for x in batch.column(2)]
            columns = [pa.array([x[i] for x in found], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile binary"
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)


def op3_media(spark, sf_dir: str) -> DataFrame:
    """Store every text as an image, read the images back and compute their features; ``tile`` is the resized image as NPY."""
    stored = cut(store(spark.read.parquet(f"{sf_dir}/documents.parquet")), "media", "zstd")
    return features(stored)
