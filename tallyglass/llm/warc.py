"""WARC archives as a Spark data source, written and read by tasks.

Writing: every task writes gzip archives of bounded size, one gzip member per
record, under names of its own; only what the driver commits is listed in a
manifest, so retried or lost tasks leave nothing that a reader sees. Each write
adds a manifest of its own and readers take all of them, so writes to one path
add up; a write in overwrite mode names in its manifest those that it replaces, so that
readers see it in one step, and deletes them after that. A member
carries its length in the gzip header ("sl" extra field), so that a reader can
seek past it.

Reading: a partition is a set of files of about ``partition_bytes``. Predicates
on record type and header columns are pushed down; on the digest only where it is
taken from the header (``none``), as a foreign header may lack it or spell it otherwise. Of each member only the first
bytes are inflated, the headers are parsed, and if a predicate fails, or the
payload isn't asked for, the rest is not read: the reader seeks past it.

The option ``payload`` says what is decoded: ``none`` (headers only), ``digest``
(length and digest are taken from the payload itself) or ``bytes``.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, StringStartsWith, WriterCommitMessage

from tallyglass.storage import cut, scratch_path

#: Names of manifests begin so.
MANIFEST = "_manifest"
WRITE_SCHEMA = "page_id long, url string, payload binary, record_type string, refers_to long"
READ_SCHEMA = (
    "page_id long, record_type string, target_uri string, refers_to long, payload_digest string, payload_bytes long, "
    "payload binary, file string, position long"
)
#: Columns that come from headers, on which predicates are pushed down.
HEADER_COLUMNS = ("record_type", "page_id", "target_uri", "refers_to", "payload_digest")
#: Repeated payloads, of 40 bytes each, that are broadcast to the pages.
MOST_BROADCAST = 500_000
_HEAD_BYTES = 2048


def digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _member(data: bytes, level: int) -> bytes:
    """One gzip member that tells its own and its content's length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    total = 10 + 2 + 12 + len(body) + 8
    if max(total, len(data)) >= 1 << 32:  # more than the field can say: its length shows when it is inflated
        return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    extra = b"sl" + struct.pack("<HII", 8, total, len(data))
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _clean(value: str) -> str:
    """A header value; control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, record_type: str, refers_to: int | None, level: int = 6) -> bytes:
    """The gzip member of one response or revisit record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if record_type == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {record_type}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if record_type == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return _member("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n", level)


def _page(urn: str | None) -> int | None:
    name = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name.lstrip("-").isdigit() else None


@dataclass
class _Written(WriterCommitMessage):
    files: list


@dataclass
class _Files(InputPartition):
    paths: list


def _manifests(fs, root: str) -> dict[str, list[str]]:
    """The manifests under ``root`` that count, those that none replaces, and the names of their archives."""
    found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    held = {}
    for x in sorted((x for x in found if x.is_file and x.base_name.startswith(MANIFEST)), key=lambda x: x.path):
        with fs.open_input_stream(x.path) as f:
            held[x.base_name] = json.loads(f.read())
    gone = {name for x in held.values() for name in x["replaces"]}
    return {name: x["files"] for name, x in held.items() if name not in gone}


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool = False):
        self.path, self.overwrite = options["path"], overwrite
        self.most = int(options.get("file_bytes", 64 << 20))
        self.level = int(options.get("level", 6))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        files, out, used = [], None, 0
        for batch in iterator:
            for i in range(batch.num_rows):
                page_id, url, payload, kind, refers = (c[i].as_py() for c in batch.columns)
                if out is None or used >= self.most:
                    if out is not None:
                        out.close()
                    files.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, used = fs.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                used += out.write(data := record(page_id, url, payload or b"", kind, refers, self.level)) or len(data)
        if out is not None:
            out.close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        old = _manifests(fs, root) if self.overwrite else {}
        with fs.open_output_stream(f"{root}/{MANIFEST}-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps({"files": sorted(f for m in messages if m for f in m.files), "replaces": sorted(old)}).encode())
        # from here on readers see this write alone; archives go first, so that what is left after a failure is still named as replaced
        for name in [*(f for files in old.values() for f in files), *old]:
            fs.delete_file(f"{root}/{name}")

    def abort(self, messages: list) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        for m in messages:
            for f in m.files if m else []:
                fs.delete_file(f"{root}/{f}")


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "bytes")
        self.partition_bytes = int(options.get("partition_bytes", 64 << 20))
        if self.payload not in ("none", "digest", "bytes"):
            raise ValueError(f"payload is none, digest or bytes, not {self.payload!r}")
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = ".".join(f.attribute) if hasattr(f, "attribute") else ""
            if name not in HEADER_COLUMNS or (name == "payload_digest" and self.payload != "none"):
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((name, "in", (f.value,)))
            elif isinstance(f, In):
                self.tests.append((name, "in", tuple(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((name, "starts", f.value))
            else:
                yield f

    def partitions(self):
        fs, root = pafs.FileSystem.from_uri(self.path)
        manifests = _manifests(fs, root)
        if manifests:
            infos = fs.get_file_info([f"{root}/{n}" for files in manifests.values() for n in files])
        else:
            infos = [x for x in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if x.path.endswith((".warc.gz", ".warc"))]
        parts, now, used = [], [], 0
        for x in sorted(infos, key=lambda x: x.path):
            if now and used + x.size > self.partition_bytes:
                parts.append(_Files(now))
                now, used = [], 0
            now.append(x.path)
            used += x.size
        return [*parts, _Files(now)] if now else parts or [_Files([])]

    def _wanted(self, row: dict) -> bool:
        for name, kind, value in self.tests:
            x = row[name]
            if x is None or (x not in value if kind == "in" else not str(x).startswith(value)):
                return False
        return True

    def read(self, partition):
        names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
        fs, _ = pafs.FileSystem.from_uri(self.path)
        rows, held = [], 0

        def batch():
            kinds = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary(), "position": pa.int64()}
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names=names)

        for path in partition.paths:
            with fs.open_input_file(path) as f:
                for position, head, rest in _records(_Source(f, _HEADS if self.payload == "none" else _WHOLE), path.endswith(".gz")):
                    row = _row(head) | {"file": path.rsplit("/", 1)[-1], "position": position, "payload": None}
                    if not self._wanted(row):
                        continue
                    if self.payload != "none" and row["record_type"] != "revisit":
                        block = rest()
                        payload = block.partition(b"\r\n\r\n")[2] if head.get("content-type", "").startswith("application/http") else block
                        row |= {"payload_digest": digest(payload), "payload_bytes": len(payload)}
                        if self.payload == "bytes":
                            row["payload"] = payload
                            held += len(payload)
                    rows.append(row)
                    if len(rows) >= 2000 or held > 8 << 20:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()


def _row(head: dict) -> dict:
    size = head.get("x-payload-length")
    return {
        "page_id": _page(head.get("warc-record-id")),
        "record_type": head.get("warc-type"),
        "target_uri": head.get("warc-target-uri"),
        "refers_to": _page(head.get("warc-refers-to")),
        "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "payload_bytes": int(size) if size and size.isdigit() else None,
    }


#: Bytes that are read ahead: where only headers are wanted, and where payloads are.
_HEADS, _WHOLE = 8 << 10, 1 << 20


class _Source:
    """A reader that goes forward and can look ahead; what is skipped beyond that is not read."""

    def __init__(self, f, ahead: int = _WHOLE):
        self.f, self.ahead, self.data, self.at, self.position = f, ahead, b"", 0, 0

    def peek(self, n: int) -> memoryview:
        missing = n - (len(self.data) - self.at)
        if missing > 0:
            self.data = self.data[self.at :] + self.f.read(max(missing, self.ahead))
            self.at = 0
        return memoryview(self.data)[self.at : self.at + n]

    def skip(self, n: int) -> None:
        self.position += n
        self.at += n
        if self.at > len(self.data):
            self.f.seek(self.position)
            self.data, self.at = b"", 0


def _headers(raw: bytes) -> dict:
    """Header names in lower case; a folded line belongs to the one before."""
    out: dict[str, str] = {}
    last = None
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] = f"{out[last]} {line.strip()}".strip()
        elif ":" in line:
            last, _, value = line.partition(":")
            last = last.strip().lower()
            out[last] = value.strip()
    return out


def _records(source: _Source, packed: bool):
    """``position, headers, rest`` of each record; ``rest()`` decodes the block and may be left uncalled."""
    while len(source.peek(1)):
        position = source.position
        if not packed:
            n = _HEAD_BYTES
            while (end := bytes(source.peek(n)).find(b"\r\n\r\n")) < 0:
                if len(source.peek(n)) < n:
                    if bytes(source.peek(n)).strip():
                        raise ValueError("a WARC header ends early")
                    return
                n *= 2
            head = _headers(bytes(source.peek(end)))
            size = int(head.get("content-length", 0))
            yield position, head, lambda: bytes(source.peek(end + 4 + size)[end + 4 :])  # noqa: B023
            source.skip(end + 4 + size + 4)
            continue
        start = bytes(source.peek(24))
        if start[:2] != b"\x1f\x8b":
            raise ValueError("not a gzip member")
        known = struct.unpack("<I", start[16:20])[0] if start[3] == 4 and start[12:14] == b"sl" else None
        if known:
            piece = source.peek(min(known, _HEAD_BYTES))
            inflate = zlib.decompressobj(31)
            raw = inflate.decompress(piece, 1 << 16)
            if b"\r\n\r\n" not in raw:
                raw = zlib.decompressobj(31).decompress(source.peek(known))
        else:  # a foreign member: its length is only known once it is inflated
            inflate, used, parts = zlib.decompressobj(31), 0, []
            while not inflate.eof:
                piece = source.peek(used + (1 << 16))[used:]
                if not len(piece):
                    raise ValueError("a gzip member ends early")
                parts.append(inflate.decompress(piece))
                used += len(piece)
            raw, known = b"".join(parts), used - len(inflate.unused_data)
        end = raw.find(b"\r\n\r\n")
        if end < 0:
            raise ValueError("a WARC header ends early")
        head = _headers(raw[:end])
        size = int(head.get("content-length", 0))

        def rest(raw=raw, end=end, size=size, known=known) -> bytes:
            whole = raw if len(raw) >= end + 4 + size else zlib.decompressobj(31).decompress(source.peek(known))
            return whole[end + 4 : end + 4 + size]

        yield position, head, rest
        source.skip(known)


class WarcDataSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options), overwrite)


def read_warc(spark: SparkSession, path: str, payload: str = "bytes", **options: str) -> DataFrame:
    """The records under ``path``: those of its manifests, or all ``.warc`` and ``.warc.gz`` files.

    Spark keeps pushed predicates with the loaded DataFrame, so each set of
    predicates needs a load of its own.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").options(payload=payload, **options).load(path)


def write_warc(records: DataFrame, path: str, mode: str = "append", **options: str) -> None:
    """Write ``page_id, url, payload, record_type, refers_to`` as archives under ``path``.

    Records are added to those of earlier writes (``mode="overwrite"`` replaces
    them). A null url gives no target header, a null payload an empty one; null
    ids are written as such; repeated rows are records each, and no rows leave an
    empty manifest. Other columns are ignored.
    """
    records.sparkSession.dataSource.register(WarcDataSource)
    columns = [F.col(x.split()[0]).cast(x.split()[1]).alias(x.split()[0]) for x in WRITE_SCHEMA.split(", ")]
    records.select(*columns).write.format("warc").options(**options).mode(mode).save(path)


def deduplicated(pages: DataFrame, least_bytes: int = 0, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """Rows of ``pages`` as records: of equal payloads the smallest page_id is a response, others revisit it.

    A null html is an empty payload. Payloads under ``least_bytes`` are all
    responses. Repeated rows of the smallest page_id are responses each; where
    no row of a payload has a page_id, all are. An empty table gives no rows.

    Only digests and ids are shuffled to find payloads that repeat. Where these
    are at most ``most_broadcast`` (counted first) they are broadcast to the
    rows; beyond that rows are joined by a shuffle, with the same result.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    ).withColumn("same", F.unhex(F.sha2("payload", 256)))
    shared = rows.where(F.length("payload") >= least_bytes).groupBy("same").agg(F.min("page_id").alias("least"), F.count("*").alias("n")).where("n > 1 and least is not null")
    shared = cut(shared.select("same", "least"), "warc-shared")
    if shared.count() <= most_broadcast:
        shared = F.broadcast(shared)
    found = rows.join(shared, "same", "left")
    again = F.col("least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least"))
    return found.select(
        "page_id", "url", "payload", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("least")).alias("refers_to")
    )


def op7_warc(spark, sf_dir: str) -> DataFrame:
    """Write a record for every page, then read the archives back."""
    path = scratch_path(spark, "warc")
    write_warc(deduplicated(spark.read.parquet(f"{sf_dir}/pages.parquet")), path, level="4")
    found = read_warc(spark, path, payload="digest").where(F.col("record_type").isin("response", "revisit"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS least, count(*) AS n FROM p GROUP BY h),
g AS (SELECT p.*, least, list_transform(range(8), lambda i: CAST('0x' || substr(p.h, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT)) AS five FROM p JOIN f USING (h))
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(five, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v // 32768) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v // 1024) % 32 + 1, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v // 32) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v % 32 + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> least THEN least END AS refers_to FROM g
"""
