"""Data sources for what filings arrive in: tables inside zip archives, and a folder of daily indexes as a stream.

``ziptable`` reads a tab-separated member of zip archives. A partition is a range of
bytes of the member's content, so a large member is read by several tasks, each
of which holds one block of it at a time. A line belongs to the range that its
first byte lies in. A stored member is sought in; of a packed one the content
before the range is inflated and thrown away, which is cheap beside the parsing. Only
the columns of the given schema are made, and equality on them is tested first:
what the predicates leave out never becomes a row.

``dayindex`` is a stream of lines of index files, one for each day. Its offset is the
last day that is done with, so a restart goes on from there.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import posixpath
import struct
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, In, InputPartition, IsNotNull
from pyspark.sql.types import StructType

#: Bytes of a member's content for a task, and of it in memory at a time.
PARTITION_BYTES, BLOCK_BYTES = 64 << 20, 4 << 20


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _listed(path: str) -> tuple[pafs.FileSystem, list[str]]:
    """The files that ``path`` names: one, those of a folder, or those whose name fits a glob in its last part."""
    fs, at = _open(path)
    folder, name = posixpath.split(at)
    if any(c in name for c in "*?["):
        found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        return fs, sorted(x.path for x in found if x.is_file and fnmatch.fnmatchcase(x.base_name, name))
    info = fs.get_file_info(at)
    if info.type == pafs.FileType.Directory:
        return fs, sorted(x.path for x in fs.get_file_info(pafs.FileSelector(at)) if x.is_file and x.base_name.endswith(".zip"))
    return fs, [at] if info.is_file else []


@dataclass
class _Range(InputPartition):
    path: str
    start: int
    stop: int


class Member:
    """The content of a member of a zip archive as a file: stored ones are sought in, of packed ones what is passed over is inflated and thrown away."""

    def __init__(self, f, info: zipfile.ZipInfo):
        if info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
            raise ValueError(f"{info.filename} is packed in a way other than deflate")
        f.seek(info.header_offset + 26)
        name, extra = struct.unpack("<HH", f.read(4))
        self.f, self.info, self.first = f, info, info.header_offset + 30 + name + extra
        self._restart()

    def _restart(self) -> None:
        self.data, self.at, self.taken = b"", 0, 0  # taken: bytes of the archive
        self.inflate = zlib.decompressobj(-15) if self.info.compress_type == zipfile.ZIP_DEFLATED else None
        self.f.seek(self.first)

    def _more(self) -> bytes:
        """The next piece of the content, nothing at its end."""
        while self.taken < self.info.compress_size:
            raw = self.f.read(min(1 << 20, self.info.compress_size - self.taken))
            if not raw:
                raise EOFError(f"{self.info.filename} ends early")
            self.taken += len(raw)
            piece = self.inflate.decompress(raw) if self.inflate else raw
            if piece:
                return piece
        return b""

    def tell(self) -> int:
        return self.at

    def seek(self, at: int) -> None:
        if at < self.at or not self.inflate:
            self._restart()
        if not self.inflate:
            self.at = self.taken = at
            self.f.seek(self.first + at)
            return
        while self.at + len(self.data) < at:
            self.at += len(self.data)
            self.data = self._more()
            if not self.data:
                return
        self.data, self.at = self.data[at - self.at :], at

    def read(self, n: int) -> bytes:
        parts, have = [self.data], len(self.data)
        while have < n and (piece := self._more()):
            parts.append(piece)
            have += len(piece)
        whole = b"".join(parts)
        self.data, self.at = whole[n:], self.at + min(n, have)
        return whole[:n]

    def readline(self) -> bytes:
        parts, piece = [], self.data or self._more()
        while piece and b"\n" not in piece:
            parts.append(piece)
            piece = self._more()
        end = piece.find(b"\n") + 1
        line = b"".join([*parts, piece[:end]])
        self.data, self.at = piece[end:], self.at + len(line)
        return line


def lines_of(member, start: int, stop: int, block: int = BLOCK_BYTES) -> Iterator[list[str]]:
    """The lines whose first byte lies in a range of a seekable file, in lists of about ``block`` bytes.

    Bytes that are no UTF-8 become replacement characters, carriage returns are dropped.
    """
    if start:
        member.seek(start - 1)
        start += len(member.readline()) - 1  # to the first line that begins at or after it
    else:
        member.seek(0)
    at, rest = start, b""
    while at < stop:
        data = member.read(min(block, stop - at))
        if not data:
            break
        at += len(data)
        if at >= stop and not data.endswith(b"\n"):
            data += member.readline()  # the last line may end beyond the range
        data = rest + data
        cut = data.rfind(b"\n") + 1 or (0 if at < stop else len(data))
        data, rest = data[:cut], data[cut:]
        if data:
            yield data.decode("utf-8", "replace").replace("\r", "").removesuffix("\n").split("\n")
    if rest:
        yield [rest.decode("utf-8", "replace").replace("\r", "")]


def cells(lines: Sequence[str], header: Sequence[str], columns: Sequence[str], wanted: dict[str, Sequence[str]]) -> pa.RecordBatch:
    """The columns of tab-separated lines without quoting, of rows that have one of the ``wanted`` values in each column named there.

    A missing column or cell is empty; blank lines are left out.
    """
    text = pa.array(lines, pa.string())
    text = text.filter(pc.not_equal(pc.utf8_trim_whitespace(text), ""))
    split = pc.split_pattern(text, "\t")
    place = {n: i for i, n in reversed(list(enumerate(header)))}

    def column(name: str) -> pa.Array:
        if name not in place:
            return pa.array([""] * len(split), pa.string())
        starts, lengths = split.offsets[:-1].cast(pa.int64()), pc.list_value_length(split)
        at = pc.if_else(pc.greater(lengths, place[name]), pc.add(starts, place[name]), pa.scalar(None, pa.int64()))
        return pc.fill_null(split.values.take(at), "")

    for name, values in wanted.items():
        keep = pc.is_in(column(name), pa.array(values, pa.string()))
        text = text.filter(keep)
        split = pc.split_pattern(text, "\t")
    return pa.RecordBatch.from_arrays([column(c) for c in columns], names=list(columns))


class _ZipReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.columns = schema.names
        self.path, self.member = options["path"], options["member"]
        self.size = int(options.get("partition_bytes", PARTITION_BYTES))
        self.wanted: dict[str, list[str]] = {}

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name in self.columns and name not in self.wanted:
                self.wanted[name] = [v for v in (f.value if isinstance(f, In) else [f.value]) if v is not None]
            elif not (isinstance(f, IsNotNull) and f.attribute[0] in self.columns):  # cells are never null
                yield f

    def partitions(self) -> list[_Range]:
        fs, paths = _listed(self.path)
        found = []
        for path in paths:
            with fs.open_input_file(path) as f, zipfile.ZipFile(f) as z:
                if self.member in z.NameToInfo:
                    n = z.getinfo(self.member).file_size
                    found += [_Range(path, at, min(n, at + self.size)) for at in range(0, n, self.size)]
        return found or [_Range("", 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = _open(self.path)
        with fs.open_input_file(partition.path) as f, zipfile.ZipFile(f) as z:
            member = Member(f, z.getinfo(self.member))
            header = member.readline().decode("utf-8", "replace").replace("\r", "").removesuffix("\n").split("\t")
            first = member.tell()
            for lines in lines_of(member, max(partition.start, first), partition.stop):
                yield cells(lines, header, self.columns, self.wanted)


class ZipTable(DataSource):
    """``spark.read.format("ziptable").schema(...).option("member", ...).load(path)``."""

    @classmethod
    def name(cls) -> str:
        return "ziptable"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _ZipReader(schema, self.options)


def zip_table(spark: SparkSession, path: str, member: str, columns: Sequence[str], partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """Strings of the named ``columns`` of a tab-separated member of the zip archives at ``path`` (one, a folder, or a glob in its last part).

    Archives without the member, and missing columns or cells, are as empty ones; lines keep their order. Equality is tested by
    the tasks that read.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ZipTable)
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.format("ziptable").schema(schema).option("member", member).option("partition_bytes", partition_bytes).load(path)


def last_ready_day(indexed: set[dt.date], start: dt.date, today: dt.date) -> dt.date:
    """The last day up to which all from ``start`` on is known (at least the day before that): a weekday without an index is a holiday, unless it lies within two days of ``today``; then it and all after it wait."""
    for day in (today - dt.timedelta(days=n) for n in (2, 1, 0)):
        if day >= start and day.weekday() < 5 and day not in indexed:
            return day - dt.timedelta(days=1)
    return max(today, start - dt.timedelta(days=1))


@dataclass
class _Day(InputPartition):
    day: dt.date
    path: str


class _TailReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.start = options["path"], options["start"]
        self.today, self.pattern = options.get("today"), options.get("pattern", "form.%Y%m%d.idx")

    def _days(self) -> dict[dt.date, str]:
        fs, at = _open(self.path)
        days = {}
        for x in fs.get_file_info(pafs.FileSelector(at, recursive=True, allow_not_found=True)):
            try:
                day = dt.datetime.strptime(x.base_name, self.pattern).date()
            except ValueError:
                continue
            if x.is_file and day.weekday() < 5:
                days[day] = x.path
        return days

    def initialOffset(self) -> dict:
        return {"day": str(dt.date.fromisoformat(self.start) - dt.timedelta(days=1))}

    def latestOffset(self) -> dict:
        today = dt.date.fromisoformat(self.today) if self.today else dt.datetime.now(dt.UTC).date()
        return {"day": str(last_ready_day(set(self._days()), dt.date.fromisoformat(self.start), today))}

    def partitions(self, start: dict, end: dict) -> list[_Day]:
        return [_Day(d, p) for d, p in sorted(self._days().items()) if start["day"] < str(d) <= end["day"]]

    def read(self, partition: _Day) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(self.path)
        with fs.open_input_file(partition.path) as f:
            for lines in lines_of(f, 0, 1 << 62):
                lines = [x for x in lines if x.startswith("4")]  # the forms that count begin so
                yield pa.RecordBatch.from_arrays([pa.array([partition.day] * len(lines), pa.date32()), pa.array(lines, pa.string())], names=["day", "value"])


class DayIndex(DataSource):
    """``spark.readStream.format("dayindex").option("start", "2024-01-01").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "dayindex"

    def schema(self) -> str:
        return "day date, value string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _TailReader(self.options)


def daily_tail(spark: SparkSession, folder: str, start: str, today: str | None = None, pattern: str = "form.%Y%m%d.idx") -> DataFrame:
    """A stream of ``day, value``: lines for forms of the daily indexes under ``folder`` (named by ``pattern``) from ``start`` to ``today``.

    Days that are not ready wait, see ``last_ready_day``. A day is wholly in one
    batch; the checkpoint has the last day, so a restart reads none twice and leaves none out.
    """
    spark.dataSource.register(DayIndex)
    reader = spark.readStream.format("dayindex").option("start", start).option("pattern", pattern)
    return (reader.option("today", today) if today else reader).load(folder)
