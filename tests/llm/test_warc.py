import gzip
import random

import pytest

from tallyglass.llm import warc as W


def brute(rows):
    least = {}
    for i, _, h in rows:
        if i is not None:
            least[h or ""] = min(i, least.get(h or "", i))
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        first = least.get(h or "")
        again = first is not None and i != first
        out.append((i, len(raw), W.digest(raw), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


ROWS = [
    (9, "http://a/", "x" * 3000), (3, "http://b/", "x" * 3000), (3, "http://b/", "x" * 3000), (5, None, None), (4, "u\r\nv", ""), (None, "http://c/", "solo"),
    (None, "http://d/", "solo"), (None, "http://e/", ""), (8, "http://ü/", "é\r\n\r\nü"), (-1, "http://long/", "long " * 400_000), (7, "http://" + "q" * 9000, "\0"),
]


def test_round_trip_and_pushdown(spark, tmp_path):
    pages = spark.createDataFrame([(*r, 1) for r in ROWS], "page_id long, url string, html string, same int")
    path = f"file://{tmp_path}/a"
    W.write_warc(W.deduplicated(pages), path, file_bytes="2000")
    load = lambda: W.read_warc(spark, path, partition_bytes="4000")
    found = load()
    assert found.rdd.getNumPartitions() > 1
    rows = found.collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str) == brute(ROWS)
    texts = {r[2] or "" for r in ROWS}
    assert all(bytes(r.payload).decode() in texts if r.record_type == "response" else r.payload is None for r in rows)
    assert {r.target_uri for r in rows} == {r[1] and r[1].replace("\r\n", "%0D%0A") for r in ROWS}
    some = load().where("record_type = 'revisit' and target_uri like 'http://%'")
    assert {r.page_id for r in some.collect()} == {9, None} and len(some.collect()) == 2
    assert load().where("page_id in (8, 3) and payload_bytes > 7").count() == 3
    assert all(r.payload is None for r in W.read_warc(spark, path, "none").collect())
    assert sorted(W.read_warc(spark, path, "digest").select("page_id", "payload_digest").collect(), key=str) == sorted(load().select("page_id", "payload_digest").collect(), key=str)
    (tmp_path / "a" / "lost.warc.gz").write_bytes(b"not committed")
    assert load().count() == len(ROWS)
    W.write_warc(W.deduplicated(pages.limit(0)), f"{path}0")
    assert W.read_warc(spark, f"{path}0").count() == 0


def test_least_bytes(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    assert [r.record_type for r in W.deduplicated(pages, 3).orderBy("page_id").collect()] == ["response"] * 3 + ["revisit"]


@pytest.mark.parametrize("packed", [True, False])
def test_foreign_archives(spark, tmp_path, packed):
    def rec(kind, body):
        return b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Target-URI:\r\n http://x/\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (kind, len(body), body)

    records = [rec(b"warcinfo", b"i" * 5000), rec(b"resource", b"body\r\n\r\nrest" * 20_000), rec(b"metadata", b"")]
    (tmp_path / ("x.warc" + ".gz" * packed)).write_bytes(b"".join(gzip.compress(r) if packed else r for r in records))
    out = W.read_warc(spark, f"file://{tmp_path}").orderBy("position").collect()
    assert [(r.record_type, r.payload_bytes, r.target_uri) for r in out] == [("warcinfo", 5000, "http://x/"), ("resource", 240_000, "http://x/"), ("metadata", 0, "http://x/")]
    (tmp_path / "y.warc.gz").write_bytes(b"\x1f\x8b" + b"\0" * 30)
    with pytest.raises(Exception):
        W.read_warc(spark, f"file://{tmp_path}").count()


def test_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{d}/pages.parquet").collect()]
    assert sorted(map(tuple, W.op7_warc(spark, d).collect()), key=str) == brute(rows)


def test_writes_add_up_unless_they_overwrite(spark, tmp_path):
    path = f"file://{tmp_path}/a"
    page = lambda i: W.deduplicated(spark.createDataFrame([(i, "u", f"text {i}")], "page_id long, url string, html string"))
    ids = lambda: sorted(r.page_id for r in W.read_warc(spark, path).collect())
    W.write_warc(page(1), path)
    W.write_warc(page(2), path)
    assert ids() == [1, 2]
    W.write_warc(page(3), path, mode="overwrite")
    assert ids() == [3] and len(list((tmp_path / "a").glob("*.warc.gz"))) == 1
    W.write_warc(page(1), path)
    assert ids() == [1, 3]


def test_digest_of_headers_that_lack_or_misspell_it(spark, tmp_path):
    def rec(name, more):
        return b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:%d>\r\n%sContent-Length: 4\r\n\r\nbody\r\n\r\n" % (name, more)

    d = W.digest(b"body")
    (tmp_path / "x.warc").write_bytes(rec(1, b"") + rec(2, b"WARC-Payload-Digest: sha1:" + d.lower().encode() + b"\r\n") + rec(3, b"WARC-Payload-Digest: sha1:" + d.encode() + b"\r\n"))
    asked = lambda payload: sorted(r.page_id for r in W.read_warc(spark, f"file://{tmp_path}", payload).where(f"payload_digest = '{d}'").collect())
    assert asked("digest") == asked("bytes") == [1, 2, 3] and asked("none") == [3]


def test_broadcast_and_shuffle_agree(spark):
    pages = spark.createDataFrame([(*r, 1) for r in ROWS], "page_id long, url string, html string, least int")
    a, b = (sorted(map(tuple, W.deduplicated(pages, most_broadcast=n).collect()), key=str) for n in (0, 100))
    assert a == b and W.deduplicated(pages.limit(0)).count() == 0


class Counted:
    """A file that counts the bytes read from it."""

    def __init__(self, path):
        self.f, self.n = open(path, "rb"), 0

    def read(self, n):
        data = self.f.read(n)
        self.n += len(data)
        return data

    def seek(self, at):
        self.f.seek(at)


def test_headers_cost_no_payload_bytes(tmp_path):
    r = random.Random(1)
    path, sizes = tmp_path / "a.warc.gz", [0, 10, 300_000, 5, 2_000_000, 70_000, 1]
    path.write_bytes(b"".join(W.record(i, f"http://x/{i}", r.randbytes(n), "response", None) for i, n in enumerate(sizes)))
    plain = tmp_path / "b.warc"
    plain.write_bytes(gzip.decompress(path.read_bytes()))
    for p, packed in ((path, True), (plain, False)):
        f = Counted(p)
        found = [(h["warc-record-id"], at) for at, h, _ in W._records(W._Source(f, W._HEADS), packed)]
        assert [x for x, _ in found] == [f"<urn:page:{i}>" for i in range(len(sizes))] and f.n < 100_000 < p.stat().st_size / 20
        whole = Counted(p)
        assert [len(rest()) for _, _, rest in W._records(W._Source(whole), packed)] == [n + len(f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n") for n in sizes]


def test_overwriting_shows_in_one_step(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/w"
    page = lambda n: spark.createDataFrame([(n, "u", bytearray(b"x"), "response", None)], W.WRITE_SCHEMA)
    ids = lambda: sorted(r.page_id for r in W.read_warc(spark, path).collect())
    W.write_warc(page(1), path)
    W.write_warc(page(2), path)
    (tmp_path / "w").chmod(0o755)
    kept = {f: f.read_bytes() for f in (tmp_path / "w").iterdir() if f.is_file() and not f.name.startswith(".")}
    W.write_warc(page(3), path, mode="overwrite")
    assert ids() == [3]
    for f, data in kept.items():  # as if the writer was lost before it deleted them
        f.write_bytes(data)
    assert ids() == [3]
    W.write_warc(page(4), path)
    assert ids() == [3, 4]
