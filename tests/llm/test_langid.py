import re
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from tallyglass.llm import langid as L

D = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    return L.fit(docs.where(~L.held_out()).select("doc_id", "text", "lang"))


def test_fit_is_repeatable_and_bounded(spark, model):
    docs = spark.read.parquet(f"{D}/documents.parquet").where(~L.held_out()).repartition(7, "n_chars")
    assert L.fit(docs) == model
    assert set(model.dictionaries) == {"en", "de", "fr", "es"} and next(iter(model.dictionaries)) == "en"
    assert all(len(d) <= L.SAMPLE_DOCS * (L.SAMPLE_CHARS * 4 + 1) for d in model.dictionaries.values())


def test_query_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    out = L.op5_langid(spark, D).collect()
    assert len(out) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in out)
    held = [r.lang_pred == docs[r.doc_id].lang for r in out if r.held_out]
    assert len(held) > 200 and sum(held) / len(held) > 0.97


def test_edge_rows(spark, model):
    rows = [(1, None), (2, ""), (3, " 12 !? "), (4, "x"), (None, "the of and is to"), (1, None), (6, "of the with " * 50_000)]
    docs = spark.createDataFrame([(i, t, 0.5, "q") for i, t in rows], "doc_id long, text string, score double, lang_pred string")
    out = L.predict(docs, model).collect()
    assert [r.lang_pred for r in out[:3]] == ["und"] * 3 and out[3].lang_pred in model.dictionaries
    assert out[4].lang_pred == out[6].lang_pred == "en" and len(out) == 7 and out[0].lang_score == 0
    assert {6} <= {r.doc_id for r in L.kept(docs, model).collect()} <= {4, None, 6}  # too short for a margin: rejected
    own = L.kept(docs.withColumn("lang_margin", F.lit("mine")), model)
    assert own.columns == [*docs.columns, "lang_margin"] and {(r.lang_pred, r.lang_margin, r.score) for r in own.collect()} == {("q", "mine", 0.5)}
    assert L.kept(docs.limit(0), model).count() == 0
    assert L.predict(docs.limit(0), model).count() == 0
    none = L.fit(spark.createDataFrame([(1, "a", None), (2, None, "en")], "doc_id long, text string, lang string"))
    assert [r.lang_pred for r in L.predict(docs, none).collect()] == ["und"] * 7
    one = L.fit(spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string"))
    assert L.predict(docs, one).collect()[4].lang_pred == "en"


def slow_sizes(dictionaries, text, level):
    """Compressed sizes by plain loops over languages and blocks, with a coder of its own for every block."""
    raw = " ".join(re.split(r"[\W\d_]+", text.lower())).encode("utf-8", "replace")
    out = {}
    for name, data in dictionaries.items():
        out[name] = 0
        for at in range(0, len(raw), L.BLOCK_BYTES):
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coder = zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            out[name] += len(coder.compress(raw[at : at + L.BLOCK_BYTES]))
    return out


def slow_answer(dictionaries, text):
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    for level in (L.LEVEL, L.FINE_LEVEL):
        sizes = slow_sizes(dictionaries, text, level)
        (a, _, first), (b, _, _) = sorted((n, i, name) for i, (name, n) in enumerate(sizes.items()))[:2]
        if a != b:
            break
    return first, (b - a) / a


def test_query_against_brute_force(spark, model):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    out = L.op5_langid(spark, D).collect()
    assert len(out) == len(texts)
    for r in out:
        name, margin = slow_answer(model.dictionaries, texts[r.doc_id])
        assert r.lang_pred == name and r.margin == pytest.approx(margin) and r.score == pytest.approx(margin / (margin + L.HALF_SCORE)), r


def test_every_label_is_learnt(spark):
    names = [f"l{i:03d}" for i in range(150)]
    rows = [(i, " ".join(f"{n}{'abcdefghij'[k]}" for k in range(10)).replace("0", "q").replace("1", "w").replace("2", "z"), n) for i, n in enumerate(names)]
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(model.dictionaries) == set(names)


def test_rejection_at_every_length(spark, model):
    """With a language left out most of its texts are rejected, with it nearly none."""
    docs = spark.read.parquet(f"{D}/documents.parquet").where(L.held_out())
    less = L.Model({k: v for k, v in model.dictionaries.items() if k != "es"})
    foreign = docs.where("lang = 'es'")
    assert L.kept(docs, model).count() > 0.985 * docs.count()
    assert L.kept(foreign, less).count() < 0.5 * foreign.count()
    same = spark.createDataFrame([(1, "zzz"), (2, "zzz " * 500)], "doc_id long, text string")
    assert L.kept(same, L.Model({"a": b"abc", "b": b"abc"})).count() == 0
