from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as C
from tallyglass.llm import langid, mixing
from tests.llm.test_nearcopies import slow_groups
from tests.llm.test_packing import tokenizer, verify  # noqa: F401
from tests.llm.test_simhash import components, slow_fingerprint

D = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tokenizer):  # noqa: F811
    extra = spark.createDataFrame([(9001, None, "en", "src0", 0), (9002, "123 !!", None, None, 6), (9003, "Same words here again", "en", None, 21), (9004, "same WORDS here again", "en", "src1", 21)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = spark.read.parquet(f"{D}/documents.parquet").unionByName(extra)
    rows = {r.doc_id: r for r in docs.collect()}

    first = C.language_id(spark, docs, D)
    assert first.columns == docs.columns
    one = langid.classify(langid.fit(docs.where(~langid.held_out()).select("doc_id", "text", "lang")))
    want = set()
    for i, r in rows.items():
        lang, _, margin = one(r.text)
        if lang != "und" and margin >= langid.MARGIN:
            want.add(i)
    kept = {r.doc_id for r in first.collect()}
    assert kept == want and not kept & {9001, 9002} and len(kept) > 0.98 * (len(rows) - 2)

    second = C.near_duplicates(spark, first, D)
    fps = {i: slow_fingerprint(rows[i].text) for i in kept}
    of = {f: n for n, g in enumerate(components(fps.values())) for f in g}
    least = {}
    for i in sorted(kept):
        least.setdefault(of[fps[i]], i)
    stay = {r.doc_id for r in second.collect()}
    assert stay == set(least.values()) and 9003 in stay and 9004 not in stay and second.columns == docs.columns

    # the registered stage, against all pairs
    stages = dict(C.STAGES)
    assert stages["language_id"] is C.language_id and stages["mix_sources"] is C.mix_sources and stages["pack_sequences"] is C.pack_sequences
    second = stages["near_duplicates"](spark, first, D)
    ordered = sorted(kept)
    want = {ordered[g] for g in slow_groups([rows[i].text for i in ordered])}
    stay = {r.doc_id for r in second.collect()}
    assert stay == want and second.count() == len(want) and second.columns == docs.columns and 9003 in stay and 9004 not in stay

    third = C.mix_sources(spark, second, D)
    assert third.columns == docs.columns
    takes = {r.doc_id: r.taken for r in mixing.mix(second).collect()}
    words = Counter()
    mixed = third.collect()
    for r in mixed:
        words[r.doc_id] += len(r.text.split())
        assert rows[r.doc_id].text == r.text or rows[r.doc_id].text.split()[: len(r.text.split())] == r.text.split()
    assert words == {i: n for i, n in takes.items() if n}

    last = C.pack_sequences(spark, third, D)
    verify(last.collect(), [(r.doc_id, r.text) for r in mixed], tokenizer)


def test_run_is_its_stages(spark):
    now = spark.read.parquet(f"{D}/documents.parquet")
    for _, stage in C.STAGES:
        now = stage(spark, now, D)
    rows = lambda df: sorted(map(str, df.collect()))
    out = C.run(spark, D)
    assert {"doc_id", "sequence_id", "offset"} <= set(out.columns) and out.count() > 100
    assert rows(out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens")) == rows(now.select("doc_id", "start", "length", "ids_crc32", "doc_tokens"))


def test_run_on_an_empty_and_an_odd_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = " ".join("the of and to in is was that for with as on at by from this have".split()[i * 7 % 17] for i in range(400))
    for name, rows in (("none", []), ("odd", [(None, None, None, None, None), (1, "", "en", "a", 0), (1, text, "en", "a", 9), (1, text, "en", "a", 9), (2, text, "en", None, 9), (None, text + " end of it", None, "b", 9)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = C.run(spark, f"{tmp_path}/{name}").collect()
        assert {r.doc_id for r in out} == ({1} if rows else set()), name  # the least id of what is alike


def test_stages_on_odd_rows_and_clashing_columns(spark):
    """Nulls, empty texts, repeats and columns of the stages' own names pass through; no rows give no rows."""
    words = "the of and to in is was that for with as on at by from this have".split()
    text = " ".join(words[i % 17] + words[i * 7 % 17] for i in range(300))
    rows = [(1, text, "en", "a", 9), (1, text, "en", "a", 9), (None, text + " end", "en", None, 9), (3, None, None, None, None), (4, "", "en", "a", 0), (5, "der die das und " * 60, "de", "b", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("lang_margin", "__h", "size", "t", "root", "row", "shard", "key"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    now = docs
    for name, stage in C.STAGES[:-1]:
        assert stage(spark, docs.limit(0), D).count() == 0, name
        now = stage(spark, now, D)
        assert now.columns == docs.columns and {r.lang_margin for r in now.collect()} == {"own lang_margin"} and {r.key for r in now.collect()} == {"own key"}, name
    assert {r.doc_id for r in now.collect()} <= {1, None, 5}
    assert C.STAGES[-1][1](spark, docs.limit(0), D).count() == 0
    assert C.STAGES[-1][1](spark, docs, D).count() >= len(rows)
