"""Language identification by compression.

Each language has a zstandard raw-content dictionary made of labelled sample
text. A text is cut into blocks, each block is compressed once with every
language's dictionary, and the language with the smallest total wins: its
dictionary holds more of the text's substrings. Blocks are short, so that a
long text keeps leaning on the dictionary instead of on itself. Only letters
count: they are lower-cased and all else becomes single spaces. The margin is
the saving of the best against the second best, as a share of the best's size;
a narrow margin is a rejection.

Only the dictionaries are fitted, on a bounded sample: of each language the
texts whose hash is the least within each of ``SAMPLE_DOCS`` hash buckets, at
most ``SAMPLE_CHARS`` characters of each. Every label is learnt; with so many
that there would be more than ``MOST_EXCERPTS`` excerpts in all, each has fewer
buckets (one at least). Every text is classified whole, by one rule at every
length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_DOCS, SAMPLE_CHARS, MOST_EXCERPTS = 128, 1000, 65_536
BLOCK_BYTES, LEVEL = 8192, 5
#: Where the two smallest sizes are equal, a text is compressed again at this level, which finds shorter matches.
FINE_LEVEL = 12
#: A text is rejected if the best language saves less than this share of its own size against the next. Of held-out
#: texts in a learnt language about 1 in 250 is (nearly all of under 30 bytes), of texts in a language left out about 7 in 10.
MARGIN = 0.02
#: Margin at which the score is a half.
HALF_SCORE = 0.05
UNKNOWN = "und"


_NEW = (T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType()), T.StructField("lang_margin", T.DoubleType()))
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """What is compressed of a text: its letters, lower-cased, with single spaces between."""
    return _OTHER.sub(" ", text.lower()).encode("utf-8", "replace")


@dataclass(frozen=True)
class Model:
    """The dictionaries, by language, those with more labelled rows first."""

    dictionaries: dict[str, bytes]


def fit(labelled: DataFrame) -> Model:
    """Dictionaries from ``doc_id, text, lang``; rows without text or lang are left out.

    What comes to the driver is a count for each language, one number for each
    language and bucket, then one excerpt for each of these.
    """
    rows = labelled.where("lang is not null and text is not null").select(
        F.col("lang"), F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")).alias("h"), F.col("text")
    )
    most = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()
    if not most:
        return Model({})
    spark = labelled.sparkSession
    bucket = F.pmod(F.col("h"), F.lit(max(1, min(SAMPLE_DOCS, MOST_EXCERPTS // len(most)))))
    least = rows.groupBy("lang", bucket.alias("bucket")).agg(F.min("h").alias("h"))
    picked = spark.createDataFrame([(r.lang, r.h) for r in least.collect()], "lang string, h long")
    # an excerpt from the middle: first lines are often titles or boilerplate
    middle = F.greatest(F.lit(1), F.floor((F.length("text") - SAMPLE_CHARS) / 2).cast("int"))
    found = rows.join(F.broadcast(picked), ["lang", "h"], "left_semi").select("lang", "h", F.substring("text", middle, F.lit(SAMPLE_CHARS)).alias("part"))
    texts: dict[str, dict[int, str]] = {}
    for r in found.groupBy("lang", "h").agg(F.min("part").alias("part")).collect():
        texts.setdefault(r.lang, {})[r.h] = r.part
    return Model({r.lang: b" ".join(letters(part) for _, part in sorted(texts[r.lang].items())) for r in most})


def _sizes(model: Model, level: int):
    """A function from bytes to their compressed size by language."""
    coders = []
    for data in model.dictionaries.values():
        d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        coders.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(raw: bytes) -> list[int]:
        blocks = [raw[i : i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
        return [sum(len(c.compress(b)) for b in blocks) for c in coders]

    return sizes


def classify(model: Model, level: int = LEVEL):
    """A function from a text to ``(language, score, margin)``.

    A null text, one without a letter, or an empty model gives ``und``, 0, 0.
    Ties go to the language with more labelled rows.
    """
    names, quick, fine = list(model.dictionaries), _sizes(model, level), _sizes(model, FINE_LEVEL)

    def one(text: str | None) -> tuple[str, float, float]:
        if not names or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        if len(names) == 1:
            return names[0], 1.0, 1.0
        raw = letters(text)
        found = quick(raw)
        if sorted(found)[0] == sorted(found)[1]:
            found = fine(raw)
        best = min(range(len(names)), key=found.__getitem__)
        margin = (min(x for i, x in enumerate(found) if i != best) - found[best]) / found[best]
        return names[best], margin / (margin + HALF_SCORE), margin

    return one


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred, lang_score, lang_margin`` appended (same-named columns are replaced).

    Rows are kept one for one, repeated or not; an empty table gives no rows.
    """
    kept = [c for c in docs.columns if c.lower() not in [f.name for f in _NEW]]
    at = [c.lower() for c in kept].index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = classify(model)
        for batch in batches:
            found = [one(t) for t in batch.column(at).to_pylist()]
            new = [pa.array([x[0] for x in found], pa.string()), *(pa.array([x[i] for x in found], pa.float64()) for i in (1, 2))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, "lang_pred", "lang_score", "lang_margin"])

    rows = docs.select(*kept)
    schema = T.StructType([*rows.schema.fields, *_NEW])
    return rows.mapInArrow(run, schema)


def kept(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that have a language: neither ``und`` nor of a margin under ``MARGIN``.

    Rows and columns are those of ``docs``, whatever their names; repeated rows
    stay repeated, a null or empty text goes, an empty table gives no rows.
    """
    at = [c.lower() for c in docs.columns].index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = classify(model)
        for batch in batches:
            found = [one(t) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([name != UNKNOWN and margin >= MARGIN for name, _, margin in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id="doc_id"):
    """True where crc32 of the id as text is 2 modulo 4; a null id counts as not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op5_langid(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out()).select("doc_id", "text", "lang"))
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_margin").alias("margin"))
