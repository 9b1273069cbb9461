"""The corpus pipeline: language ID, near-dedup, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyglass.llm import langid, mixing, nearcopies, packing, simhash
from tallyglass.storage import remove, scratch, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language or with too narrow a margin; learn from labelled rows that are not held out.

    Null and empty texts, and texts without a letter, go. Repeated rows stay, or
    go, together. Columns are those of ``docs``; no rows give no rows; without
    labelled rows nothing has a language.
    """
    model = langid.fit(docs.where(~langid.held_out()).select("doc_id", "text", "lang"))
    return langid.kept(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each group of op1's fingerprints within three bits; near_copies checks these links and joins more."""
    return simhash.representatives(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id (a null one last) of each group joined by 5-word Jaccard similarity of 0.8 or more.

    Links come from op1's ball hashing and are checked exactly; near copies beyond
    its three bits are joined after them. Null and empty texts are one group; of
    repeated rows one stays. Columns are those of ``docs``; no rows give no rows.
    """
    return nearcopies.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and cut documents so that sources have their target weights.

    Documents without a word are in no mix; a null source is a source; rows equal
    in id and text share alike. Columns are those of ``docs``; no rows give no rows.
    """
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the mix into sequences of 1024 ids, a row for each piece.

    A null or empty text is its end id alone; repeated rows are packed each; no
    rows give no rows; columns but ``doc_id`` and ``text`` are ignored.
    """
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_copies),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Compression, near copies and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``. What a stage leaves in the shared folder goes as soon as its result is written."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            docs, path = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
            keep.add(path)
        if last:
            remove(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
