"""Where a job may keep intermediate tables, and how it cuts lineage.

Everything goes to the folder that the cluster names in ``spark.checkpoint.dir``
(shared by the driver and all executors). Only where that is unset on a local
master, as in unit tests, a folder of our own is made; elsewhere a folder of the
driver's machine would hold a part of each table only, so that is an error.

Tables stay until they are removed: ``with scratch(spark):`` around an operator
and the action on its result removes those that were made inside.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The shared scratch folder of this session; without one, RuntimeError unless the master is local."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="spark-")
    return _OWN[context.applicationId]


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables; paths that are gone already are passed over."""
    made = _MADE.get(spark.sparkContext.applicationId, [])
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        if path in made:
            made.remove(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[set[str]]:
    """Remove the scratch tables made inside, except for paths put into the set that it gives."""
    made = _MADE.setdefault(spark.sparkContext.applicationId, [])
    before, keep = set(made), set()
    try:
        yield keep
    finally:
        remove(spark, *[p for p in list(made) if p not in before and p not in keep])


def written(df: DataFrame, tag: str, codec: str = "snappy", by: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    """``cut``, and the path of the table; with ``by``, a folder for each value of these columns, so that a filter on them reads no other."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.option("compression", codec).partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame, tag: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    The result no longer depends on the tasks that made it, so a lost executor
    costs no recomputation of what came before, and each use reads files
    instead of running the plan again.
    """
    return written(df, tag, codec)[0]


@contextmanager
def shuffle_partitions(spark: SparkSession, at_least: int) -> Iterator[None]:
    """So many partitions, if the session has fewer, for the shuffles of jobs that run inside; small ones are still put together.

    A number from the data keeps a task's share bounded whatever the session's setting.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), at_least)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes that run inside remove their shuffle files as they end, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def arrow_batches(spark: SparkSession, at_most: int) -> Iterator[None]:
    """Batches of so many bytes at most, for the Python stages of jobs that run inside: a task holds one on either side, and what is made of it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before.removesuffix("b")), at_most)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def per_process(key: str, make):
    """``make()``'s value, made once in this Python process and kept between tasks."""
    import sys
    import types

    kept = sys.modules.setdefault("_tallyglass_kept", types.ModuleType("_tallyglass_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
