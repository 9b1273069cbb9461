"""Tables by year that change in one step: readers see all of a change or nothing of it.

Data is only ever added: the years that a change touches are written anew beside
the old ones. What the table is made of stands in a pointer, a small numbered
file, and a change is the next pointer, renamed into place when all else is written.
A reader takes the pointer of the highest number. A write that fails, wherever it
fails, leaves files that no pointer names; of two writers at once the second fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.storage import cut

_POINTERS = "_pointers"


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the pointers, in order."""
    fs, at = _fs(spark, f"{path}/{_POINTERS}")
    if not fs.exists(at):
        return []
    return sorted(int(x.getPath().getName()) for x in fs.listStatus(at) if x.getPath().getName().isdigit())


def _pointer(spark: SparkSession, path: str, number: int) -> dict:
    fs, at = _fs(spark, f"{path}/{_POINTERS}/{number}")
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _switch(spark: SparkSession, path: str, number: int, pointer: dict) -> None:
    """Make ``pointer`` the table, as the one of this number."""
    fs, made = _fs(spark, f"{path}/{_POINTERS}/.{uuid.uuid4().hex}")
    out = fs.create(made, False)
    try:
        out.write(bytearray(json.dumps(pointer).encode()))
    finally:
        out.close()
    _, at = _fs(spark, f"{path}/{_POINTERS}/{number}")
    if fs.exists(at) or not fs.rename(made, at):
        fs.delete(made, False)
        raise RuntimeError(f"{path} was changed meanwhile; its pointer {number} is there already")


def current(spark: SparkSession, path: str) -> tuple[int, dict[int, list[str]]]:
    """The number of the last change (0: there is no table) and the versions that each year is made of."""
    numbers = _numbers(spark, path)
    years = _pointer(spark, path, numbers[-1])["years"] if numbers else {}
    return (numbers[-1] if numbers else 0), {int(y): own for y, own in years.items()}


def stored(spark: SparkSession, path: str, years: Sequence[int] | None = None) -> DataFrame | None:
    """The table at ``path`` as it is now, or some ``years`` of it; None if nothing is there.

    The result stays what it is when the table changes, until ``vacuum`` takes its files.
    """
    _, versions = current(spark, path)
    folders = [f"{path}/year={y}/version={v}" for y, own in sorted(versions.items()) for v in own if years is None or y in years]
    return spark.read.option("basePath", path).option("mergeSchema", True).parquet(*folders).drop("version") if folders else None


def publish(rows: DataFrame, path: str, replaces: Sequence[int] = ()) -> int:
    """Add ``rows`` (with ``year``) to the table at ``path`` in one step; the number of the change. The years in ``replaces`` lose what they had."""
    spark = rows.sparkSession
    number, versions = current(spark, path)
    version = f"{number + 1}-{uuid.uuid4().hex[:12]}"
    # a large year is written by several tasks
    rows.hint("rebalance", "year").withColumn("version", F.lit(version)).write.mode("append").partitionBy("year", "version").parquet(path)
    kept = {y: list(own) for y, own in versions.items() if y not in set(replaces)}
    fs, at = _fs(spark, path)
    for x in fs.listStatus(at):
        name = x.getPath().getName()
        if name.startswith("year=") and fs.exists(_fs(spark, f"{path}/{name}/version={version}")[1]):
            kept.setdefault(int(name.removeprefix("year=")), []).append(version)
    _switch(spark, path, number + 1, {"years": kept})
    return number + 1


def write_by_year(rows: DataFrame, path: str, keys: Sequence[str], day: str = "tdate", replace: bool = False, first_year: int = 2010, last_year: int | None = None) -> None:
    """Put ``rows`` into the table at ``path``, by the ``year`` of ``day`` (of an amendment: its original's day).

    Rows whose key is stored are left alone, or with ``replace`` take the stored
    one's place; all else that is stored stays. Only the years that ``rows``
    touches are read, or written anew. Years before ``first_year`` or after
    ``last_year`` + 1 are left out, as are rows without a day. Readers see it when all of it is written.
    """
    spark = rows.sparkSession
    keys = [*keys, "year"]
    x = rows.withColumn("year", F.year(day)).where(F.col("year") >= first_year).dropDuplicates(keys)
    if last_year is not None:
        x = x.where(F.col("year") <= last_year + 1)
    x = cut(x, "by-year")
    touched = [r.year for r in x.select("year").distinct().collect()]  # as many as there are years
    if not touched:
        return
    old = stored(spark, path, touched)
    if old is None:  # none of these years has rows
        publish(x, path)
    elif replace:
        old = old.select(x.columns)
        publish(old.join(x.select(*keys), keys, "left_anti").unionByName(x), path, replaces=touched)
    else:
        publish(x.join(old.select(*keys), keys, "left_anti"), path)


def purge(spark: SparkSession, path: str, keep: Column) -> None:
    """Leave only the rows where ``keep`` holds, in one step; years without others are not written anew."""
    whole = stored(spark, path)
    if whole is None:
        return
    hit = [r.year for r in whole.where(~F.coalesce(keep, F.lit(False))).select("year").distinct().collect()]
    if hit:
        publish(stored(spark, path, hit).where(keep), path, replaces=hit)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Delete the files that none of the last ``keep`` pointers names, and older pointers. Not while someone writes or still reads an older state."""
    numbers = _numbers(spark, path)
    wanted = {(f"year={y}", f"version={v}") for n in numbers[-keep:] for y, own in _pointer(spark, path, n)["years"].items() for v in own}
    fs, at = _fs(spark, path)
    for n in numbers[:-keep]:
        fs.delete(_fs(spark, f"{path}/{_POINTERS}/{n}")[1], False)
    for year in fs.listStatus(at):
        if year.getPath().getName().startswith("year="):
            for x in fs.listStatus(year.getPath()):
                if (year.getPath().getName(), x.getPath().getName()) not in wanted:
                    fs.delete(x.getPath(), True)
