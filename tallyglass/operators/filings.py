"""Trades from filings: folds of fills, amendments, deduplication, shard upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.functions.scalars import ratio, rnd


def fold_fills(fills: DataFrame, keys: Sequence[str], sh: str = "sh", px: str = "px") -> DataFrame:
    """Fills of one trade to a row: shares and value, and the average price (no price counts as 0)."""
    value = F.sum(F.col(sh) * F.coalesce(F.col(px), F.lit(0.0)))
    x = fills.groupBy(*keys).agg(F.sum(sh).alias("sh"), value.alias("val"), F.count("*").alias("fills"))
    return x.select(*keys, rnd("sh", 0).alias("sh"), rnd(ratio("val", "sh")).alias("px"), rnd("val", 0).alias("val"), "fills")


def fold_ownership(rows: DataFrame, keys: Sequence[str], di: str = "di", sh: str = "sh", own: str = "own", code: str = "code") -> DataFrame:
    """Holdings after a trade by form of ownership: ``di`` M where both forms occur.

    Within a form the largest holding counts for purchases and the smallest for
    sales. ``own`` is known only for a single form; ``own_d, sh_d`` are the direct
    part. ``code`` must be among ``keys``.
    """
    pick = lambda form: F.when(F.col(code) == "S", F.min(F.when(F.col(di) == form, F.col(own)))).otherwise(F.max(F.when(F.col(di) == form, F.col(own))))
    x = rows.groupBy(*keys).agg(
        F.sum(sh).alias("sh"),
        F.count_if(F.col(di) == "D").alias("__d"),
        F.count_if(F.col(di) == "I").alias("__i"),
        pick("D").alias("own_d"),
        pick("I").alias("__oi"),
        F.sum(F.when(F.col(di) == "D", F.col(sh))).alias("sh_d"),
    )
    form = F.when((F.col("__d") > 0) & (F.col("__i") > 0), "M").when(F.col("__i") > 0, "I").otherwise("D")
    one = F.when(form == "M", None).when(form == "I", F.col("__oi")).otherwise(F.col("own_d"))
    return x.select(*keys, "sh", form.alias("di"), one.alias("own"), "own_d", rnd("sh_d", 0).alias("sh_d"))


def newest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], versions: str | None = None) -> DataFrame:
    """The first row of each key by ``order``, which must leave no ties that matter."""
    w = Window.partitionBy(*keys)
    out = rows.withColumn("__r", F.row_number().over(w.orderBy(*order)))
    if versions:
        out = out.withColumn(versions, F.count("*").over(w))
    return out.where("__r = 1").drop("__r")


def deduplicate(trades: DataFrame, row_keys: Sequence[str], content_keys: Sequence[str], load_order: Column, tie: Sequence[Column] = ()) -> DataFrame:
    """Two stages: one row for a row key (the earliest in ``load_order``), then one for the same content.

    In the second an amendment (form 4/A) comes before an original, then the later
    filing, then ``load_order``; ``versions`` tells how many there were. Late
    amendments replace what was loaded before: run it over all that was loaded.
    """
    first = newest(trades, row_keys, [load_order, *tie])
    amended = F.when(F.col("form") == "4/A", 0).otherwise(1)
    return newest(first, content_keys, [amended, F.desc("fdate"), load_order, *tie], "versions")


def insert_absent(stored: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``fresh`` whose key is not stored yet: what an append writes."""
    return fresh.dropDuplicates(list(keys)).join(stored.select(*keys).distinct(), list(keys), "left_anti")


def replace_present(stored: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``stored`` with the rows of ``fresh``, which win on equal keys: what a rebuild writes."""
    fresh = fresh.dropDuplicates(list(keys))
    return stored.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh)
