"""Scratch tables: where they may be, and when they go."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tallyglass import storage
from tallyglass.operators.components import connected_components


def test_only_a_local_master_may_use_a_folder_of_its_own():
    def session(master, named=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named), sparkContext=SimpleNamespace(master=master, applicationId="a1"))

    for master in ("spark://host:7077", "yarn", "k8s://https://host", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            storage.shared_folder(session(master))
        assert storage.shared_folder(session(master, "hdfs:///x/")) == "hdfs:///x"
    assert storage.shared_folder(session("local[4]")).startswith("file:")


def test_scratch_goes_with_its_block(spark):
    at = lambda path: os.path.exists(path.removeprefix("file:").replace("//", "/"))
    outer = storage.written(spark.range(3), "outer")[1]
    with storage.scratch(spark) as keep:
        inner = storage.written(spark.range(3), "inner")[1]
        kept = storage.written(spark.range(3), "kept")[1]
        keep.add(kept)
        assert at(inner)
    assert at(outer) and at(kept) and not at(inner)
    with pytest.raises(ValueError), storage.scratch(spark):
        inner = storage.written(spark.range(3), "inner")[1]
        raise ValueError
    assert not at(inner)
    storage.remove(spark, kept, kept)
    assert not at(kept)


def test_components_keep_one_round(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    folder = storage.shared_folder(spark).removeprefix("file:").replace("//", "/")
    before = set(os.listdir(folder))
    found = connected_components(edges, "a", "b")
    assert len(set(os.listdir(folder)) - before) == 1
    assert found.agg(F.count("*"), F.max("component")).first() == (201, 0)


def test_partitions_are_set_for_a_block_only(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with storage.shuffle_partitions(spark, 77):
        assert spark.conf.get(key) == "77"
    with storage.shuffle_partitions(spark, 1):
        assert spark.conf.get(key) == before
    assert spark.conf.get(key) == before


def test_batches_are_bounded_inside_only(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    largest = lambda: spark.range(4000).repartition(1).selectExpr("repeat('x', 1000) as t").mapInArrow(lambda bs: (b.from_arrays([[b.nbytes]], names=["n"]) for b in bs), "n long").agg({"n": "max"}).first()[0]
    with storage.arrow_batches(spark, 100_000):
        assert largest() < 300_000
        with storage.arrow_batches(spark, 1 << 40):
            assert spark.conf.get(key) == "100000"
    assert spark.conf.get(key) == before and largest() > 1_000_000
