"""Queries without SQL over all rows, against brute force, and names that are kept."""

import datetime as dt
from collections import Counter

import duckdb

from tallyglass.plans.queries import QUERIES

D = "/root/testdata/sf0.001"


def test_names_that_are_kept(spark):
    for name in ("nearest_bar", "regular_series", "owner_groups"):
        a, b = (sorted(map(str, QUERIES[n](spark, D).collect())) for n in (name, f"{name}_all"))
        assert a == b and a


def test_owner_groups_of_all_members(spark):
    c = duckdb.connect()
    rows = c.sql(f"select o_custkey, cast(o_orderdate as date), o_orderpriority, o_orderkey % 5 from '{D}/orders.parquet'").fetchall()
    met = {}
    for owner, *key in rows:
        met.setdefault(tuple(key), set()).add(owner)
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for members in met.values():
        for b in members if len(members) > 1 else ():
            root[find(b)] = find(min(members))
    sizes = Counter(Counter(map(find, list(root))).values())
    assert {r["size"]: r["groups"] for r in QUERIES["owner_groups_all"](spark, D).collect()} == sizes


def test_owner_groups_link_the_middle_members(spark, tmp_path):
    day = dt.datetime(2020, 1, 1)
    rows = [(5, 1, day, "a"), (10, 2, day, "a"), (15, 3, day, "a"), (20, 2, day, "b"), (25, 9, day, "b"), (30, 7, day, "c"), (35, 7, day, "c")]
    spark.createDataFrame([(*r, 1.0) for r in rows], "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    assert [tuple(r) for r in QUERIES["owner_groups_all"](spark, str(tmp_path)).collect()] == [(4, 1)]
