"""Queries on verdicts, made in several parts: the rows of their SQL, and nothing of a part stays on disk but its result."""

import glob
import os
import tempfile

import pytest

from tallyglass import storage
from tallyglass.plans import queries
from tests import test_queries
from tests.test_queries import con  # noqa: F401

NAMES = ("gate_cascade", "gate_drop_counts", "trade_features", "slice_grid", "slice_cells", "slice_cells_full", "avoid_slices", "set_cells", "set_ladders")


def shuffled():
    return set(glob.glob(f"{os.environ.get('SPARK_LOCAL_DIRS') or tempfile.gettempdir()}/blockmgr-*/*/shuffle_*"))


@pytest.mark.parametrize("name", NAMES)
def test_in_parts(spark, con, name, monkeypatch):  # noqa: F811
    monkeypatch.setattr(queries, "LINES_A_PART", 2500)  # three parts
    monkeypatch.setattr(queries, "PARTS_A_ROUND", 2)
    made, shuffles = [], []
    whole = queries._in_parts

    def watched(*args):
        folder = storage.shared_folder(spark).removeprefix("file:").replace("//", "/")
        before, left = set(os.listdir(folder)), shuffled()
        out = whole(*args)
        made.extend(x.rpartition("-")[0] for x in set(os.listdir(folder)) - before)
        shuffles.extend(shuffled() - left)
        return out

    monkeypatch.setattr(queries, "_in_parts", watched)
    test_queries.test_query(spark, con, name)
    assert sorted(made) in (["rows"] * 3, ["returns"] + ["rows"] * 3) and not shuffles
