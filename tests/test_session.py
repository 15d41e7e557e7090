"""Intermediate tables: the folder must be named, and a job's scope removes its own."""
from __future__ import annotations

import os

import pytest

from reqtrail import session


class Unnamed:
    """A session that names no checkpoint folder."""

    class conf:  # noqa: N801
        get = staticmethod(lambda key, default: default)

    class sparkContext:  # noqa: N801
        getCheckpointDir = staticmethod(lambda: None)


def test_an_unnamed_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Unnamed)


def tables(spark):
    folder = os.path.join(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"), "tables")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_a_scope_removes_the_tables_written_in_it(spark):
    outer = session.materialize(spark.range(3), "outside")
    before = tables(spark)
    with session.scratch_scope(spark):
        inner = session.materialize(spark.range(5), "inside")
        with session.scratch_scope(spark):
            session.materialize(inner, "deeper")
            assert len(tables(spark)) == len(before) + 2
        assert inner.count() == 5 and len(tables(spark)) == len(before) + 1
    assert tables(spark) == before and outer.count() == 3
    with pytest.raises(ZeroDivisionError):
        with session.scratch_scope(spark):
            session.materialize(spark.range(5), "failing")
            1 / 0
    assert tables(spark) == before
