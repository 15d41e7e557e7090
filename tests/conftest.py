from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reqtrail.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(4, shuffle_partitions=4, driver_memory="4g", checkpoint_dir=str(tmp_path_factory.mktemp("checkpoint")))
    yield s
    s.stop()


def ts(*a) -> dt.datetime:
    return dt.datetime(*a)


def rows(df, *order):
    out = [r.asDict(recursive=True) for r in (df.orderBy(*order) if order else df).collect()]
    return out
