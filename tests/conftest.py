from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chartlens.schema import CHART_SCHEMA  # noqa: E402
from chartlens.session import local_session  # noqa: E402
from chartlens.sources import typed_charts  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="chartlens-tests")
    yield s
    s.stop()


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def chart_row(**kw):
    """A chart row with defaults for every column not given."""
    base = {f.name: None for f in CHART_SCHEMA.fields}
    base.update(track_id="T1", title="Song", artist="A", region="X", chart="top200", rank=1,
                date=d("2017-03-01"), release_date="2017-02-01", explicit=False)
    base.update(kw)
    if isinstance(base["date"], str):
        base["date"] = d(base["date"])
    return tuple(base[f.name] for f in CHART_SCHEMA.fields)


@pytest.fixture
def charts(spark):
    """Build a typed chart frame from keyword rows: charts([dict(...), ...])."""

    def make(rows):
        return typed_charts(spark.createDataFrame([chart_row(**r) for r in rows], CHART_SCHEMA))

    return make
