"""Every registered query against its DuckDB oracle (the correctness gate)."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from chartlens.plans import registry
from chartlens.plans.oracle import ORACLE
from tests.conftest import SF_MID, SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
QUERIES = registry.QUERIES


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, list):
        return tuple(v)
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    cons = {}
    for sf in (SF_SMALL, SF_MID):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
        cons[sf] = con
    return cons


def test_every_query_has_oracle_or_is_model_output():
    rows_only = set(QUERIES) - set(ORACLE)
    assert set(ORACLE) <= set(QUERIES)
    assert rows_only == {
        "forest_predictions",
        "linear_predictions",
        "feature_importance",
        "coefficient_table",
        "forest_metrics",
        "linear_metrics",
    }


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sf = SF_MID if os.environ.get("CHARTLENS_FULL") else SF_SMALL
    df = QUERIES[name](spark, sf)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = duck[sf].execute(ORACLE[name])
    cols = [x[0] for x in rel.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == _rows(cols, rel.fetchall())


def test_entry_lists_every_query():
    assert set(QUERIES) <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == [
        "region",
        "avg_days_until_chart",
        "median_days_until_chart",
        "min_days_until_chart",
        "max_days_until_chart",
    ]
    assert len(rows) > 0


ROWS_ONLY_COLUMNS = {
    "forest_predictions": ["track_id", "region", "label", "prediction"],
    "linear_predictions": ["track_id", "region", "label", "prediction"],
    "feature_importance": ["index", "feature", "importance", "above_cutoff"],
    "coefficient_table": ["index", "feature", "coefficient", "std_error", "t_value", "p_value"],
    "forest_metrics": ["n", "rmse", "mae", "r2"],
    "linear_metrics": ["n", "rmse", "mae", "r2"],
}


@pytest.mark.parametrize("name", sorted(ROWS_ONLY_COLUMNS))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.columns == ROWS_ONLY_COLUMNS[name]
    assert df.count() > 0
