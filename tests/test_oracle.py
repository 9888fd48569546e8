"""Correctness gate: every registered query vs its DuckDB SQL.

Batch queries at sf0.01; streaming queries (each a full availableNow run)
at sf0.001 to keep the suite quick (the driver checks them at sf0.01).
"""

import re

import pytest

from conftest import SF001, SF01
from oracle_compare import compare, duck

import __spark_entry__ as entry

QUERIES = entry.queries()
SQL = entry.oracle_sql()
# The training-data queries have tests of their own, where their package is present.
OWN = [n for n in QUERIES if not re.match(r"op\d+_|pipeline$", n)]
BATCH = [n for n in OWN if not n.startswith("stream_")]
STREAM = [n for n in QUERIES if n.startswith("stream_")]


def test_every_query_has_sql():
    assert set(OWN) <= set(SQL) <= set(QUERIES)


@pytest.fixture(scope="module")
def con01():
    return duck(SF01)


@pytest.fixture(scope="module")
def con001():
    return duck(SF001)


@pytest.mark.parametrize("name", BATCH)
def test_batch_query(spark, con01, name):
    res = compare(QUERIES[name](spark, SF01), con01, SQL[name], exact=True)
    assert res["ok"], res


@pytest.mark.parametrize("name", STREAM)
def test_stream_query(spark, con001, name):
    res = compare(QUERIES[name](spark, SF001), con001, SQL[name], exact=True)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 73
    assert "risk_level" in df.columns
