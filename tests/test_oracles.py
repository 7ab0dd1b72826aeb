"""Every registered query against its DuckDB oracle (small scale factor, fast)."""

import importlib

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_check import compare, duck

# The optional training-data queries have tests of their own.
CORE = importlib.import_module("tessera.plans.registry").QUERIES
QUERIES = {k: q for k, q in entry.queries().items() if k in CORE}
ORACLES = {k: sql for k, sql in entry.oracle_sql().items() if k in CORE}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "geohash_7" in df.columns


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, con, key, QUERIES[key], ORACLES.get(key), SF_SMALL)
    assert res["ok"], res


_TYPE_MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_column_types_match_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    ours = {f.name: _TYPE_MAP.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE SELECT * FROM ({ORACLES[key]}) q").fetchall()}
    assert ours == theirs
