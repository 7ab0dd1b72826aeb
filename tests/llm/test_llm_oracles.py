"""The training-data queries that have SQL against DuckDB, on whole small tables."""

import pytest

from conftest import SF_SMALL
from oracle_check import compare, duck
from tessera.llm.queries import ORACLES, QUERIES

_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, key):
    con = duck(SF_SMALL)
    res = compare(spark, con, key, QUERIES[key], ORACLES[key], SF_SMALL)
    assert res["ok"], res
    ours = {f.name: _TYPES[f.dataType.simpleString()] for f in QUERIES[key](spark, SF_SMALL).schema.fields}
    assert ours == {r[0]: r[1] for r in con.execute(f"DESCRIBE SELECT * FROM ({ORACLES[key]}) q").fetchall()}
