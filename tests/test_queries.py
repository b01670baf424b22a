"""Every registered query against its DuckDB oracle at sf0.001 (the driver
runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_compare import compare, duck

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "avg_price" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    if name not in ORACLES:
        assert QUERIES[name](spark, SF_SMALL).count() >= 0
        return
    assert compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLES[name], SF_SMALL)
