"""Every registered query with an oracle must match DuckDB on the same tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_CHECK
from oracle import compare, duck

_SQL = E.oracle_sql()
_KEYS = sorted(k for k in E.queries() if k in _SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.mark.parametrize("key", _KEYS)
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(E.queries()[key](spark, SF_CHECK), _SQL[key], con)
    assert ok, f"{key}: {msg}"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "transfer_in" in df.columns
