"""Every registered query runs; those with SQL give exactly the rows DuckDB gives."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry
from haulyard.catalog.queries import QUERIES
from tools.check import compare, connection


@pytest.fixture(scope="module")
def duck(data):
    return connection(data)


def test_entry_and_registration(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, data, name):
    result = compare(spark, duck, name, data)
    assert result.startswith("ok" if name in entry.oracle_sql() else "rows"), result
