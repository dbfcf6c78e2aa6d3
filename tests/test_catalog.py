"""Every query gives the rows its SQL statement gives in another engine."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from viewmill.catalog.queries import QUERIES as CATALOG

TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string"}
# Of the registered queries those of this package; operators that are installed beside it have tests of their own.
QUERIES = {name: query for name, query in contract.queries().items() if name in CATALOG}
ORACLE = {name: sql for name, sql in contract.oracle_sql().items() if name in CATALOG}


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLE) == set(CATALOG)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, oracle, name):
    found = QUERIES[name](spark, sf_dir)
    cursor = oracle.execute(ORACLE[name])
    types = {column[0]: TYPES[str(column[1])] for column in cursor.description}
    assert dict(found.dtypes) == types
    expected = [tuple(row) for row in cursor.fetchall()]
    got = [tuple(row) for row in found.select(*types).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert got


def test_entry(spark):
    assert contract.entry(spark).columns == ["sk_date", "product_id", "view_count", "rank"]
