"""Every registered query against its SQL oracle on the smallest data set."""

import duckdb
import pytest

import check_oracles
from __spark_entry__ import entry, oracle_sql
from querybook import BOOK

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in check_oracles.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["page_id", "number", "confidence", "pos"]
    assert not result.isEmpty()


def test_every_query_has_an_oracle():
    assert set(BOOK) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(BOOK))
def test_query(spark, db, name):
    outcome = check_oracles.compare(spark, db, SF_DIR, name)
    assert " ok " in outcome, outcome
