"""Queries that SQL can express, against DuckDB over the same tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from triprollup.llm.oracle import ORACLE
from triprollup.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    duck = duckdb.connect()
    duck.execute(f"create view documents as from '{SF_DIR}/documents.parquet'")
    answer = duck.execute(ORACLE[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(found.columns)
    expected = sorted(answer.fetchall(), key=repr)
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == expected
    assert len(expected) > 0


def test_the_contract_has_them():
    assert set(ORACLE) <= set(contract.oracle_sql()) & set(contract.queries())
