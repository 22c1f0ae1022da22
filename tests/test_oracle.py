"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from pyspark.sql import functions as F
from triprollup.functions.text import split_fields
from triprollup.operators.decode import decode_lines, rejected_lines
from triprollup.plans.queries import QUERIES as OWN

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def _sorted(rows):
    plain = (tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows)
    return sorted(plain, key=lambda r: tuple((v is None, v if v is not None else 0) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    answer = duck.execute(ORACLE[name])
    given = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(given)
    # The averages of doubles go last and are compared loosely: in the SQL their last
    # digits depend on the order of the rows, and some lie right between two fourth places.
    rounded = "round(avg(" in ORACLE[name]
    loose = [c for c in given if c.startswith("avg_") and rounded]
    columns = [c for c in given if c not in loose] + loose
    order = [given.index(c) for c in columns]
    expected = _sorted(tuple(row[i] for i in order) for row in answer.fetchall())
    actual = _sorted(map(tuple, df.select(*columns).collect()))
    assert len(actual) == len(expected) > 0
    firm = len(columns) - len(loose)
    assert [r[:firm] for r in actual] == [r[:firm] for r in expected]
    for got, want in zip(actual, expected):
        assert got[firm:] == pytest.approx(want[firm:], abs=1.01e-4, rel=0)


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    df = contract.entry(spark)
    rows = df.collect()
    assert len(rows) == 21 and all(r["match"] for r in rows)


def test_split_of_whole_texts(spark, duck):
    """The documents hold every kind of character; none may change the field count."""
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    counted = documents.select("doc_id", F.size(split_fields(F.col("text"))).alias("n"))
    expected = duck.execute(
        "select doc_id, len(string_split(rtrim(text, ','), ',')) from documents"
    ).fetchall()
    assert sorted(map(tuple, counted.collect())) == sorted(expected)


def test_whole_texts_are_refused(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    decoded = decode_lines(documents, value="text", keep=["doc_id"])
    refused = rejected_lines(decoded)
    assert refused.count() == documents.count()
    kept = refused.join(documents, "doc_id").filter(F.col("line").eqNullSafe(F.col("text")))
    assert kept.count() == documents.count()
