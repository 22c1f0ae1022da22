"""Files whose schema changed: columns added, types widened, and changes that cannot be."""

import datetime
import decimal

import pytest
from pyspark.sql import types as T

from triprollup.plans.queries import _narrowed
from triprollup.sources import evolved


def _write(spark, path, schema, *rows):
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(str(path))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_three_generations(spark, tmp_path):
    path = tmp_path / "trips"
    _write(spark, path, "k string, n int, d float, day date", ("a", 1, 0.1, datetime.date(2016, 1, 2)))
    _write(spark, path, "k string, n bigint, d float", ("b", 2**40, 0.5))
    _write(spark, path, "n int, d double, k string, extra string", (3, 0.25, "c", "x"))
    df = evolved.evolved_table(spark, str(path))
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == {
        "k": "string", "n": "bigint", "d": "double", "day": "date", "extra": "string",
    }
    found = {r["k"]: r for r in df.collect()}
    assert found["a"]["d"] == pytest.approx(0.1, rel=1e-7) and found["a"]["day"] is not None
    assert found["b"]["n"] == 2**40 and found["b"]["extra"] is None
    assert (found["c"]["d"], found["c"]["extra"], found["c"]["day"]) == (0.25, "x", None)


def test_each_group_is_one_scan(spark, tmp_path):
    """Schemas that alternate do not make a scan for each file."""
    path = tmp_path / "alternating"
    for i in range(8):
        _write(spark, path, f"n {'int' if i % 2 else 'bigint'}", (i,))
    df = evolved.evolved_table(spark, str(path))
    assert _rows(df) == [(i,) for i in range(8)]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2


def test_files_of_one_schema_are_merged_once(spark, tmp_path, monkeypatch):
    path, merges = tmp_path / "plain", []
    for i in range(6):
        _write(spark, path, "n bigint" if i < 3 else "n bigint, m string", *([(i,)] if i < 3 else [(i, "x")]))
    real = evolved._reader
    monkeypatch.setattr(evolved, "_reader", lambda *a: merges.append(1) or real(*a))
    df = evolved.evolved_table(spark, str(path))
    assert len(merges) == 2 and df.count() == 6 and df.filter("m is not null").count() == 3


def test_partitions_stay_columns(spark, tmp_path):
    path = str(tmp_path / "parts")
    for part, kind in ((1, "int"), (2, "bigint")):
        _write(spark, f"{path}/batch_ms={part}", f"n {kind}", (part,))
    assert _rows(evolved.evolved_table(spark, path).select("batch_ms", "n")) == [(1, 1), (2, 2)]


def test_nested_types_and_decimals(spark, tmp_path):
    path = tmp_path / "nested"
    _write(spark, path, "s struct<a:int>, l array<float>, m map<string,int>, d decimal(5,2)",
           ((1,), [0.5], {"k": 1}, decimal.Decimal("1.25")))
    _write(spark, path, "s struct<a:bigint,b:string>, l array<double>, m map<string,bigint>, d decimal(8,4)",
           ((2, "x"), [0.25], {"k": 2}, decimal.Decimal("1000.1234")))
    df = evolved.evolved_table(spark, str(path))
    assert df.schema["d"].dataType == T.DecimalType(8, 4)
    assert _rows(df.select("s.a", "l", "m", "d"))[1][1:3] == ([0.25], {"k": 2})
    assert sorted(r["a"] for r in df.select("s.a").collect()) == [1, 2]


@pytest.mark.parametrize("kinds", [("int", "string"), ("bigint", "double"), ("float", "int"), ("date", "int")])
def test_what_cannot_be_widened(spark, tmp_path, kinds):
    for kind in kinds:
        spark.sql(f"select cast(null as {kind}) as n").write.mode("append").parquet(str(tmp_path / "t"))
    with pytest.raises(evolved.CannotWiden, match="n is"):
        evolved.evolved_table(spark, str(tmp_path / "t"))


def test_an_empty_directory(spark, tmp_path):
    with pytest.raises(Exception):
        evolved.evolved_table(spark, str(tmp_path / "none"))


def test_a_sum_that_grew_out_of_bigint(spark):
    """Where SQL's bigint holds it, it is one; beyond, all its digits stay."""
    for n, kind in ((2**63 - 1, "bigint"), (2**63, "decimal(30,0)"), (-(2**63), "bigint"), (None, "bigint")):
        value = None if n is None else decimal.Decimal(n)
        rows = spark.createDataFrame([("a", value), ("b", decimal.Decimal(1))], "k string, n decimal(30,0)")
        found = _narrowed(spark, rows, "n")
        assert found.schema["n"].dataType.simpleString() == kind and found.columns == ["k", "n"]
        assert sorted(map(tuple, found.collect())) == [("a", n), ("b", 1)]
