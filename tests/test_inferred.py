"""Types of CSV columns against Spark's own inference, DuckDB's, and by hand."""

import json

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import line
from triprollup.operators.decode import decode_trips
from triprollup.sources import inferred


def _types(df):
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def _file(tmp_path, text, name="a.csv"):
    folder = tmp_path / "csv"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_each_type(spark, tmp_path):
    rows = [
        "i,big,huge,d,e,day,time,mixed,dt,s,none,flag,blank,q",
        '1,9223372036854775807,9223372036854775808,1.5,NaN,2016-01-01,2016-01-01 10:00:00,1,2016-01-01,x,,true, 1,"1,5"',
        "-007,-1,1,2,-Infinity,2016-12-31,2016-01-01T10:00:00.25Z,x,2016-01-01 00:00:01,1,,false,2,2",
        ",,,.5,1e3,,,,,,,,,",
    ]
    df = inferred.csv_inferred(spark, _file(tmp_path, "\n".join(rows) + "\n"))
    assert _types(df) == {
        "i": "bigint", "big": "bigint", "huge": "double", "d": "double", "e": "double",
        "day": "date", "time": "timestamp", "mixed": "string", "dt": "timestamp", "s": "string",
        "none": "string", "flag": "string", "blank": "string", "q": "string",
    }
    found = df.select("i", "big", "d", "q", F.date_format("time", "HH:mm:ss.SS").alias("t")).collect()
    assert [tuple(r) for r in found][:2] == [
        (1, 9223372036854775807, 1.5, "1,5", "10:00:00.00"), (-7, -1, 2.0, "2", "10:00:00.25"),
    ]
    assert found[2]["i"] is None and found[2]["d"] == 0.5


def test_the_last_line_of_the_last_file_counts(spark, tmp_path):
    """No sampling: one text in a hundred thousand numbers makes a text column."""
    for part in range(4):
        lines = "".join(f"{i},{i}.5\n" for i in range(25_000))
        path = _file(tmp_path, f"a,b\n{lines}{'x,1' if part == 3 else '1,1'}\n", f"{part}.csv")
    df = inferred.csv_inferred(spark, path)
    assert _types(df) == {"a": "string", "b": "double"} and df.count() == 100_004


def test_no_header(spark, tmp_path):
    path = _file(tmp_path, "1,x\n2,y\n")
    assert _types(inferred.csv_inferred(spark, path, header=False)) == {"_c0": "bigint", "_c1": "string"}
    named = inferred.csv_inferred(spark, path, header=False, names=["n", "t"])
    assert sorted(map(tuple, named.collect())) == [(1, "x"), (2, "y")] and named.columns == ["n", "t"]
    with pytest.raises(ValueError, match="2 columns"):
        inferred.csv_inferred(spark, path, header=False, names=["n"])


@pytest.mark.parametrize("bad", ["1", "1,2,3"])
def test_ragged_lines_fail(spark, tmp_path, bad):
    path = _file(tmp_path, f"a,b\n1,2\n{bad}\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        inferred.csv_inferred(spark, path).collect()


def test_trips_as_duckdb_reads_them(spark, lines_of, tmp_path):
    trips = decode_trips(lines_of(line(), line(vendor_id="1", total_amount="3.3"), line(payment_type="1")))
    path = str(tmp_path / "trips")
    trips.coalesce(1).write.option("header", True).csv(path)
    df = inferred.csv_inferred(spark, path)
    duck = duckdb.sql(f"select * from read_csv('{path}/*.csv')")
    same = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp"}
    assert list(_types(df).values()) == [same[str(t)] for t in duck.types]
    plain = [c for c, t in _types(df).items() if t != "timestamp"]
    expected = duckdb.sql(f"select {', '.join(plain)} from duck").fetchall()
    assert sorted(map(tuple, df.select(*plain).collect())) == sorted(expected)


def test_types_are_found_in_one_scan(spark, tmp_path):
    """The aggregate reads the file once, and shuffles a row of flags for each task."""
    path = _file(tmp_path, "a,b\n1,2\n")
    texts = inferred.text_columns(spark, path)
    plans = []
    agg = type(texts).agg

    class Watched:
        columns = texts.columns

        def agg(self, *flags):
            found = agg(texts, *flags)
            plans.append(found._jdf.queryExecution().executedPlan().toString())
            return found

    inferred.inferred_types(Watched())
    assert plans[0].count("FileScan csv") == 1 and plans[0].count("Exchange") == 1
    assert plans[0].count("partial_bool_and") or plans[0].count("partial_min")


def test_two_numbers_a_column_are_folded(spark, lines_of):
    """No value is looked at by more than a number for each chain of types."""
    texts, plans = lines_of("1", None, "x"), []
    agg = type(texts).agg

    class Watched:
        columns = texts.columns

        def agg(self, *least):
            plans.extend(least)
            return agg(texts, *least)

    assert inferred.inferred_types(Watched()) == texts.schema and len(plans) == 2


ODD = ["+", "-", ".", "-.", "1.", "+.5", "1..", "--1", "1-", "1e", "1E-05", "1e999999999999", "Inf", "-NaN", "+Infinity", "0x1F", "1_0", "1 ",
       "1\n", "\t1", "9223372036854775807", "-9223372036854775808", "-9223372036854775809", "9" * 30, "-73.9", "9999-99-99", "0000-01-01",
       "2016-01-01 ", "2016-01-01 25:00:00", "2016-01-01 01:02:03.1234567", "2016-01-01 01:02:03+01:00", "12345-01-01", "\u0663"]


def test_odd_values_one_by_one(spark):
    """Beginnings and lengths that are looked at first give what pattern and cast give."""

    def holds(kind, looks):
        return F.col("v").rlike(looks) & F.col("v").try_cast(kind).isNotNull()

    time = f"{inferred.DATE_TEXT}|{inferred.TIME_TEXT}"
    number = F.when(holds("bigint", inferred.WHOLE_TEXT), 2).when(holds("double", inferred.NUMBER_TEXT), 1).otherwise(0)
    stamp = F.when(holds("date", inferred.DATE_TEXT), 2).when(holds("timestamp", time), 1).otherwise(0)
    rows = spark.createDataFrame([(v,) for v in [*VALUES, *ODD]], "v string")
    found = rows.select("v", inferred._number(F.col("v")), number, inferred._time(F.col("v")), stamp).collect()
    assert [r for r in found if r[1] != r[2] or r[3] != r[4]] == []


VALUES = ["1", "-2", "007", "1.5", "1e3", "NaN", "2016-01-01", "2016-02-30", "2016-01-01 01:02:03", "x", "", " 1",
          "1d", "9223372036854775808", "Infinity", "+3", ".", "2016-01-01T01:02:03Z", "true"]


def by_hand(values):
    """The least type that has all values, from sets of what each value can be."""
    number, whole = {"1", "-2", "007", "1.5", "1e3", "NaN", "9223372036854775808", "Infinity", "+3"}, {"1", "-2", "007", "+3"}
    time, day = {"2016-01-01", "2016-01-01 01:02:03", "2016-01-01T01:02:03Z"}, {"2016-01-01"}
    some = {v for v in values if v}
    for kind, those in (("bigint", whole), ("double", number), ("date", day), ("timestamp", time)):
        if some and some <= those:
            return kind
    return "string"


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(VALUES), min_size=6, max_size=6), min_size=1, max_size=4))
def test_any_values(spark, tmp_path, rows):
    texts = spark.createDataFrame([tuple(v or None for v in r) for r in rows], ", ".join(f"`c.{i}` string" for i in range(6)))
    found = json.loads(inferred.inferred_types(texts).json())["fields"]
    names = {"long": "bigint"}
    assert [names.get(f["type"], f["type"]) for f in found] == [by_hand(c) for c in zip(*rows)]
    assert inferred.as_types(texts, inferred.inferred_types(texts)).count() == len(rows)
