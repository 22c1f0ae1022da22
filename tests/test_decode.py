import math
import re
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import FIELDS, line
from triprollup.functions.text import parse_int32, split_fields
from triprollup.operators.decode import (
    accepted_trips,
    decode_documents,
    decode_json,
    decode_lines,
    decode_trips,
    encode_json,
    encode_lines,
    rejected_lines,
)
from triprollup.schemas import TRIP_COLUMNS, TRIP_SCHEMA
from triprollup.sources.tables import literal_trips

GOOD = {
    "plain": line(),
    "trailing commas": line() + ",,",
    "empty vendor": line(vendor_id=""),
    "plus sign": line(passenger_count="+7"),
    "smallest int": line(passenger_count="-2147483648"),
    "NaN": line(total_amount="NaN"),
    "infinite": line(tip_amount="-Infinity"),
    "exponent": line(trip_distance="1e3"),
    "suffix": line(trip_distance="1d"),
    "blank around a double": line(fare_amount=" 7.5 "),
    "overflowing double": line(fare_amount="1e999"),
    "overflowing float": line(pickup_latitude="1e39"),
}
BAD = {
    "header": (",".join(TRIP_COLUMNS), "bad passenger_count"),
    "18 fields": (",".join(FIELDS[:-1]), "arity"),
    "20 fields": (line() + ",1", "arity"),
    "last field empty": (line(total_amount=""), "arity"),
    "no text": ("", "arity"),
    "only commas": ("," * 18, "arity"),
    "quoted comma": (line(vendor_id='"a,b"'), "arity"),
    "no value": (None, "no value"),
    "decimal count": (line(passenger_count="1.0"), "bad passenger_count"),
    "blank before count": (line(passenger_count=" 1"), "bad passenger_count"),
    "line end after count": (line(passenger_count="1\n"), "bad passenger_count"),
    "33 bits": (line(passenger_count="2147483648"), "bad passenger_count"),
    "empty count": (line(passenger_count=""), "bad passenger_count"),
    "letter": (line(trip_distance="x"), "bad trip_distance"),
    "empty double": (line(trip_distance=""), "bad trip_distance"),
    "nan": (line(total_amount="nan"), "bad total_amount"),
    "inf": (line(total_amount="inf"), "bad total_amount"),
    "INFINITY": (line(pickup_longitude="INFINITY"), "bad pickup_longitude"),
    "first fault named": (line(extra="x", fare_amount="x"), "bad fare_amount"),
}


def test_accepted(lines_of):
    decoded = decode_lines(lines_of(*GOOD.values()))
    assert [r["line"] for r in rejected_lines(decoded).collect()] == []
    assert decode_trips(lines_of(*GOOD.values())).count() == len(GOOD)


def test_values_and_types(lines_of):
    trips = decode_trips(lines_of(line()))
    assert trips.schema == TRIP_SCHEMA or [f.dataType for f in trips.schema] == [
        f.dataType for f in TRIP_SCHEMA
    ]
    row = trips.first()
    single = struct.unpack("f", struct.pack("f", -71.05))[0]
    assert row["passenger_count"] == 2 and row["pickup_longitude"] == single
    assert (row["vendor_id"], row["total_amount"]) == ("2", 29.5)


def test_special_numbers(lines_of):
    rows = decode_trips(
        lines_of(GOOD["NaN"], GOOD["infinite"], GOOD["suffix"], GOOD["overflowing double"])
    ).collect()
    assert any(math.isnan(r["total_amount"]) for r in rows)
    assert any(r["tip_amount"] == -math.inf for r in rows)
    assert any(r["trip_distance"] == 1.0 for r in rows)
    assert any(r["fare_amount"] == math.inf for r in rows)


def test_reasons(lines_of):
    expected = {text: reason for text, reason in BAD.values()}
    refused = rejected_lines(decode_lines(lines_of(*expected))).collect()
    assert {r["line"]: r["reject_reason"] for r in refused} == expected


@pytest.mark.parametrize("name", ["header", "only commas", "no value", "33 bits", "inf"])
def test_strict_fails(lines_of, name):
    with pytest.raises(Exception, match="refused trip line"):
        decode_trips(lines_of(line(), BAD[name][0])).collect()


def test_strict_fails_however_few_columns_are_read(lines_of):
    trips = decode_trips(lines_of(line(), BAD["letter"][0]))
    with pytest.raises(Exception, match="refused trip line"):
        trips.count()
    with pytest.raises(Exception, match="refused trip line"):
        trips.select("vendor_id").collect()


def test_quarantine_keeps_the_rest(lines_of):
    mixed = lines_of(*GOOD.values(), *(text for text, _ in BAD.values()))
    assert decode_trips(mixed, mode="quarantine").count() == len(GOOD)
    with pytest.raises(ValueError):
        decode_trips(mixed, mode="lenient")


def test_both_ansi_modes_agree(spark, lines_of):
    mixed = [*GOOD.values(), *(text for text, _ in BAD.values())]
    results = []
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            decoded = decode_lines(lines_of(*mixed))
            results.append(sorted(map(str, decoded.select("reject_reason").collect())))
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
    assert results[0] == results[1]


def test_line_is_split_once(lines_of):
    """The verdict must not be pushed below the split: it would repeat it per check."""
    for half in (accepted_trips, rejected_lines):
        plan = half(decode_lines(lines_of(line())))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == 1


def _jvm_split(text):
    """What a JVM split on a comma gives: trailing empty fields are dropped."""
    parts = text.split(",")
    while len(parts) > 1 and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab ,\n.1", max_size=12), min_size=1, max_size=30))
def test_split_property(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for row in df.select("t", split_fields(F.col("t")).alias("f")).collect():
        assert row["f"] == _jvm_split(row["t"])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.integers(-(2**33), 2**33).map(str),
            st.text(alphabet="0123456789+-. e", max_size=11),
        ),
        min_size=1,
        max_size=120,
    )
)
def test_int_property(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", parse_int32(F.col("t")).alias("n")).collect():
        fits = re.fullmatch(r"[+-]?[0-9]+", row["t"]) and -(2**31) <= int(row["t"]) < 2**31
        assert row["n"] == (int(row["t"]) if fits else None)


JVM_DOUBLE = re.compile(
    r"[+-]?(NaN|Infinity|(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[fFdD]?)", re.ASCII
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.floats().map(repr),
            st.text(alphabet="0123456789.eE+-dfNan ", max_size=8),
            st.sampled_from(["NaN", "-Infinity", "+NaN", "inf", "-inf", "INF", "infinity", "1D"]),
        ),
        min_size=1,
        max_size=120,
    )
)
def test_double_property(lines_of, texts):
    decoded = decode_lines(lines_of(*(line(fare_amount=t) for t in texts)))
    refused = {r["line"] for r in rejected_lines(decoded).collect()}
    for text in texts:
        fits = JVM_DOUBLE.fullmatch(text.strip(" "))
        assert (line(fare_amount=text) not in refused) == bool(fits), text


def test_round_trips(spark, lines_of):
    trips = decode_trips(lines_of(line(), line(vendor_id="1", tip_amount="1.25")))
    assert sorted(decode_trips(encode_lines(trips)).collect()) == sorted(trips.collect())
    assert sorted(decode_json(encode_json(trips)).collect()) == sorted(trips.collect())


def test_literal_record_as_json(spark):
    kinds = [f.dataType.typeName() for f in TRIP_SCHEMA.fields]
    cast = {"string": str, "long": int, "double": float, "float": float}
    one = literal_trips(spark, [[cast[k](v) for k, v in zip(kinds, FIELDS)]])
    text = encode_json(one).first()["value"]
    assert text.startswith(f'{{"vendor_id":"{FIELDS[0]}","tpep_pickup_datetime":"{FIELDS[1]}"')
    assert decode_json(encode_json(one)).collect() == one.collect()


@pytest.mark.parametrize("tail", ["", " ", "\n", "{0} x", "{0}{0}", "{0},{0}", "{0}]", "{0}],[{0}"])
def test_messages_that_are_not_one_document(spark, lines_of, tail):
    document = encode_json(decode_trips(lines_of(line()))).first()["value"]
    message = tail.replace("{0}", document)
    (row,) = decode_documents(lines_of(message)).collect()
    assert (row["reject_reason"], row["line"]) == ("bad document", message)
    assert decode_json(lines_of(message)).first()["vendor_id"] is None
    with pytest.raises(Exception, match="bad document"):
        decode_trips(lines_of(message), form="json").collect()


def test_brackets_in_a_text_are_no_end(lines_of):
    document = encode_json(decode_trips(lines_of(line(vendor_id="]}][{")))).first()["value"]
    assert decode_trips(lines_of(document), form="json").first()["vendor_id"] == "]}][{"


def test_malformed_json_gives_nulls(lines_of):
    row = decode_json(lines_of("{not json"), "k bigint").first()
    assert row["k"] is None


def test_documents(lines_of):
    given = {
        '{"vendor_id":2,"passenger_count":3,"total_amount":8.8,"unknown":1}': None,
        '{"vendor_id":"2","passenger_count":null}': None,
        '{"vendor_id":"2","passenger_count":1.5}': "bad document",
        '{"vendor_id":"2","total_amount":"x"}': "bad document",
        "2,2016": "bad document",
        "{": "bad document",
        None: "no value",
    }
    decoded = decode_documents(lines_of(*given))
    refused = {r["line"]: r["reject_reason"] for r in rejected_lines(decoded).collect()}
    assert refused == {text: reason for text, reason in given.items() if reason}
    good = sorted(accepted_trips(decoded).collect(), key=lambda r: r["passenger_count"])
    assert [(r["vendor_id"], r["passenger_count"], r["total_amount"]) for r in good] == [
        ("2", 0, 0.0), ("2", 3, 8.8),
    ]
    assert good[1]["pickup_longitude"] == 0.0 and good[1]["payment_type"] is None
    with pytest.raises(Exception, match="refused trip line"):
        decode_trips(lines_of("{"), form="json").collect()
    # Reading few columns must not hide a fault in another one.
    wrong = lines_of('{"vendor_id":"2","total_amount":"x"}')
    with pytest.raises(Exception, match="refused trip line"):
        decode_trips(wrong, form="json").select("vendor_id").collect()
    assert decode_trips(wrong, form="json", mode="quarantine").count() == 0
