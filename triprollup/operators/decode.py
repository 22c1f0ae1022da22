"""From message text to typed trips and back."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triprollup.functions.text import is_misread, parse_int32, split_fields
from triprollup.schemas import LINE, REASON, TRIP_COLUMNS, TRIP_SCHEMA

FIELDS = "_fields"
CORRUPT = "_corrupt"
STRICT, QUARANTINE = "strict", "quarantine"
CSV, JSON = "csv", "json"


def _read_field(fields: Column, position: int, kind: T.DataType) -> Column:
    text = F.get(fields, F.lit(position))
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.LongType):
        return parse_int32(text)
    return text.try_cast(kind)


def _verdict(line: Column, fields: Column) -> Column:
    """Why a line is refused (its first fault from the left), or null."""
    reason = F.when(line.isNull(), "no value").when(
        F.size(fields) != len(TRIP_COLUMNS), "arity"
    )
    for position, field in enumerate(TRIP_SCHEMA.fields):
        value = F.col(field.name)
        if isinstance(field.dataType, T.LongType):
            fault = value.isNull()
        elif isinstance(field.dataType, T.FractionalType):
            fault = is_misread(value, F.get(fields, F.lit(position)))
        else:
            continue
        reason = reason.when(fault, f"bad {field.name}")
    return reason


def decode_lines(
    messages: DataFrame, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Type every line, without judging what becomes of the faulty ones.

    Gives the ``keep`` columns, the 19 trip columns, ``reject_reason`` (null for a good
    line) and ``line`` (the text of a faulty one). Follow it with
    :func:`accepted_trips`, :func:`rejected_lines` or :func:`require_valid`.
    """
    line = F.col(value)
    typed = messages.select(
        *keep, line.alias(LINE), split_fields(line).alias(FIELDS)
    ).select(
        *keep,
        LINE,
        FIELDS,
        *(
            _read_field(F.col(FIELDS), position, field.dataType).alias(field.name)
            for position, field in enumerate(TRIP_SCHEMA.fields)
        ),
    )
    judged = typed.select(
        *keep,
        *TRIP_COLUMNS,
        _verdict(F.col(LINE), F.col(FIELDS)).alias(REASON),
        LINE,
    ).select(
        *keep,
        *TRIP_COLUMNS,
        REASON,
        F.when(F.col(REASON).isNotNull(), F.col(LINE)).alias(LINE),
    )
    return _evaluated_once(judged)


def _evaluated_once(judged: DataFrame) -> DataFrame:
    """Keep filters on the verdict above the decoding.

    Pushed below the projections, a filter would split the line once more for every
    check in it, which takes 25 times as long. Filters are not pushed through a
    generator.
    """
    return judged.select(F.inline(F.array(F.struct("*"))))


def decode_documents(
    messages: DataFrame, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """:func:`decode_lines` for messages that hold a trip as a JSON document.

    A document that is malformed or has a field of the wrong type is faulty, as is a
    message that is blank or holds anything besides one document. A number that is absent
    is 0, as in a record of primitive fields; an absent text is null.
    """
    line = F.col(value)
    schema = T.StructType([*TRIP_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    record = F.from_json(line, schema, {"columnNameOfCorruptRecord": CORRUPT})
    parsed = messages.select(*keep, line.alias(LINE), record.alias(FIELDS)).select(
        *keep, LINE, f"{FIELDS}.*"
    )
    typed = parsed.select(
        *keep,
        *(
            F.col(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)).alias(f.name)
            for f in TRIP_SCHEMA.fields
        ),
        F.when(F.col(LINE).isNull(), "no value")
        .when(F.col(CORRUPT).isNotNull() | ~is_one_document(F.col(LINE)), "bad document")
        .alias(REASON),
        LINE,
    )
    return _evaluated_once(
        typed.withColumn(LINE, F.when(F.col(REASON).isNotNull(), F.col(LINE)))
    )


def is_one_document(line: Column) -> Column:
    """Whether a message is one JSON value that is not followed or preceded by anything.

    A parser stops behind the first value, so the message is read as the first of two elements
    of an array. The second is a word that no message can know: one that closes the array itself,
    or holds several values, has something else in its place.
    """
    word = uuid4().hex
    whole = F.concat(F.lit("["), line, F.lit(f',"{word}"]'))
    return F.get_json_object(whole, "$[1]").eqNullSafe(word)


DECODERS = {CSV: decode_lines, JSON: decode_documents}


def decode_messages(
    messages: DataFrame, value: str = "value", keep: Sequence[str] = (), form: str = CSV
) -> DataFrame:
    """:func:`decode_lines` or :func:`decode_documents`, by the form of the messages."""
    if form not in DECODERS:
        raise ValueError(f"form must be {CSV!r} or {JSON!r}, not {form!r}")
    return DECODERS[form](messages, value, keep)


def accepted_trips(decoded: DataFrame) -> DataFrame:
    """The good lines of a decoded frame."""
    return decoded.filter(F.col(REASON).isNull()).drop(REASON, LINE)


def rejected_lines(decoded: DataFrame) -> DataFrame:
    """The faulty lines of a decoded frame with the reason; trip columns are dropped."""
    return decoded.filter(F.col(REASON).isNotNull()).drop(*TRIP_COLUMNS)


def require_valid(decoded: DataFrame) -> DataFrame:
    """The trips, or a failing job as soon as one line is faulty.

    The check sits in a filter, so it runs however few columns are read afterwards.
    """
    text = F.coalesce(LINE, F.lit("null"))
    message = F.concat(F.lit("refused trip line, "), REASON, F.lit(": "), text)
    checked = F.assert_true(F.col(REASON).isNull(), message)
    return decoded.filter(checked.isNull()).drop(REASON, LINE)


def decode_trips(
    messages: DataFrame,
    value: str = "value",
    mode: str = STRICT,
    keep: Sequence[str] = (),
    form: str = CSV,
) -> DataFrame:
    """Trips from messages; a faulty one fails the job, or in quarantine mode is left out."""
    decoded = decode_messages(messages, value, keep, form)
    if mode == STRICT:
        return require_valid(decoded)
    if mode == QUARANTINE:
        return accepted_trips(decoded)
    raise ValueError(f"mode must be {STRICT!r} or {QUARANTINE!r}, not {mode!r}")


def encode_lines(
    trips: DataFrame, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """One comma-separated line per trip; the inverse of :func:`decode_trips`."""
    fields = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in TRIP_COLUMNS)
    return trips.select(*keep, F.concat_ws(",", *fields).alias(value))


def encode_json(
    records: DataFrame, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """One JSON document per row, of all columns but ``keep``."""
    document = F.struct(*(c for c in records.columns if c not in keep))
    return records.select(*keep, F.to_json(document).alias(value))


def decode_json(
    messages: DataFrame,
    schema: T.StructType | str = TRIP_SCHEMA,
    value: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed columns from JSON documents.

    A message that is malformed, blank, or more than one document gives nulls.
    """
    whole = F.when(is_one_document(F.col(value)), F.col(value))
    return messages.select(*keep, F.from_json(whole, schema).alias("_record")).select(
        *keep, "_record.*"
    )
