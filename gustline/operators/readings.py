"""Raw rows to messages, and messages to readings. Every function is narrow (no shuffle) and serves
batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline.functions.signals import quoted, reading_date, reading_time, signal_map, signal_value
from gustline.schemas import MESSAGE_SCHEMA, SIGNAL_OF_FIELD, TIME_FIELD
from gustline.session import stage

# The white space of JSON, which is no content of a message, and its values without parts.
_BLANKS = " \t\r\n"
_SCALAR = r'^(null|true|false|-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?|"([^"\\]|\\.)*")$'


def to_payload(rows: DataFrame) -> DataFrame:
    """Each row as one JSON text in ``value``; NULL fields are left out."""
    return rows.select(F.to_json(F.struct(*(F.col(quoted(name)) for name in rows.columns))).alias("value"))


def raw_text(messages: DataFrame) -> DataFrame:
    """Message bodies as text, for a look at what arrives."""
    return messages.select(F.col("value").cast("string").alias("raw_data"))


def parse_messages(messages: DataFrame, *extra: str) -> DataFrame:
    """Message bodies as a struct ``data``; messages without content are dropped.

    A parsed struct is NULL exactly for a NULL or blank body, so the filter tests the body: a filter
    on the struct would be pushed below the parse and run the parser twice per message. Malformed
    bodies stay, as a struct of NULLs.
    """
    body = F.col("value").cast("string")
    return messages.filter(F.btrim(body, F.lit(_BLANKS)) != "").select(
        *extra, F.from_json(body, MESSAGE_SCHEMA).alias("data")
    )


def shape_readings(parsed: DataFrame, *extra: str) -> DataFrame:
    """Parsed messages as readings: day, time, ingestion day and time, signal map."""
    data = F.col("data")
    time = data.getField(TIME_FIELD)
    return parsed.select(
        *extra,
        reading_date(time).alias("signal_date"),
        reading_time(time).alias("signal_ts"),
        F.current_date().alias("create_date"),
        F.current_timestamp().alias("create_ts"),
        signal_map({key: data.getField(name) for name, key in SIGNAL_OF_FIELD.items()}).alias("signals"),
    )


def parse_readings(messages: DataFrame, *extra: str) -> DataFrame:
    """Messages to readings; ``extra`` columns of the input are carried along."""
    return shape_readings(parse_messages(messages, *extra), *extra)


# Reasons why a message has no place among the readings.
NO_BODY, BLANK, NOT_JSON, NOT_AN_OBJECT, NO_TIME, BAD_TIME = (
    "no body", "blank", "not JSON", "not an object", "no time", "bad time",
)
_DAMAGED = "damaged_text"


def inspect_messages(messages: DataFrame, *extra: str) -> DataFrame:
    """All messages as readings with their ``body`` and the ``problem`` that each has, if any.

    The body is parsed once: the parser itself tells which text it could not read. Nothing is dropped,
    so one pass can be dealt out to a table, a quarantine and a copy.
    """
    body = F.col("value").cast("string")
    shape = T.StructType([*MESSAGE_SCHEMA.fields, T.StructField(_DAMAGED, T.StringType())])
    parsed = messages.select(
        *extra, body.alias("body"), F.from_json(body, shape, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _DAMAGED}).alias("data")
    )
    time, bare = F.col("data").getField(TIME_FIELD), F.btrim("body", F.lit(_BLANKS))
    shaped = shape_readings(parsed, *extra, "body", "data")
    problem = (
        F.when(F.col("body").isNull(), NO_BODY)
        .when(bare == "", BLANK)
        .when(~bare.startswith("{") & (bare.startswith("[") | bare.rlike(_SCALAR)), NOT_AN_OBJECT)
        .when(F.col(f"data.{_DAMAGED}").isNotNull(), NOT_JSON)
        .when(time.isNull(), NO_TIME)
        .when(F.col("signal_ts").isNull(), BAD_TIME)
    )
    return shaped.withColumn("problem", problem).drop("data")


def route(messages: DataFrame, *extra: str) -> tuple[DataFrame, DataFrame]:
    """(readings, damaged messages with body and problem). Both are taken from one written pass, so the
    messages are read and parsed once."""
    inspected = stage(inspect_messages(messages, *extra), "inspected")
    damaged = F.col("problem").isNotNull()
    return inspected.where(~damaged).drop("body", "problem"), inspected.where(damaged).select(*extra, "body", "problem")


def with_validity(readings: DataFrame) -> DataFrame:
    """Add ``is_valid``: whether the reading has a time. Costs no second parse of the message."""
    return readings.withColumn("is_valid", F.col("signal_ts").isNotNull())


def split_invalid(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readings with a time, readings without one), for two sinks. Each part is a pass of its own, so
    split a stored table rather than the parse of a large topic."""
    known = F.col("signal_ts").isNotNull()
    return readings.filter(known), readings.filter(~known)


def promote_signals(readings: DataFrame, columns: Mapping[str, str], kind: str = "float") -> DataFrame:
    """Add typed columns (column name -> signal key) beside the map.

    A scan cannot prune keys inside a map, so a table that is mostly queried for fixed signals
    should store them as columns too: averages then read those columns only.
    """
    return readings.withColumns({name: signal_value(key, kind) for name, key in columns.items()})
