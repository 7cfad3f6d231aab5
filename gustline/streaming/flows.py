"""Publish raw rows to a topic, ingest a topic into the reading table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from gustline.operators.readings import BLANK, NO_BODY, inspect_messages, parse_readings, promote_signals, raw_text, to_payload
from gustline.sources.streams import Endpoint, Output, append_stream, fan_out, open_stream, readmit_late

BATCH = "batch"


def counted(df: DataFrame) -> DataFrame:
    """Count the rows of every micro-batch while it passes (no second pass over the batch)."""
    return df.observe(BATCH, F.count(F.lit(1)).alias("rows"))


def publish(
    spark: SparkSession, rows: Endpoint, topic: Endpoint, checkpoint: str, age: str = "7 days"
) -> DataStreamWriter:
    """Raw rows to JSON messages. Where read files are archived, late ones are let in first."""
    if rows.options.get("cleanSource") == "archive":
        readmit_late(spark, rows, checkpoint, age)
    return append_stream(counted(to_payload(open_stream(spark, rows))), topic, checkpoint)


def tap(spark: SparkSession, topic: Endpoint, sink: Endpoint, checkpoint: str | None = None) -> DataStreamWriter:
    """Message bodies as they arrive, to the console or another sink."""
    return append_stream(raw_text(open_stream(spark, topic)), sink, checkpoint)


def gathered(readings: DataFrame, by: str, tasks: int) -> DataFrame:
    """Bring the rows of each ``by`` value to at most ``tasks`` tasks. The salt is the number of the
    input task, so even copies of one row, or one day with most rows, are spread."""
    salted = readings.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(tasks)))
    return salted.repartition(by, "_salt").drop("_salt")


def ingest(
    spark: SparkSession,
    topic: Endpoint,
    table: Endpoint,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    promoted: Mapping[str, str] | None = None,
    tasks_per_day: int | None = None,
) -> DataStreamWriter:
    """Messages to the reading table. The stream is narrow from source to sink: no shuffle, no state.

    A replayed batch is not appended twice (see ``append_stream``). ``promoted`` (column ->
    signal key) stores signals as float columns beside the map. ``tasks_per_day`` is for a backlog
    that mixes many days, where each task would otherwise write one small file per day: it adds one
    shuffle and bounds the files of a day and batch. Size it by a day's volume, since days ×
    ``tasks_per_day`` tasks do the writing.
    """
    readings = parse_readings(open_stream(spark, topic))
    if promoted:
        readings = promote_signals(readings, promoted)
    if tasks_per_day:
        readings = gathered(readings, "signal_date", tasks_per_day)
    return append_stream(counted(readings), table, checkpoint, partition_by)


def distribute(
    spark: SparkSession,
    topic: Endpoint,
    checkpoint: str,
    table: Endpoint,
    tap: Endpoint | None = None,
    quarantine: Endpoint | None = None,
    partition_by: Sequence[str] = (),
) -> DataStreamWriter:
    """Messages to the reading table, copies of all bodies to ``tap``, and damaged messages with their
    body and reason to ``quarantine``: the topic is read and parsed once per batch for all of them.

    Without a quarantine damaged messages but for blank ones become readings of NULLs, as in ``ingest``.
    """
    columns = ["signal_date", "signal_ts", "create_date", "create_ts", "signals"]
    left_out = F.col("problem").isNotNull() if quarantine is not None else F.coalesce("problem", F.lit("")).isin(NO_BODY, BLANK)
    outputs = {"table": Output(table, lambda batch: batch.where(~left_out).select(*columns), partition_by)}
    if tap is not None:
        outputs["tap"] = Output(tap, lambda batch: batch.where("body is not null").select(F.col("body").alias("value")))
    if quarantine is not None:
        damaged = ("body", "problem", "create_date", "create_ts")
        outputs["quarantine"] = Output(quarantine, lambda batch: batch.where("problem is not null").select(*damaged))
    return fan_out(inspect_messages(open_stream(spark, topic)), outputs, checkpoint)
