"""Registered queries: each takes (session, folder of the given tables) and returns a frame.

All of them start from the whole ``events`` table. Computed doubles are cut to a few digits because
the order of a distributed sum is free; maps and vectors are flattened so that the SQL twins in
``oracles`` can be compared column by column.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.functions.bands import band
from gustline.functions.signals import quoted, signal_text, signal_value
from gustline.functions.split import hour_key, split_position
from gustline.operators.aggregates import (
    daily_distinct_derived,
    daily_distinct_stored,
    hourly_from_columns,
    hourly_from_map,
    with_band,
)
from gustline.operators.evaluation import density, histogram, joint_counts, metrics, not_finite, with_residual
from gustline.operators.features import TRAIN_SHARE, assembler, exact_split, fit_index, keyed_split, random_split
from gustline.operators.models import DEEPEST, fit_flow, linear, score_day, side_by_side, tree
from gustline.operators.readings import parse_readings, promote_signals, raw_text, route, to_payload, with_validity
from gustline.operators.renaming import long_form, map_names, rename_columns
from gustline.operators.selection import quantiles
from gustline.plans.flows import banded_rows, hourly_status, typed_readings
from gustline.schemas import (
    FEATURES,
    HOURLY_MAPPING,
    LABEL,
    LINE_SCHEMA,
    POWER_KEY,
    READING_SCHEMA,
    SIGNAL_KEYS,
    SIGNAL_OF_FIELD,
    STATUS,
    STATUS_INDEX,
    TIME_FIELD,
    TOTALS_SCHEMA,
    TYPED_AVERAGES,
)
from gustline.session import scratch_path, stage
from gustline.sources.commits import located, names_in
from gustline.sources.driver_tables import events, readings_from_events, rows_from_events
from gustline.sources.streams import Endpoint, append_stream, csv_landing, open_stream, table_sink, text_topic
from gustline.sources.tables import (
    append_table,
    batch_sizes,
    inline_relation,
    mapping_relation,
    mapping_view,
    preview,
    read_table,
    replace_table,
)
from gustline.streaming.flows import distribute, ingest, publish, tap
from gustline.streaming.runs import lifetime_batches, run_bounded

Query = Callable[[SparkSession, str], DataFrame]

SCORED_DAY = dt.date(2024, 1, 19)
HISTOGRAM_BINS = 20
JOINT_BINS = 10
CURVE_POINTS = 50
CURVE_CELLS = 512
GRID_OFFSET = 0.3719
IDS = ("signal_date", "hour")

# column names the flattened signals get in results
FLAT_NAMES = dict(zip(SIGNAL_KEYS, ("power", "speed", "curve", "direction"), strict=True))


def _cut(value: Column, digits: int) -> Column:
    """Value on a grid of ``digits`` decimals. Plain rounding switches at a half, where averages of
    decimal values do fall, and the last bit of a sum would decide; here the switch lies at an
    offset that they do not hit."""
    scale = F.lit(10.0**digits)
    return F.floor(value * scale + F.lit(GRID_OFFSET)) / scale


def _rounded(df: DataFrame, digits: int) -> DataFrame:
    names = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: _cut(F.col(quoted(name)), digits) for name in names})


def _flat_signals(kind: str = "double", digits: int = 6) -> list[Column]:
    return [_cut(signal_value(key, kind), digits).alias(name) for key, name in FLAT_NAMES.items()]


def _flat_readings(readings: DataFrame, *extra: str) -> DataFrame:
    """Comparable columns of readings: no ingestion time, no zone, no map."""
    return readings.select(
        *extra, "signal_date", F.col("signal_ts").cast("timestamp_ntz").alias("signal_ts"), *_flat_signals()
    )


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    return readings_from_events(events(spark, folder))


def _hourly(spark: SparkSession, folder: str) -> DataFrame:
    return hourly_status(_readings(spark, folder))


# --- analytics ---------------------------------------------------------------------------------


def q_hourly_status(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_hourly(spark, folder), 6)


def q_daily_distinct_derived(spark: SparkSession, folder: str) -> DataFrame:
    return daily_distinct_derived(_readings(spark, folder))


def q_daily_distinct_stored(spark: SparkSession, folder: str) -> DataFrame:
    return daily_distinct_stored(_readings(spark, folder))


def q_hourly_averages_typed(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(hourly_from_columns(typed_readings(_readings(spark, folder)), TYPED_AVERAGES), 6)


def q_hourly_averages_map(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(hourly_from_map(_readings(spark, folder)), 6)


def q_repeated_ingestion(spark: SparkSession, folder: str) -> DataFrame:
    """The same readings four times over: hourly averages do not move."""
    once = _readings(spark, folder)
    return _rounded(hourly_from_map(once.unionAll(once).unionAll(once).unionAll(once)), 6)


def q_repeated_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """The same readings twice: distinct counts do not move."""
    once = _readings(spark, folder)
    return daily_distinct_stored(once.unionAll(once))


def q_band_rows(spark: SparkSession, folder: str) -> DataFrame:
    readings = readings_from_events(events(spark, folder), "event_id")
    banded = with_band(readings, signal_value(POWER_KEY, "double"))
    return banded.select("event_id", "generation_indicator")


def q_band_null(spark: SparkSession, folder: str) -> DataFrame:
    """Hours without a usable power: the rest band, or a label of their own."""
    source = events(spark, folder).withColumn("value", F.when(F.col("user_id") % 7 == 0, F.col("value")))
    averages = hourly_from_map(readings_from_events(source))
    power = F.col(f"avg_{POWER_KEY}")
    return averages.select(
        *IDS, band(power).alias("generation_indicator"), band(power, null_label="Unknown").alias("with_null_label")
    )


def q_absent_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Looking signals up under raw field names, which are not keys of the map: NULL throughout."""
    names = {name: name for name in SIGNAL_OF_FIELD}
    found = promote_signals(_readings(spark, folder), names, "double")
    averages = hourly_from_columns(found, TYPED_AVERAGES)
    return with_band(averages, F.col("avg_active_power"))


def q_mapping_union(spark: SparkSession, folder: str) -> DataFrame:
    """The whole hourly frame renamed by a view made of literal SELECTs, once through the schema and
    once as data: average per mapped name."""
    mapping = mapping_view(spark, HOURLY_MAPPING, "catalog_mapping")
    averages = hourly_from_map(_readings(spark, folder))
    named = map_names(long_form(averages, IDS), mapping, IDS, averages.columns)
    return named.groupBy("sig_mapping_name").agg(
        F.count("value").alias("hours"), _cut(F.avg("value"), 6).alias("value")
    )


def q_mapping_inline(spark: SparkSession, folder: str) -> DataFrame:
    """Row-level frame with its band, renamed by an inline relation."""
    typed = typed_readings(readings_from_events(events(spark, folder), "event_id"), "event_id")
    return _rounded(banded_rows(typed), 6)


def q_rename_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Renaming with pairs about columns that do not exist: those are skipped."""
    pairs = [("no_such_column", "nothing"), *HOURLY_MAPPING[:2]]
    return _rounded(rename_columns(hourly_from_map(_readings(spark, folder)), mapping_relation(spark, pairs)), 6)


def q_mapping_broadcast_join(spark: SparkSession, folder: str) -> DataFrame:
    averages = hourly_from_map(_readings(spark, folder))
    mapping = mapping_relation(spark, HOURLY_MAPPING)
    return _rounded(map_names(long_form(averages, IDS), mapping, IDS, averages.columns), 6)


def q_day_filter(spark: SparkSession, folder: str) -> DataFrame:
    hourly = _hourly(spark, folder)
    return _rounded(hourly.filter(F.col("signal_date") == F.lit(SCORED_DAY)), 6)


def q_top_hours(spark: SparkSession, folder: str) -> DataFrame:
    """First 20 hours in time order."""
    averages = hourly_from_map(_readings(spark, folder))
    return _rounded(preview(averages, 20, IDS), 6)


def q_preview_rows(spark: SparkSession, folder: str) -> DataFrame:
    """First 20 readings in time order, signals as stored text."""
    readings = readings_from_events(events(spark, folder), "event_id")
    top = preview(readings, 20, ["signal_ts", "event_id"])
    return top.select("event_id", "signal_ts", signal_text("WindDirection_deg").alias("direction_text"))


def q_feature_select(spark: SparkSession, folder: str) -> DataFrame:
    indexed = _indexed(spark, folder)
    return _rounded(indexed.select(*FEATURES, LABEL), 6)


# --- messages ----------------------------------------------------------------------------------


def q_payload_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Rows to JSON and back; the body travels as bytes."""
    messages = to_payload(rows_from_events(events(spark, folder))).select(F.col("value").cast("binary"))
    return _flat_readings(parse_readings(messages)).drop("signal_date")


def q_parse_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Readings with their event: payload built next to the id and parsed in place."""
    rows = rows_from_events(events(spark, folder), "event_id")
    fields = F.struct(TIME_FIELD, *(F.col(quoted(name)) for name in SIGNAL_OF_FIELD))
    messages = rows.select("event_id", F.to_json(fields).alias("value"))
    return _flat_readings(parse_readings(messages, "event_id"), "event_id")


def q_invalid_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Messages damaged by event type: cut text, no time field, a JSON null, a blank, an empty array.
    Only blanks are dropped; the others stay as readings, split by whether they have a time."""
    rows = rows_from_events(events(spark, folder), "event_id", "event_type")
    values = [F.col(quoted(name)) for name in SIGNAL_OF_FIELD]
    whole = F.to_json(F.struct(F.col(quoted(TIME_FIELD)), *values))
    body = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), whole))
        .when(F.col("event_type") == "purchase", F.to_json(F.struct(*values)))
        .when((F.col("event_type") == "signup") & (F.col("event_id") % 2 == 0), F.lit("null"))
        .when(F.col("event_type") == "signup", F.lit("[]"))
        .when((F.col("event_type") == "view") & (F.col("event_id") % 2 == 0), F.lit(" \t"))
        .otherwise(whole)
    )
    messages = rows.select("event_type", body.alias("value"))
    return with_validity(parse_readings(messages, "event_type")).groupBy("event_type", "is_valid").agg(
        F.count(F.lit(1)).alias("rows"), F.count(signal_text(POWER_KEY)).alias("with_power")
    )


def _damaged(rows: DataFrame) -> Column:
    """Message bodies damaged by event type: cut text, no time field, values that are no object, blanks,
    a time that is none."""
    values = [F.col(quoted(name)) for name in SIGNAL_OF_FIELD]
    whole = F.to_json(F.struct(F.col(quoted(TIME_FIELD)), *values))
    late = F.to_json(F.struct(F.concat(F.lit("on "), F.col(quoted(TIME_FIELD))).alias(TIME_FIELD), *values))
    even = F.col("event_id") % 2 == 0
    return (
        F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), whole))
        .when((F.col("event_type") == "purchase") & even, F.to_json(F.struct(*values)))
        .when(F.col("event_type") == "purchase", late)
        .when((F.col("event_type") == "signup") & even, F.lit("null"))
        .when(F.col("event_type") == "signup", F.lit("[]"))
        .when((F.col("event_type") == "view") & even, F.lit(" \t"))
        .otherwise(whole)
    )


def q_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Every damaged message with its reason and whether its body was kept as sent, beside the good ones."""
    rows = rows_from_events(events(spark, folder), "event_id", "event_type")
    messages = rows.select("event_id", _damaged(rows).alias("value"))
    good, damaged = route(messages, "event_id", "value")
    kept = damaged.select("event_id", "problem", F.col("body").eqNullSafe(F.col("value")).alias("body_kept"))
    return kept.unionByName(good.select("event_id", F.lit(None).cast("string").alias("problem"), F.lit(None).cast("boolean").alias("body_kept")))


# --- sinks and streams -------------------------------------------------------------------------


def q_append_then_read(spark: SparkSession, folder: str) -> DataFrame:
    """Two appends to a table, then a scan."""
    path = scratch_path(spark, "append")
    readings = _readings(spark, folder)
    for _ in range(2):
        append_table(readings, path)
    return _flat_readings(read_table(spark, path, schema=readings.schema))


def q_overwrite_then_read(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly table replaced twice and read back: one copy remains."""
    path = scratch_path(spark, "replace")
    hourly = _hourly(spark, folder)
    for _ in range(2):
        replace_table(hourly, path)
    return _rounded(read_table(spark, path, schema=hourly.schema), 6)


def _landed(spark: SparkSession, folder: str) -> str:
    """Raw rows of all events as CSV files in a landing directory; the power of an ``error`` event is
    not a number."""
    path = scratch_path(spark, "landing")
    power = next(iter(SIGNAL_OF_FIELD))
    rows = rows_from_events(events(spark, folder), "event_type")
    damaged = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col(quoted(power)).cast("string"))
    rows.withColumn(power, damaged).drop("event_type").write.option("header", "true").csv(path)
    return path


def _topic(spark: SparkSession, folder: str) -> str:
    """All events as messages in a topic directory."""
    path = scratch_path(spark, "topic")
    to_payload(rows_from_events(events(spark, folder))).write.text(path)
    return path


def q_csv_stream(spark: SparkSession, folder: str) -> DataFrame:
    """CSV directory stream to a table; a cell that is not a number is NULL."""
    path = scratch_path(spark, "rows")
    rows = open_stream(spark, csv_landing(_landed(spark, folder)))
    named = rows.withColumnsRenamed(dict(zip(rows.columns, ("time_text", *FLAT_NAMES.values()), strict=True)))
    run_bounded(append_stream(named, table_sink(path), scratch_path(spark, "rows-checkpoint")))
    return _rounded(read_table(spark, path, schema=named.schema), 6)


def q_stream_publish(spark: SparkSession, folder: str) -> DataFrame:
    """CSV stream to JSON messages; the topic is read back as readings."""
    topic = scratch_path(spark, "published")
    landing = csv_landing(_landed(spark, folder))
    run_bounded(publish(spark, landing, text_topic(topic), scratch_path(spark, "publish-checkpoint")))
    messages = read_table(spark, topic, "text")
    return _flat_readings(parse_readings(messages))


def q_raw_tap(spark: SparkSession, folder: str) -> DataFrame:
    """Message bodies copied as they are."""
    path = scratch_path(spark, "tap")
    topic = text_topic(_topic(spark, folder))
    run_bounded(tap(spark, topic, text_topic(path), scratch_path(spark, "tap-checkpoint")))
    body = F.col("value")
    power = F.get_json_object(body, "$['LV ActivePower (kW)']").try_cast("double")
    return read_table(spark, path, "text").select(
        F.get_json_object(body, "$['Date/Time']").alias("time_text"), _cut(power, 6).alias("power")
    )


def q_stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """CSV stream to topic, topic stream to the reading table; a second run finds nothing new."""
    topic = scratch_path(spark, "ingest-topic")
    table = scratch_path(spark, "readings")
    sent, stored = scratch_path(spark, "sent"), scratch_path(spark, "stored")
    landing = csv_landing(_landed(spark, folder))
    for _ in range(2):
        run_bounded(publish(spark, landing, text_topic(topic), sent))
        run_bounded(ingest(spark, text_topic(topic), table_sink(table), stored))
    return _flat_readings(read_table(spark, table, schema=READING_SCHEMA))


def q_stream_to_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Topic stream to a reading table with promoted signals, partitioned by day, then the hourly
    averages from the promoted columns."""
    table = scratch_path(spark, "promoted")
    promoted = {f"signal_{name}": key for key, name in FLAT_NAMES.items()}
    topic = text_topic(_topic(spark, folder))
    checkpoint = scratch_path(spark, "promoted-checkpoint")
    run_bounded(ingest(spark, topic, table_sink(table), checkpoint, ["signal_date"], promoted))
    names = {column: f"avg_{name}" for column, name in zip(promoted, FLAT_NAMES.values(), strict=True)}
    return _rounded(hourly_from_columns(read_table(spark, table), names), 6)


def q_batch_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per micro-batch and running total over two ingestions of the same events, the second run
    resuming from the first one's checkpoint."""
    topic, table = scratch_path(spark, "counted-topic"), scratch_path(spark, "counted")
    checkpoint = scratch_path(spark, "counted-checkpoint")
    for _ in range(2):
        to_payload(rows_from_events(events(spark, folder))).write.mode("append").text(topic)
        run_bounded(ingest(spark, text_topic(topic), table_sink(table), checkpoint))
    return batch_sizes(read_table(spark, table, schema=READING_SCHEMA)).select("batch_rows", "total_rows")


def q_repeated_streams(spark: SparkSession, folder: str) -> DataFrame:
    """Two ingestions with checkpoints of their own into one table, then a batch append to it."""
    topic, table = scratch_path(spark, "shared-topic"), scratch_path(spark, "shared-readings")
    landing = csv_landing(_landed(spark, folder))
    run_bounded(publish(spark, landing, text_topic(topic), scratch_path(spark, "shared-sent")))
    for number in range(2):
        run_bounded(ingest(spark, text_topic(topic), table_sink(table), scratch_path(spark, f"shared-stored-{number}")))
    append_table(parse_readings(read_table(spark, topic, "text")), table)
    return _flat_readings(read_table(spark, table, schema=READING_SCHEMA))


def q_trailing_time_text(spark: SparkSession, folder: str) -> DataFrame:
    """Text behind the minutes does not matter to the time."""
    rows = rows_from_events(events(spark, folder), "event_id")
    tail = F.element_at(F.array(*map(F.lit, ("", " abc", "abc", " PM", ":59"))), (F.col("event_id") % 5 + 1).cast("int"))
    rows = rows.withColumn(TIME_FIELD, F.concat(F.col(quoted(TIME_FIELD)), tail))
    messages = rows.select("event_id", F.to_json(F.struct(F.col(quoted(TIME_FIELD)))).alias("value"))
    return parse_readings(messages, "event_id").select(
        "event_id", "signal_date", F.col("signal_ts").cast("timestamp_ntz").alias("signal_ts")
    )


def _date_back(spark: SparkSession, landing: str, names: set[str] | None = None) -> None:
    """Give files of a folder (all, or those named) a date forty days back."""
    location, files = located(spark, landing)
    forty_days_ago = int((time.time() - 40 * 86400) * 1000)
    for file in files.listStatus(location):
        if names is None or file.getPath().getName() in names:
            files.setTimes(file.getPath(), forty_days_ago, -1)


def q_old_landing_files(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the landing files arrive after a first run, dated forty days back."""
    landing, path, checkpoint = (scratch_path(spark, name) for name in ("late-landing", "late-rows", "late-checkpoint"))
    whole = _landed(spark, folder)
    lines = spark.read.option("header", "true").csv(whole)
    names = lines.columns
    for number in range(2):
        part = lines.filter(F.pmod(F.xxhash64(quoted(names[0])), F.lit(2)) == number)
        part.write.mode("append").option("header", "true").csv(landing)
        if number:
            _date_back(spark, landing)
        rows = open_stream(spark, csv_landing(landing))
        named = rows.withColumnsRenamed(dict(zip(rows.columns, ("time_text", *FLAT_NAMES.values()), strict=True)))
        run_bounded(append_stream(named, table_sink(path), checkpoint))
    return _rounded(read_table(spark, path, schema=named.schema), 6)


def q_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    """One stream into three sinks: the reading table, copies of all bodies, damaged messages."""
    rows = rows_from_events(events(spark, folder), "event_id", "event_type")
    topic, table, copies, damaged = (scratch_path(spark, f"fan-{name}") for name in ("topic", "table", "tap", "damaged"))
    rows.select(_damaged(rows).alias("value")).write.text(topic)
    writer = distribute(
        spark, text_topic(topic), scratch_path(spark, "fan-checkpoint"), table_sink(table), text_topic(copies), table_sink(damaged)
    )
    run_bounded(writer)
    readings = read_table(spark, table, schema=READING_SCHEMA)
    power = _cut(signal_value(POWER_KEY, "double"), 6)
    copied = F.get_json_object("value", "$['LV ActivePower (kW)']").try_cast("double")
    none = F.lit(None).cast("string")
    return (
        readings.select(F.lit("table").alias("sink"), none.alias("problem"), power.alias("power"))
        .unionByName(read_table(spark, copies, "text").select(F.lit("tap").alias("sink"), none.alias("problem"), _cut(copied, 6).alias("power")))
        .unionByName(read_table(spark, damaged).select(F.lit("quarantine").alias("sink"), "problem", F.lit(None).cast("double").alias("power")))
    )


def q_failed_replacement(spark: SparkSession, folder: str) -> DataFrame:
    """A table, a replacement of it that fails half-way, then one that is made of the table itself."""
    path = scratch_path(spark, "kept")
    hourly = _hourly(spark, folder)
    replace_table(hourly, path)
    failing = hourly.withColumn("hour", F.when(F.col("hour") < 23, F.col("hour")).otherwise(F.raise_error(F.lit("stop")).cast("int")))
    try:
        replace_table(failing, path)
    except Exception as error:  # noqa: BLE001  the failure is the point
        if "stop" not in str(error):
            raise
    replace_table(read_table(spark, path, schema=hourly.schema).filter("hour % 2 = 0"), path)
    return _rounded(read_table(spark, path, schema=hourly.schema), 6)


def q_archived_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Landing files that are archived once read; the last third arrives dated forty days back."""
    landing, archive, path, checkpoint = (scratch_path(spark, f"archived-{name}") for name in ("in", "read", "rows", "checkpoint"))
    lines = spark.read.option("header", "true").csv(_landed(spark, folder))
    names = lines.columns
    source = csv_landing(landing, archive)
    for number in range(3):
        there = set(names_in(spark, landing))
        part = lines.filter(F.pmod(F.xxhash64(quoted(names[0])), F.lit(3)) == number)
        part.write.mode("append").option("header", "true").csv(landing)
        if number == 2:
            _date_back(spark, landing, set(names_in(spark, landing)) - there)
        run_bounded(publish(spark, source, text_topic(path), checkpoint))
    messages = read_table(spark, path, "text")
    return _flat_readings(parse_readings(messages))


def q_stream_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all batches of a stream into a sink without files, told by the engine's events and kept
    over two runs of six batches each."""
    topic, checkpoint = scratch_path(spark, "totals-topic"), scratch_path(spark, "totals-checkpoint")
    messages = to_payload(rows_from_events(events(spark, folder)))
    for _ in range(2):
        messages.repartition(6).write.mode("append").text(topic)
        source = open_stream(spark, text_topic(topic, maxFilesPerTrigger="1"))
        run_bounded(append_stream(raw_text(source), Endpoint("noop"), checkpoint))
    return inline_relation(spark, lifetime_batches(spark, checkpoint), TOTALS_SCHEMA).agg(
        F.count("batch").alias("batches"), F.sum("rows").alias("rows")
    )


# --- features and models -----------------------------------------------------------------------


def _stored_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly table, computed once and read back by every job that follows."""
    return stage(_hourly(spark, folder), "hourly")


def _indexed(spark: SparkSession, folder: str) -> DataFrame:
    hourly = _stored_hourly(spark, folder)
    return fit_index(hourly).transform(hourly)


def q_status_index(spark: SparkSession, folder: str) -> DataFrame:
    return _indexed(spark, folder).select(*IDS, STATUS, STATUS_INDEX)


def q_feature_vector(spark: SparkSession, folder: str) -> DataFrame:
    vector = vector_to_array("features")
    assembled = assembler().transform(_indexed(spark, folder))
    parts = [_cut(vector[i], 6).alias(f"feature_{i}") for i in range(len(FEATURES))]
    return assembled.select(*IDS, *parts)


def q_keyed_split(spark: SparkSession, folder: str) -> DataFrame:
    train, test = keyed_split(_hourly(spark, folder), hour_key())
    tagged = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return tagged.select(*IDS, "part")


def q_keyed_split_events(spark: SparkSession, folder: str) -> DataFrame:
    """Size of the split over all events, by their id."""
    side = F.when(split_position(F.col("event_id")) < F.lit(TRAIN_SHARE), "train").otherwise("test")
    return events(spark, folder).groupBy(side.alias("part")).agg(F.count(F.lit(1)).alias("rows"))


def q_exact_split(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly rows with their side of a split of exact size."""
    train, test = exact_split(_stored_hourly(spark, folder), hour_key())
    tagged = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return tagged.select(*IDS, "part")


def q_exact_split_events(spark: SparkSession, folder: str) -> DataFrame:
    """All events with their side of a split of exact size."""
    train, test = exact_split(events(spark, folder).select("event_id"), F.col("event_id"))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def q_random_split_cover(spark: SparkSession, folder: str) -> DataFrame:
    """A random split takes every row exactly once."""
    parts = random_split(_stored_hourly(spark, folder))
    keys = parts[0].select(*IDS).unionAll(parts[1].select(*IDS))
    return keys.groupBy("signal_date").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("hour").alias("distinct_hours")
    )


def q_linear_one_feature(spark: SparkSession, folder: str) -> DataFrame:
    hourly = _stored_hourly(spark, folder)
    train, _ = keyed_split(hourly, hour_key())
    line = fit_flow(hourly, train, linear(), ["wind_speed_average"]).stages[-1]
    row = (float(line.coefficients[0]), float(line.intercept))
    return _rounded(inline_relation(spark, [row], LINE_SCHEMA), 6)


def _linear_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows scored by the linear model over the default features."""
    hourly = _stored_hourly(spark, folder)
    train, test = keyed_split(hourly, hour_key())
    return fit_flow(hourly, train, linear()).transform(test)


def q_linear_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_linear_scored(spark, folder).select(*IDS, LABEL, "prediction"), 4)


def q_tree_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Tree of the default depth over the default features."""
    hourly = _stored_hourly(spark, folder)
    train, test = keyed_split(hourly, hour_key())
    scored = fit_flow(hourly, train, tree()).transform(test)
    return _rounded(scored.select(*IDS, LABEL, "prediction"), 4)


def q_tree_full_depth(spark: SparkSession, folder: str) -> DataFrame:
    """A tree grown until its leaves are single feature values predicts the average of each value."""
    hourly = _stored_hourly(spark, folder)
    train, test = keyed_split(hourly, hour_key())
    scored = fit_flow(hourly, train, tree(max_depth=DEEPEST), ["hour"]).transform(test)
    return _rounded(scored.select(*IDS, LABEL, "prediction"), 4)


def q_score_day(spark: SparkSession, folder: str) -> DataFrame:
    hourly = _stored_hourly(spark, folder)
    train, _ = keyed_split(hourly, hour_key())
    return _rounded(score_day(fit_flow(hourly, train, linear()), hourly, SCORED_DAY), 4)


# --- evaluation --------------------------------------------------------------------------------


def q_regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics(_linear_scored(spark, folder), LABEL), 4)


def _residuals(spark: SparkSession, folder: str) -> DataFrame:
    return with_residual(_linear_scored(spark, folder), LABEL)


def q_residuals(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_residuals(spark, folder).select(*IDS, "residual"), 4)


def q_residual_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(histogram(_residuals(spark, folder), "residual", HISTOGRAM_BINS), 4)


def q_residual_histogram_auto(spark: SparkSession, folder: str) -> DataFrame:
    """Residual histogram with as many bins as the rows and their quartiles ask for."""
    return _rounded(histogram(_residuals(spark, folder), "residual"), 4)


def q_event_quartiles(spark: SparkSession, folder: str) -> DataFrame:
    """Exact quartiles of the values of all events, and the rows that have no place among them."""
    source = events(spark, folder)
    low, middle, high = quantiles(source, "value", (0.25, 0.5, 0.75))
    left_out = not_finite(source, "value").select("missing", "not_a_number", "infinite")
    return left_out.select(*(_cut(F.lit(x), 6).alias(name) for name, x in (("low", low), ("middle", middle), ("high", high))), "missing", "not_a_number", "infinite")


def q_residual_density(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(density(_residuals(spark, folder), "residual", CURVE_POINTS, CURVE_CELLS), 6)


def q_actual_vs_predicted_bins(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(joint_counts(_linear_scored(spark, folder), LABEL, bins=JOINT_BINS), 4)


def _compared(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows scored by both models over the default features, stored once."""
    hourly = _stored_hourly(spark, folder)
    train, test = keyed_split(hourly, hour_key())
    models = {"linear": fit_flow(hourly, train, linear()), "tree": fit_flow(hourly, train, tree())}
    return stage(side_by_side(test, models, IDS), "compared")


def q_model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics(_compared(spark, folder), "actual", by=["model"]), 4)


def _tree_rows(spark: SparkSession, folder: str) -> DataFrame:
    return with_residual(_compared(spark, folder), "actual").filter(F.col("model") == "tree")


def q_model_comparison_residuals(spark: SparkSession, folder: str) -> DataFrame:
    """Residual histogram of each model on the same test rows."""
    scored = with_residual(_compared(spark, folder), "actual")
    linear_part, tree_part = (
        histogram(scored.filter(F.col("model") == name), "residual", HISTOGRAM_BINS).withColumn("model", F.lit(name))
        for name in ("linear", "tree")
    )
    return _rounded(linear_part.unionByName(tree_part), 4)


def q_model_comparison_density(spark: SparkSession, folder: str) -> DataFrame:
    """Residual density of the tree (that of the linear model is ``residual_density``)."""
    curve = density(_tree_rows(spark, folder), "residual", CURVE_POINTS, CURVE_CELLS)
    return _rounded(curve.withColumn("model", F.lit("tree")), 6)


def q_model_comparison_bins(spark: SparkSession, folder: str) -> DataFrame:
    """Actual against predicted of the tree (those of the linear model are ``actual_vs_predicted_bins``)."""
    cells = joint_counts(_tree_rows(spark, folder), "actual", bins=JOINT_BINS)
    return _rounded(cells.withColumn("model", F.lit("tree")), 4)


QUERIES: Mapping[str, Query] = {
    name.removeprefix("q_"): function for name, function in list(globals().items()) if name.startswith("q_")
}
