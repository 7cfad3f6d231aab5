"""Streaming flows: round trip, resume, counts, bounded runs, fan-out."""

import csv
import datetime as dt
import os
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gustline.operators.aggregates import hourly_from_map
from gustline.operators.readings import parse_readings
from gustline.schemas import CSV_SCHEMA, READING_SCHEMA
from gustline.sources.streams import (
    append_stream,
    console,
    csv_landing,
    kafka_sink,
    kafka_source,
    open_stream,
    table_sink,
    text_topic,
)
from gustline.sources.tables import append_table, batch_sizes, read_table, replace_table
from gustline.streaming.flows import ingest, publish, tap
from gustline.streaming.runs import batch_counts, run_bounded, total_rows

HEADER = CSV_SCHEMA.names


def drop(folder, name, rows):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file)
        writer.writerow(HEADER)
        writer.writerows(rows)


def row(minute, power="380.047790527343"):
    return (f"01 01 2018 00:{minute:02d}", power, "5.3", "416.3", "259.9")


@pytest.fixture
def paths(tmp_path):
    return {name: str(tmp_path / name) for name in ("topic", "table", "sent", "stored", "tap")} | {
        "landing": tmp_path / "landing"
    }


def send(spark, paths, **options):
    landing = csv_landing(str(paths["landing"]), **options)
    return run_bounded(publish(spark, landing, text_topic(paths["topic"]), paths["sent"]))


def store(spark, paths, **options):
    topic = text_topic(paths["topic"], **options.pop("topic", {}))
    return run_bounded(ingest(spark, topic, table_sink(paths["table"]), paths["stored"], **options))


def table(spark, paths):
    return read_table(spark, paths["table"], schema=READING_SCHEMA)


def test_round_trip_and_resume(spark, paths):
    drop(paths["landing"], "a.csv", [row(0), row(10, ""), row(20, "n/a")])
    assert [n for _, n in batch_counts(send(spark, paths))] == [3]
    assert [n for _, n in batch_counts(store(spark, paths))] == [3]
    stored = {r.signal_ts.minute: r for r in table(spark, paths).collect()}
    assert stored[0].signal_date == dt.date(2018, 1, 1)
    assert stored[0].signals["ActivePower_kW"] == "380.047790527343"
    assert stored[10].signals["ActivePower_kW"] is None
    assert stored[20].signals["ActivePower_kW"] is None
    assert stored[20].signals["WindSpeed_m_s"] == "5.3"
    # nothing new: nothing is sent or stored again
    assert batch_counts(send(spark, paths)) == []
    assert batch_counts(store(spark, paths)) == []
    assert table(spark, paths).count() == 3
    # a new file is picked up alone
    drop(paths["landing"], "b.csv", [row(30)])
    assert [n for _, n in batch_counts(send(spark, paths))] == [1]
    assert [n for _, n in batch_counts(store(spark, paths))] == [1]
    assert table(spark, paths).count() == 4


def test_stream_equals_batch(spark, paths):
    drop(paths["landing"], "a.csv", [row(m, str(m * 1.5)) for m in range(40)])
    send(spark, paths)
    store(spark, paths)
    keep = ["signal_date", "signal_ts", F.map_entries("signals").alias("signals")]
    batch = parse_readings(spark.read.text(paths["topic"])).select(keep)
    assert sorted(map(str, table(spark, paths).select(keep).collect())) == sorted(map(str, batch.collect()))


def test_counts_per_batch(spark, paths):
    for i, n in enumerate((2, 3, 4)):
        drop(paths["landing"], f"{i}.csv", [row(m) for m in range(n)])
        send(spark, paths)
    query = store(spark, paths, topic={"maxFilesPerTrigger": "1"})
    assert [n for _, n in batch_counts(query)] == [2, 3, 4]
    sizes = batch_sizes(table(spark, paths)).orderBy("create_ts").collect()
    assert [(r.batch_rows, r.total_rows) for r in sizes] == [(2, 2), (3, 5), (4, 9)]


def test_malformed_messages_reach_the_table(spark, paths, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    (topic / "m.txt").write_text('{broken\n\nnull\n{"Date/Time":"01 01 2018 00:00"}\n')
    store(spark, paths)
    assert table(spark, paths).count() == 3
    assert table(spark, paths).filter("signal_ts is null").count() == 2


def test_many_checkpoints_and_batch_writes_share_a_table(spark, paths):
    drop(paths["landing"], "a.csv", [row(m) for m in range(5)])
    topics = [text_topic(paths["topic"]), text_topic(paths["topic"] + "2")]
    for number, topic in enumerate(topics):
        run_bounded(publish(spark, csv_landing(str(paths["landing"])), topic, f"{paths['sent']}{number}"))
        query = run_bounded(ingest(spark, topic, table_sink(paths["table"]), f"{paths['stored']}{number}"))
        assert total_rows(query) == 5
    assert table(spark, paths).count() == 10
    append_table(table(spark, paths).limit(3), paths["table"])
    assert table(spark, paths).count() == 13
    store(spark, paths)  # a third checkpoint, after a batch write
    assert table(spark, paths).count() == 18
    # two publishers into one topic
    run_bounded(publish(spark, csv_landing(str(paths["landing"])), topics[0], f"{paths['sent']}-more"))
    assert spark.read.text(paths["topic"]).count() == 10
    # a table replaced between two runs goes on
    replace_table(spark.createDataFrame([], READING_SCHEMA), paths["table"])
    store(spark, paths)
    assert table(spark, paths).count() == 5


def test_replayed_batch_is_not_stored_twice(spark, paths, tmp_path):
    for number in range(2):
        drop(paths["landing"], f"{number}.csv", [row(m) for m in range(4)])
        send(spark, paths)
        store(spark, paths, partition_by=["signal_date"])
    last = max((tmp_path / "stored" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    last.with_name(f".{last.name}.crc").unlink()
    store(spark, paths, partition_by=["signal_date"])
    assert table(spark, paths).count() == 8


def test_table_with_a_sink_log_is_refused(spark, paths, tmp_path):
    drop(paths["landing"], "a.csv", [row(0)])
    send(spark, paths)
    (tmp_path / "table" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="log"):
        store(spark, paths)
    with pytest.raises(ValueError, match="log"):
        append_table(spark.range(1), paths["table"])


def test_old_files_are_read(spark, paths):
    drop(paths["landing"], "a.csv", [row(0)])
    send(spark, paths)
    drop(paths["landing"], "b.csv", [row(1)])
    weeks_ago = time.time() - 40 * 86400
    os.utime(paths["landing"] / "b.csv", (weeks_ago, weeks_ago))
    assert total_rows(send(spark, paths)) == 1


def test_option_names_are_not_case_sensitive():
    options = csv_landing("x", maxfilespertrigger="1", MAXFILEAGE="1d").options
    assert "maxBytesPerTrigger" not in options and "maxFileAge" not in options


def test_counts_of_more_than_a_hundred_batches(spark, paths, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    for number in range(105):
        (topic / f"{number}.txt").write_text('{"Date/Time":"01 01 2018 00:00"}\n')
    query = store(spark, paths, topic={"maxFilesPerTrigger": "1"})
    assert len(batch_counts(query)) == 105 and total_rows(query) == 105 == table(spark, paths).count()


def test_running_stream_takes_files_that_arrive(spark, paths):
    drop(paths["landing"], "a.csv", [row(0)])
    send(spark, paths)
    topic = text_topic(paths["topic"])
    late = threading.Timer(4, lambda: Path(paths["topic"], "late.txt").write_text('{"Date/Time":"01 01 2018 00:10"}\n'))
    late.start()
    writer = ingest(spark, topic, table_sink(paths["table"]), paths["stored"])
    query = run_bounded(writer, timeout=15, every="1 second")
    assert not query.isActive and total_rows(query) == 2 == table(spark, paths).count()
    with pytest.raises(ValueError):
        run_bounded(writer, every="1 second")


def test_partitioned_and_promoted(spark, paths, tmp_path):
    drop(paths["landing"], "a.csv", [row(0), row(1), ("02 01 2018 00:00", "1", "2", "3", "4"), ("bad", "1", "2", "3", "4")])
    send(spark, paths)
    store(spark, paths, partition_by=["signal_date"], promoted={"power": "ActivePower_kW"}, tasks_per_day=2)
    days = {p.name for p in (tmp_path / "table").rglob("signal_date=*")}
    assert days == {"signal_date=2018-01-01", "signal_date=2018-01-02", "signal_date=__HIVE_DEFAULT_PARTITION__"}
    stored = read_table(spark, paths["table"])
    assert stored.filter("signal_date = date'2018-01-01'").agg(F.sum("power")).first()[0] == pytest.approx(760.0955810546875)
    averages = hourly_from_map(stored.filter("signal_ts is not null"))
    assert averages.count() == 2


def test_tap_copies_bodies(spark, paths):
    drop(paths["landing"], "a.csv", [row(0)])
    send(spark, paths)
    run_bounded(tap(spark, text_topic(paths["topic"]), text_topic(paths["tap"]), paths["stored"]))
    assert read_table(spark, paths["tap"], "text").collect() == read_table(spark, paths["topic"], "text").collect()


def test_tap_to_console_needs_no_checkpoint(spark, paths):
    drop(paths["landing"], "a.csv", [row(0)])
    send(spark, paths)
    query = run_bounded(tap(spark, text_topic(paths["topic"]), console()))
    assert query.exception() is None


def test_fan_out_reads_one_topic_several_times(spark, paths):
    drop(paths["landing"], "a.csv", [row(0), row(1)])
    send(spark, paths)
    topic = text_topic(paths["topic"])
    run_bounded(tap(spark, topic, text_topic(paths["tap"]), paths["sent"] + "-tap"))
    store(spark, paths)
    assert spark.read.text(paths["tap"]).count() == table(spark, paths).count() == 2


def test_timeout_stops_an_endless_query(spark, paths):
    endless = spark.readStream.format("rate").option("rowsPerSecond", 5).load().select(F.lit("{}").alias("value"))
    writer = append_stream(endless, text_topic(paths["topic"]), paths["sent"])
    query = run_bounded(writer, timeout=4, every="200 milliseconds")
    assert not query.isActive


def test_bounded_run_within_timeout(spark, paths):
    drop(paths["landing"], "a.csv", [row(0)])
    landing = csv_landing(str(paths["landing"]))
    query = run_bounded(publish(spark, landing, text_topic(paths["topic"]), paths["sent"]), timeout=120)
    assert not query.isActive
    assert spark.read.text(paths["topic"]).count() == 1


def test_ingestion_is_narrow(spark, paths):
    drop(paths["landing"], "a.csv", [row(0)])
    send(spark, paths)
    readings = parse_readings(open_stream(spark, text_topic(paths["topic"])))
    assert readings.isStreaming
    plan = parse_readings(spark.read.text(paths["topic"]))._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_kafka_endpoints():
    source = kafka_source("host:9092", "readings", maxOffsetsPerTrigger="1000")
    assert source.format == "kafka"
    assert source.options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "readings",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
    }
    sink = kafka_sink("host:9092", "readings")
    assert sink.options == {"kafka.bootstrap.servers": "host:9092", "topic": "readings"}
