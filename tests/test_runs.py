"""Bounded runs, rows of batches, several sinks, landing folders that are cleared."""

import csv
import os
import threading
import time
from pathlib import Path

import pytest
from plans import simple
from pyspark.sql import functions as F

from gustline.operators.readings import inspect_messages, raw_text, route
from gustline.schemas import CSV_SCHEMA, READING_SCHEMA
from gustline.sources import streams
from gustline.sources.streams import Endpoint, append_stream, csv_landing, open_stream, readmit_late, seconds_of, table_sink, text_topic
from gustline.sources.tables import read_table
from gustline.streaming.flows import counted, distribute, ingest, publish
from gustline.streaming.runs import batch_counts, lifetime_batches, lifetime_rows, run_bounded, total_rows

GOOD = '{"Date/Time":"01 01 2018 00:00"}'


def messages(folder, *bodies, first=0):
    Path(folder).mkdir(exist_ok=True)
    for number, body in enumerate(bodies):
        Path(folder, f"{first + number:04d}.txt").write_text(f"{body}\n")


def test_totals_of_a_sink_without_files_outlive_a_restart(spark, tmp_path):
    topic, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    for run in range(2):
        messages(topic, *[f"{GOOD}\n{GOOD}"] * 55, first=100 * run)
        source = counted(raw_text(open_stream(spark, text_topic(topic, maxFilesPerTrigger="1"))))
        query = run_bounded(append_stream(source, Endpoint("noop"), checkpoint))
        assert total_rows(query) == 110 and len(batch_counts(query)) == 55
    assert lifetime_batches(spark, checkpoint) == [(k, 2) for k in range(110)]
    assert lifetime_rows(spark, checkpoint) == 220
    next(Path(checkpoint, "batch-rows").glob("000000000105=*")).unlink()
    with pytest.raises(ValueError, match="105"):
        lifetime_rows(spark, checkpoint)


def test_noted_rows_are_gathered(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "_FOLDED", 4)
    checkpoint = str(tmp_path / "checkpoint")
    for number in [*range(11), 10, 9]:  # repeated batches are noted once
        streams.note_rows(spark, checkpoint, number, 10 + number)
    assert lifetime_batches(spark, checkpoint) == [(k, 10 + k) for k in range(11)]
    assert len([p for p in Path(checkpoint, "batch-rows").iterdir() if p.name[0] != "."]) == 4  # one for eight, three more
    assert lifetime_rows(spark, checkpoint) == sum(range(10, 21))
    assert lifetime_batches(spark, str(tmp_path / "none")) == []


def test_totals_of_a_table_are_kept_as_well(spark, tmp_path):
    topic, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    messages(topic, GOOD, f"{GOOD}\n{GOOD}")
    writer = ingest(spark, text_topic(topic, maxFilesPerTrigger="1"), table_sink(str(tmp_path / "t")), checkpoint)
    counts = batch_counts(run_bounded(writer))
    assert counts == lifetime_batches(spark, checkpoint) and sorted(n for _, n in counts) == [1, 2]


def committed(checkpoint):
    """(batches begun, batches committed)"""
    return tuple({int(p.name) for p in Path(checkpoint, kind).iterdir() if p.name.isdigit()} for kind in ("offsets", "commits"))


@pytest.mark.parametrize("every", [None, "300 milliseconds"])
def test_a_timeout_ends_between_two_batches(spark, tmp_path, monkeypatch, every):
    topic, table, checkpoint = (str(tmp_path / name) for name in ("topic", "table", "checkpoint"))
    messages(topic, *[GOOD] * 12)
    made, real = [], streams._put

    def slow(output, batch, identity, number):
        made.append(number)
        time.sleep(0.7)
        return real(output, batch, identity, number)

    monkeypatch.setattr(streams, "_put", slow)
    source = text_topic(topic, maxFilesPerTrigger="1")
    query = run_bounded(ingest(spark, source, table_sink(table), checkpoint), timeout=2.5, every=every)
    begun, done = committed(checkpoint)
    assert begun == done and 0 < len(done) < 12
    assert total_rows(query) == read_table(spark, table, schema=READING_SCHEMA).count() == len(done)
    monkeypatch.setattr(streams, "_put", lambda *given: made.append(given[-1]) or real(*given))
    rest = run_bounded(ingest(spark, source, table_sink(table), checkpoint))
    assert total_rows(rest) == 12 - len(done)
    assert sorted(made) == list(range(12))  # none was made twice
    assert read_table(spark, table, schema=READING_SCHEMA).count() == 12


def test_a_run_with_time_left_ends_when_nothing_is_left(spark, tmp_path):
    topic = str(tmp_path / "topic")
    messages(topic, *[GOOD] * 3)
    started = time.monotonic()
    writer = ingest(spark, text_topic(topic, maxFilesPerTrigger="1"), table_sink(str(tmp_path / "t")), str(tmp_path / "c"))
    assert batch_counts(run_bounded(writer, timeout=120)) == [(0, 1), (1, 1), (2, 1)]
    assert time.monotonic() - started < 60


def test_a_failing_batch_is_an_error(spark, tmp_path):
    topic = str(tmp_path / "topic")
    messages(topic, GOOD)
    broken = open_stream(spark, text_topic(topic)).select(F.raise_error(F.lit("stop")).cast("string").alias("value"))
    for timeout in (None, 60):
        with pytest.raises(Exception, match="stop"):
            run_bounded(append_stream(broken, text_topic(str(tmp_path / "out")), str(tmp_path / f"c{timeout}")), timeout=timeout)


BODIES = [GOOD, "{broken", "null", "[1]", '{"Date/Time":"x"}', "{}", " ", GOOD]
PROBLEMS = ["not JSON", "not an object", "not an object", "bad time", "no time", "blank"]


def test_fan_out_reads_and_parses_once(spark, tmp_path):
    topic, table, tap, bad = (str(tmp_path / name) for name in ("topic", "table", "tap", "bad"))
    messages(topic, *BODIES)
    writer = distribute(
        spark, text_topic(topic, maxFilesPerTrigger="3"), str(tmp_path / "c"), table_sink(table), text_topic(tap), table_sink(bad), ["signal_date"]
    )
    query = run_bounded(writer)
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [3, 3, 2]  # each file was read once
    assert {k: sum(n[k] for n in query.output_rows.values()) for k in ("table", "tap", "quarantine")} == {"table": 2, "tap": 8, "quarantine": 6}
    assert read_table(spark, table, schema=READING_SCHEMA).where("signal_ts is not null").count() == 2
    assert sorted(r.value for r in read_table(spark, tap, "text").collect()) == sorted(BODIES)
    kept = read_table(spark, bad).collect()
    assert sorted((r.body, r.problem) for r in kept) == sorted(zip(BODIES[1:7], PROBLEMS, strict=True))
    assert lifetime_rows(spark, str(tmp_path / "c")) == 2


def test_fan_out_that_stops_between_two_sinks_ends_with_both(spark, tmp_path, monkeypatch):
    topic, table, tap = (str(tmp_path / name) for name in ("topic", "table", "tap"))
    messages(topic, *BODIES)
    real, calls = streams._put, []

    def flaky(output, *given):
        calls.append(output.sink.options["path"])
        if len(calls) == 2:
            raise OSError("lost")
        return real(output, *given)

    monkeypatch.setattr(streams, "_put", flaky)

    def start():
        return run_bounded(distribute(spark, text_topic(topic), str(tmp_path / "c"), table_sink(table), text_topic(tap)))

    with pytest.raises(Exception, match="lost"):
        start()
    assert read_table(spark, table, schema=READING_SCHEMA).count() == 7 and not Path(tap).exists()
    start()
    assert read_table(spark, table, schema=READING_SCHEMA).count() == 7  # without a quarantine only the blank one is left out
    assert read_table(spark, tap, "text").count() == 8


def test_batch_route_keeps_bodies_and_parses_once(spark):
    df = spark.createDataFrame([(k, v) for k, v in enumerate([*BODIES, None])], "k int, value string")
    good, bad = route(df, "k")
    assert sorted(r.k for r in good.collect()) == [0, 7]
    assert {r.k: (r.body, r.problem) for r in bad.collect()} == dict(enumerate(zip([*BODIES[1:7]], PROBLEMS, strict=True), 1)) | {8: (None, "no body")}
    assert simple(inspect_messages(df, "k")).count("from_json") == 1
    assert "from_json" not in simple(good) and "from_json" not in simple(bad)


def drop(folder, name, n, days_old=0):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w", newline="", encoding="utf-8") as file:
        csv.writer(file).writerows([CSV_SCHEMA.names] + [(f"01 01 2018 00:{m:02d}", "1", "2", "3", "4") for m in range(n)])
    at = time.time() - days_old * 86400
    os.utime(folder / name, (at, at))


def test_landing_is_cleared_and_late_files_are_read(spark, tmp_path):
    landing, archive, topic, checkpoint = tmp_path / "in", tmp_path / "read", str(tmp_path / "topic"), str(tmp_path / "c")
    source = csv_landing(str(landing), str(archive), age="2 days")
    assert source.options["maxFileAge"] == "172800s"
    total = 0
    for number, days in enumerate([0, 0, 40, 0, 90, 0]):
        drop(landing, f"{number}.csv", number + 1, days)
        total += total_rows(run_bounded(publish(spark, source, text_topic(topic), checkpoint, age="2 days")))
        assert len(list(landing.glob("*.csv"))) <= 2  # read files leave once a later batch is planned
    assert total == read_table(spark, topic, "text").count() == 21
    assert len(list(archive.rglob("*.csv"))) >= 4
    # what was read is not let in again, whatever its date
    for file in landing.glob("*.csv"):
        os.utime(file, (1, 1))
    drop(landing, "new.csv", 1)
    assert readmit_late(spark, source, checkpoint, "2 days") == []
    assert total_rows(run_bounded(publish(spark, source, text_topic(topic), checkpoint, age="2 days"))) == 1


def test_late_files_without_a_landing_or_a_checkpoint(spark, tmp_path):
    source = csv_landing(str(tmp_path / "in"), str(tmp_path / "read"))
    assert readmit_late(spark, source, str(tmp_path / "c")) == []
    drop(tmp_path / "in", "a b+c%.csv", 1, 40)
    drop(tmp_path / "in", "new.csv", 1)
    assert [Path(name).name for name in readmit_late(spark, source, str(tmp_path / "c"))] == ["a b+c%.csv"]
    assert readmit_late(spark, source, str(tmp_path / "c")) == []


def test_intervals():
    assert [seconds_of(x) for x in ("1 second", "200 milliseconds", "1.5 hours", "7 days")] == [1, 0.2, 5400, 604800]
    for bad in ("soon", "3", "3 fortnights"):
        with pytest.raises(ValueError):
            seconds_of(bad)


def test_files_that_arrive_during_a_run(spark, tmp_path):
    topic = str(tmp_path / "topic")
    messages(topic, GOOD)
    threading.Timer(3, lambda: messages(topic, GOOD, first=50)).start()
    query = run_bounded(append_stream(open_stream(spark, text_topic(topic)), Endpoint("noop"), str(tmp_path / "c")), timeout=8, every="1 second")
    assert total_rows(query) == 2
