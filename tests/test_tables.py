"""Batch sources and sinks, previews, batch sizes, scratch folder."""

import datetime as dt

import pytest
from plans import simple
from pyspark.sql import functions as F

from gustline import session as session_module
from gustline.plans.flows import analyse
from gustline.schemas import MAPPING_SCHEMA
from gustline.session import scratch_path, stage
from gustline.sources.tables import (
    append_table,
    batch_sizes,
    check_apart,
    inline_relation,
    mapping_relation,
    preview,
    read_table,
    replace_table,
    schema_report,
)

DAYS = "day date, n bigint"


def days(spark, *rows):
    return spark.createDataFrame([(dt.date(2018, 1, day), n) for day, n in rows], DAYS)


def test_append_adds_and_replace_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = days(spark, (1, 1), (2, 2)), days(spark, (2, 3))
    append_table(first, path, partition_by=["day"])
    append_table(second, path, partition_by=["day"])
    stored = read_table(spark, path, schema=first.schema)
    assert sorted(row.n for row in stored.collect()) == [1, 2, 3]
    replace_table(second, path, partition_by=["day"])
    assert [row.n for row in read_table(spark, path, schema=first.schema).collect()] == [3]


@pytest.mark.parametrize("format", ["parquet", "orc", "json"])
def test_format_is_a_parameter(spark, tmp_path, format):
    path = str(tmp_path / format)
    df = days(spark, (1, 1), (2, 2))
    replace_table(df, path, format)
    assert sorted(read_table(spark, path, format, df.schema).collect()) == sorted(df.collect())


def test_replacing_an_input_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    append_table(days(spark, (1, 1)), path)
    for hourly, daily in ((path, "d"), (f"{path}/", "d"), ("h", f"{path}/below"), ("h", "h")):
        with pytest.raises(ValueError, match="overlap"):
            analyse(spark, path, hourly, daily)
    assert read_table(spark, path).count() == 1
    check_apart("/a/table", "/a/table2", "/a/b")


def test_spellings_of_one_path_overlap(spark):
    for one, other in (("/data/wind", "file:/data"), ("t", "./t"), ("/a/b", "/a/c/../b/x")):
        with pytest.raises(ValueError):
            check_apart(one, other)


def test_partitioned_write_gathers_a_day(spark, tmp_path):
    df = spark.range(0, 4000, numPartitions=8).select(
        F.date_add(F.lit("2018-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("day"), "id"
    )
    append_table(df, str(tmp_path / "t"), partition_by=["day"])
    files = [p.parent.name for p in (tmp_path / "t").rglob("*.parquet")]
    assert sorted(files) == ["day=2018-01-01", "day=2018-01-02", "day=2018-01-03"]


def test_partitioned_write_without_gathering_is_narrow(spark, tmp_path):
    df = spark.range(0, 8, numPartitions=2).select((F.col("id") % 2).alias("side"), "id")
    append_table(df, str(tmp_path / "t"), partition_by=["side"], gather=False)
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 4
    assert read_table(spark, str(tmp_path / "t")).count() == 8


def test_day_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = days(spark, (1, 1), (2, 2))
    append_table(df, path, partition_by=["day"])
    one = read_table(spark, path, schema=df.schema).filter(F.col("day") == F.lit(dt.date(2018, 1, 2)))
    assert "PartitionFilters: [isnotnull(day" in simple(one)
    assert one.first().n == 2


def test_preview(spark):
    df = days(spark, *((1, n) for n in range(50)))
    assert preview(df).count() == 20
    top = preview(df, 3, [F.desc("n")])
    assert [row.n for row in top.collect()] == [49, 48, 47]
    assert "TakeOrderedAndProject" in simple(top)


def test_schema_report(spark):
    report = schema_report(days(spark, (1, 1)))
    assert [tuple(row) for row in report.collect()] == [(0, "day", "date", True), (1, "n", "bigint", True)]


def test_inline_relation_is_local(spark):
    mapping = mapping_relation(spark, [("a'b", "x"), ("`c`", None)])
    assert mapping.schema.names == MAPPING_SCHEMA.names
    assert [tuple(row) for row in mapping.collect()] == [("a'b", "x"), ("`c`", None)]
    assert "LocalTableScan" in simple(mapping.filter("sig_name = 'x'"))
    assert inline_relation(spark, [], MAPPING_SCHEMA).count() == 0


def test_batch_sizes_run_over_days(spark):
    batches = [("2018-01-01T10:00:00", 3), ("2018-01-01T11:00:00", 2), ("2018-01-02T09:00:00", 4), ("2018-01-05T00:00:00", 1)]
    rows = [
        (dt.datetime.fromisoformat(time).date(), dt.datetime.fromisoformat(time)) for time, n in batches for _ in range(n)
    ]
    table = spark.createDataFrame(rows, "create_date date, create_ts timestamp").repartition(3)
    found = batch_sizes(table).orderBy("create_ts").collect()
    assert [(row.batch_rows, row.total_rows) for row in found] == [(3, 3), (2, 5), (4, 9), (1, 10)]


def test_batch_sizes_scan_the_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    now = dt.datetime(2018, 1, 1)
    spark.createDataFrame([(now.date(), now)] * 5, "create_date date, create_ts timestamp").write.parquet(path)
    result = batch_sizes(spark.read.parquet(path))
    result.collect()
    assert "ReusedExchange" in simple(result)


def test_stage_reads_back_what_was_written(spark):
    df = days(spark, (1, 1), (2, 2))
    staged = stage(df, "test")
    assert sorted(staged.collect()) == sorted(df.collect())
    assert "FileScan parquet" in simple(staged)


def test_scratch_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert first.startswith(root)


def test_no_local_scratch_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(session_module, "CHECKPOINT_DIR", "spark.checkpoint.dir.unset")
    assert scratch_path(spark, "x")  # local master

    class Cluster:
        conf = spark.conf

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Cluster(), "x")
