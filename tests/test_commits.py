"""Writes that are seen whole or not at all: failures, replays, readers during a write."""

import datetime as dt
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gustline.sources import commits
from gustline.sources.commits import COMMIT_COLUMNS, commit, current_folder, names_in
from gustline.sources.tables import append_table, read_table, replace_table

ROWS = "day date, n bigint"


def rows(spark, *numbers):
    return spark.createDataFrame([(dt.date(2018, 1, n), n) for n in numbers], ROWS)


def held(spark, path, **options):
    return sorted(row.n for row in read_table(spark, path, schema=rows(spark).schema, **options).collect())


def failing(df, at):
    """The rows, of which one cannot be computed."""
    return df.withColumn("n", F.when(F.col("n") == at, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("n")))


@pytest.mark.parametrize("format", ["parquet", "orc", "json"])
def test_failed_replacement_leaves_the_old_rows(spark, tmp_path, format):
    path = str(tmp_path / "t")
    append_table(rows(spark, 1, 2), path, format)
    for old in ([1, 2], [3]):
        with pytest.raises(Exception, match="stop"):
            replace_table(failing(rows(spark, 4, 5).repartition(2), 5), path, format)
        assert held(spark, path, format=format) == old
        replace_table(rows(spark, 3), path, format)
        assert held(spark, path, format=format) == [3]


def test_failed_append_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    append_table(rows(spark, 1), path, partition_by=["day"])
    with pytest.raises(Exception, match="stop"):
        append_table(failing(rows(spark, *range(2, 20)).repartition(4), 19), path, partition_by=["day"], gather=False)
    # a writer that died after some of its files and before its mark
    lost = f"{path}/ingestion_id=wdead/ingestion_batch=000000000000"
    rows(spark, 9).write.parquet(lost)
    assert held(spark, path) == [1]
    append_table(rows(spark, 2), path, partition_by=["day"])
    assert held(spark, path) == [1, 2]


def test_table_can_be_replaced_by_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    append_table(rows(spark, 1, 2, 3, 4), path)
    for keep in (3, 2, 1):
        replace_table(read_table(spark, path).where(F.col("n") <= keep), path)
        assert held(spark, path) == list(range(1, keep + 1))
    # the replaced rows are kept once over, for readers that have begun with them
    assert len(names_in(spark, f"{path}/_versions")) == 2
    assert not [p for p in Path(path).iterdir() if not p.name.startswith(("_", "."))]


def test_reader_that_began_before_a_replacement_ends_with_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(rows(spark, 1, 2), path)
    before = read_table(spark, path)
    replace_table(rows(spark, 3), path)
    assert sorted(row.n for row in before.collect()) == [1, 2]
    assert held(spark, path) == [3]


def test_readers_during_replacements_see_one_whole_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(rows(spark, *[1] * 3), path)
    seen, stop, errors = set(), threading.Event(), []

    def look():
        try:
            while not stop.is_set():
                seen.add(tuple(held(spark, path)))
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    reader = threading.Thread(target=look)
    reader.start()
    for n in (2, 3, 4):
        replace_table(rows(spark, *[n] * 3).repartition(3), path)
        time.sleep(0.5)
    stop.set()
    reader.join()
    assert not errors and seen <= {(n,) * 3 for n in (1, 2, 3, 4)} and len(seen) > 1


def test_readers_during_appends_see_whole_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    append_table(rows(spark, *[1] * 4), path)
    seen, stop, errors = set(), threading.Event(), []

    def look():
        try:
            while not stop.is_set():
                seen.add(len(held(spark, path)))
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    reader = threading.Thread(target=look)
    reader.start()
    for _ in range(3):
        append_table(rows(spark, *[2] * 4).repartition(4), path)
    stop.set()
    reader.join()
    assert not errors and seen <= {4, 8, 12, 16}
    assert len(held(spark, path)) == 16


def test_rows_appended_after_a_replacement(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(rows(spark, 1), path, partition_by=["day"])
    append_table(rows(spark, 2), path, partition_by=["day"])
    assert held(spark, path) == [1, 2]
    assert current_folder(spark, path) != path


def test_commit_is_made_once_and_repaired(spark, tmp_path):
    path = str(tmp_path / "t")
    assert commit(rows(spark, 1, 2), path, "wa", 7, "parquet", ["day"]) == 2
    assert commit(rows(spark, 5, 5, 5), path, "wa", 7, "parquet", ["day"]) == 2  # a repeated batch
    assert held(spark, path) == [1, 2]
    # an attempt that was interrupted: its files are replaced, also those of other partitions
    rows(spark, 1, 3).write.partitionBy("day").parquet(f"{path}/ingestion_id=wa/ingestion_batch=000000000008")
    assert held(spark, path) == [1, 2]
    commit(rows(spark, 4), path, "wa", 8, "parquet", ["day"])
    assert held(spark, path) == [1, 2, 4]
    kept = read_table(spark, path, keep_commits=True)
    assert sorted((r.ingestion_id, r.ingestion_batch, r.n) for r in kept.collect()) == [("wa", 7, 1), ("wa", 7, 2), ("wa", 8, 4)]
    with pytest.raises(ValueError, match="own columns"):
        append_table(kept, path)


def test_files_of_other_tools_belong_to_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, 1).write.partitionBy("day").parquet(path)
    assert held(spark, path) == [1]
    append_table(rows(spark, 2), path, partition_by=["day"])
    rows(spark, 3).write.mode("append").partitionBy("day").parquet(path)
    assert held(spark, path) == [1, 2, 3]
    both = read_table(spark, path, keep_commits=True)
    assert set(COMMIT_COLUMNS) < set(both.columns) and both.where("ingestion_id is null").count() == 2
    replace_table(rows(spark, 4), path)
    assert held(spark, path) == [4]
    replace_table(rows(spark, 5), path)
    assert held(spark, path) == [5] and {name for name in names_in(spark, path) if "SUCCESS" not in name} == {"_versions"}


def test_table_without_complete_writes_is_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    append_table(rows(spark, 1), path)
    for mark in Path(path, "_commits").rglob("0*"):
        mark.unlink()
    assert held(spark, path) == []
    with pytest.raises(Exception):  # noqa: B017
        read_table(spark, str(tmp_path / "none")).collect()


def test_nothing_is_moved_by_the_library():
    sources = Path(commits.__file__).parents[1]
    assert not [p for p in sources.rglob("*.py") if "llm" not in p.parts and ".rename(" in p.read_text()]
