"""Tables of plain file formats whose writes are seen whole or not at all.

A table folder holds one folder per write, and a small file that says that the write is complete:

    table/ingestion_id=<writer>/ingestion_batch=<number>/[partition folders/]part files
    table/_commits/<writer>/<number>                      (holds the number of rows)
    table/_versions/<number>-<mark>/                      (the same again, one per replacement)
    table/_versions/<number>-<mark>/_replaced

A write goes straight to its folder; nothing is moved by this module. ``read_folder`` reads the folders
that are listed as complete and no others, so what a failed or running job has written is not seen. A
writer that repeats a number (a stream that resumes) finds it complete and leaves it alone, or replaces
that folder. A replacement is a folder of its own, and the newest complete one is the table; the one
before it stays for readers that have begun with it.

Files beside these folders (written by other tools) belong to the table as well, until it is replaced.
Other readers see such a table as one that is partitioned by the two columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WRITER, NUMBER = "ingestion_id", "ingestion_batch"
COMMIT_COLUMNS = (WRITER, NUMBER)
_COMMITS, _VERSIONS, _REPLACED = "_commits", "_versions", "_replaced"
_KEPT_VERSIONS = 2  # the table and the one before it


def located(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """Hadoop path and its file system."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    location, files = located(spark, path)
    return files.exists(location)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder. One call however many there are."""
    location, files = located(spark, folder)
    if not files.exists(location):
        return []
    paths = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(files.listStatus(location))
    base = files.makeQualified(location).toString().rstrip("/") + "/"
    text = spark._jvm.scala.runtime.ScalaRunTime.stringOf(paths).removeprefix("Array(").removesuffix(")")
    return sorted(piece.removesuffix(", ") for piece in text.split(base)[1:])


def read_text(spark: SparkSession, path: str) -> str:
    location, files = located(spark, path)
    stream = files.open(location)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    location, files = located(spark, path)
    stream = files.create(location, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _shown(name: str) -> bool:
    """Whether Spark's readers look at a file or folder of this name."""
    return not name.startswith((".", "_"))


def _versions(spark: SparkSession, table: str) -> list[str]:
    """Complete replacements, oldest first. A folder gets its mark after its rows."""
    base = f"{table.rstrip('/')}/{_VERSIONS}"
    return [name for name in names_in(spark, base) if exists(spark, f"{base}/{name}/{_REPLACED}")]


def current_folder(spark: SparkSession, table: str) -> str:
    """The folder that holds the table's rows now."""
    complete = _versions(spark, table)
    return f"{table.rstrip('/')}/{_VERSIONS}/{complete[-1]}" if complete else table.rstrip("/")


def _write_path(folder: str, writer: str, number: int) -> str:
    return f"{folder}/{WRITER}={writer}/{NUMBER}={number:012d}"


def committed_rows(spark: SparkSession, folder: str, writer: str, number: int) -> int | None:
    """Rows of a complete write; None if it is not complete."""
    path = f"{folder}/{_COMMITS}/{writer}/{number:012d}"
    return int(read_text(spark, path) or 0) if exists(spark, path) else None


def commit(
    df: DataFrame,
    folder: str,
    writer: str,
    number: int,
    format: str,
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> int:
    """Write rows as one commit of a writer; the number of rows. A complete one is left as it is."""
    spark = df.sparkSession
    if set(COMMIT_COLUMNS) & set(df.columns):
        raise ValueError(f"{' and '.join(COMMIT_COLUMNS)} are names of the table's own columns")
    done = committed_rows(spark, folder, writer, number)
    if done is not None:
        return done
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    target = rows.write.format(format).mode("overwrite").options(**(options or {})).option("partitionOverwriteMode", "static")
    (target.partitionBy(*partition_by) if partition_by else target).save(_write_path(folder, writer, number))
    count = seen.get["rows"]
    write_text(spark, f"{folder}/{_COMMITS}/{writer}/{number:012d}", str(count))
    return count


def new_writer() -> str:
    """Name for a writer of one commit; the letter keeps it text when it is read back from a path."""
    return f"w{uuid.uuid4().hex}"


def replace(
    df: DataFrame, table: str, format: str, partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None
) -> None:
    """Replace a table as a whole. The old rows stay until the new ones are complete, and ``df`` may read them."""
    spark = df.sparkSession
    base = f"{table.rstrip('/')}/{_VERSIONS}"
    known = names_in(spark, base)
    latest = max((int(name.partition("-")[0]) for name in known), default=0)
    name = f"{latest + 1:012d}-{uuid.uuid4().hex}"
    commit(df, f"{base}/{name}", new_writer(), 0, format, partition_by, options)
    write_text(spark, f"{base}/{name}/{_REPLACED}", "")
    _drop_outdated(spark, table)


def _drop_outdated(spark: SparkSession, table: str) -> None:
    """Delete what came before the last ``_KEPT_VERSIONS`` replacements, and what failed before them."""
    base = f"{table.rstrip('/')}/{_VERSIONS}"
    complete = _versions(spark, table)
    if len(complete) < _KEPT_VERSIONS:
        return
    for name in names_in(spark, base):
        if name < complete[-_KEPT_VERSIONS]:
            location, files = located(spark, f"{base}/{name}")
            files.delete(location, True)
    for name in names_in(spark, table):  # the table as it was before its first replacement
        if _shown(name) or name == _COMMITS:
            location, files = located(spark, f"{table.rstrip('/')}/{name}")
            files.delete(location, True)


def _complete(spark: SparkSession, folder: str) -> list[str]:
    """Folders of all complete writes."""
    there = {name.partition("=")[2] for name in names_in(spark, folder) if name.startswith(f"{WRITER}=")}
    return [
        _write_path(folder, writer, int(number))
        for writer in names_in(spark, f"{folder}/{_COMMITS}")
        if writer in there
        for number in names_in(spark, f"{folder}/{_COMMITS}/{writer}")
        if number.isdigit()
    ]


def read_folder(
    spark: SparkSession, table: str, format: str, schema: T.StructType | None, options: Mapping[str, str], keep_commits: bool
) -> DataFrame:
    """All complete writes of a table, and files that lie beside them."""
    folder = current_folder(spark, table)
    writes = _complete(spark, folder)
    beside = [name for name in names_in(spark, folder) if _shown(name) and not name.startswith(f"{WRITER}=")]

    def load(paths: list[str], shape: T.StructType | None) -> DataFrame:
        reader = spark.read.format(format).options(**options)
        if paths != [folder]:
            reader = reader.option("basePath", folder)
        return (reader if shape is None else reader.schema(shape)).load(paths)

    parts = []
    if writes:
        shape = None
        if schema is not None:
            shape = T.StructType([*schema.fields, T.StructField(WRITER, T.StringType()), T.StructField(NUMBER, T.LongType())])
        found = load(writes, shape)
        parts.append(found.withColumn(NUMBER, F.col(NUMBER).cast("long")) if keep_commits else found.drop(*COMMIT_COLUMNS))
    if beside or not writes and (schema is None or not exists(spark, f"{folder}/{_COMMITS}")):
        started = bool(writes) or any(name.startswith(f"{WRITER}=") for name in names_in(spark, folder))
        found = load([f"{folder}/{name}" for name in beside] if started else [folder], schema)
        if keep_commits:
            found = found.withColumns({WRITER: F.lit(None).cast("string"), NUMBER: F.lit(None).cast("long")})
        parts.append(found)
    if not parts:
        empty = spark.createDataFrame([], schema)
        return empty.withColumns({WRITER: F.lit(None).cast("string"), NUMBER: F.lit(None).cast("long")}) if keep_commits else empty
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
