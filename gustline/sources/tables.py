"""Batch tables. The storage format is a parameter everywhere (``parquet``, or ``delta`` where its
jar is on the class path)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline.schemas import MAPPING_SCHEMA, REPORT_SCHEMA
from gustline.sources.commits import commit, current_folder, new_writer, read_folder, replace
from gustline.sources.streams import PLAIN_FORMATS, refuse_sink_log


def read_table(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: T.StructType | None = None,
    options: Mapping[str, str] | None = None,
    keep_commits: bool = False,
) -> DataFrame:
    """Scan a table. Give the schema where it is known: it saves the footer reads of inference and
    pins the type of partition columns.

    A table of a plain file format is read as of its complete writes (see ``commits``): rows of a job
    that is running or has failed are not seen. ``keep_commits`` adds the writer and number of each
    row's write.
    """
    if format in PLAIN_FORMATS:
        return read_folder(spark, path, format, schema, options or {}, keep_commits)
    reader = spark.read.format(format).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def _gathered(df: DataFrame, partition_by: Sequence[str], gather: bool) -> DataFrame:
    """One shuffle that gathers a partition's rows into few files; AQE splits a partition that is far
    larger than the rest (one day with a third of all rows) over several tasks."""
    return df.hint("rebalance", *partition_by) if partition_by and gather else df


def _write(df: DataFrame, path: str, mode: str, format: str, partition_by: Sequence[str], options: Mapping[str, str]) -> None:
    writer = df.write.format(format).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def append_table(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    partition_by: Sequence[str] = (),
    gather: bool = True,
    options: Mapping[str, str] | None = None,
) -> None:
    """Add rows to a table; readers see all of them or none. A partitioned write shuffles once to keep
    the number of files small; turn ``gather`` off for input whose tasks hold few partition values each,
    such as rows in time order."""
    df = _gathered(df, partition_by, gather)
    if format not in PLAIN_FORMATS:
        _write(df, path, "append", format, partition_by, options or {})
        return
    refuse_sink_log(df.sparkSession, path)
    commit(df, current_folder(df.sparkSession, path), new_writer(), 0, format, partition_by, options)


def replace_table(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    partition_by: Sequence[str] = (),
    gather: bool = True,
    options: Mapping[str, str] | None = None,
) -> None:
    """Replace a table as a whole. Until the new rows are complete, and if the job fails, readers see the
    old ones; ``df`` may read the table itself. The replaced rows are deleted by the next replacement."""
    df = _gathered(df, partition_by, gather)
    if format not in PLAIN_FORMATS:
        _write(df, path, "overwrite", format, partition_by, options or {})
        return
    refuse_sink_log(df.sparkSession, path)
    replace(df, path, format, partition_by, options)


def _qualified(path: str) -> str:
    """Path with scheme and absolute place, as the file system knows it."""
    spark = SparkSession.active()
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(location).toString().rstrip("/") + "/"


def check_apart(source: str, *targets: str) -> None:
    """Refuse targets that are, hold or lie in the source table or another target."""
    paths = [_qualified(path) for path in (source, *targets)]
    for i, one in enumerate(paths):
        for other in paths[i + 1 :]:
            if one.startswith(other) or other.startswith(one):
                raise ValueError(f"{one} and {other} overlap")


def preview(df: DataFrame, rows: int = 20, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """First rows of a frame; with an order it is a distributed top-k, not a full sort."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullability."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return inline_relation(df.sparkSession, rows, REPORT_SCHEMA)


def inline_relation(spark: SparkSession, rows: Sequence[Sequence[object]], schema: T.StructType) -> DataFrame:
    """Relation of a few literal rows. It is part of the plan itself, so reading it back or filtering
    it needs no job and no Python worker. Values are bound as parameters, not pasted."""
    if not rows:
        return spark.createDataFrame([], schema)
    texts = ", ".join("(" + ", ".join(f":v{i}_{j}" for j in range(len(row))) + ")" for i, row in enumerate(rows))
    names = ", ".join(f"c{j}" for j in range(len(schema)))
    values = {f"v{i}_{j}": value for i, row in enumerate(rows) for j, value in enumerate(row)}
    literal = spark.sql(f"SELECT * FROM VALUES {texts} AS literal({names})", args=values)
    return literal.select(*(F.col(f"c{j}").cast(f.dataType).alias(f.name) for j, f in enumerate(schema)))


def mapping_relation(spark: SparkSession, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Name mapping as an inline relation."""
    return inline_relation(spark, pairs, MAPPING_SCHEMA)


def mapping_view(spark: SparkSession, pairs: Sequence[tuple[str, str]], view: str) -> DataFrame:
    """Name mapping as a temporary view made by SQL: one literal SELECT per pair under UNION ALL
    (bag semantics; names from the first arm). Names are bound as parameters, not pasted."""
    names = MAPPING_SCHEMA.fieldNames()
    arms = [
        "SELECT " + ", ".join(f":p{i}_{j} AS {name}" if i == 0 else f":p{i}_{j}" for j, name in enumerate(names))
        for i in range(len(pairs))
    ]
    values = {f"p{i}_{j}": text for i, pair in enumerate(pairs) for j, text in enumerate(pair)}
    spark.sql(" UNION ALL ".join(arms), args=values).createOrReplaceTempView(view)
    return spark.table(view)


def batch_sizes(readings: DataFrame) -> DataFrame:
    """Rows per ingested micro-batch and the running total, from the stored table.

    Every row of a micro-batch carries the same ``create_ts``, so the table itself is the counter:
    the numbers survive restarts and need no callback. The running total is taken within a day and
    then shifted by the total of the days before, so the one window without a partition sees a row
    per day only.
    """
    batches = readings.groupBy("create_date", "create_ts").agg(F.count(F.lit(1)).alias("batch_rows"))
    within = Window.partitionBy("create_date").orderBy("create_ts").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("create_date").rowsBetween(Window.unboundedPreceding, -1)
    days = (
        batches.groupBy("create_date")
        .agg(F.sum("batch_rows").alias("day_rows"))
        .select("create_date", F.coalesce(F.sum("day_rows").over(earlier), F.lit(0)).alias("rows_before"))
    )
    return (
        batches.withColumn("within_day", F.sum("batch_rows").over(within))
        .join(days, "create_date", "left")
        .select("create_ts", "batch_rows", (F.col("rows_before") + F.col("within_day")).alias("total_rows"))
    )
