"""Streaming ends: where messages come from and go to, chosen by format and options."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.java_gateway import JavaObject
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from gustline.schemas import CSV_SCHEMA, TOPIC_SCHEMA
from gustline.sources.commits import commit, current_folder, exists, located, names_in, new_writer, read_text, write_text


# Most bytes a file source hands to one micro-batch. A backlog of many terabytes becomes a row of
# batches that commit one by one, so a lost driver repeats one of them and not the whole backlog.
BATCH_BYTES = 1 << 40

# A file is read whatever its modification time: the file source would by default skip files older than
# the newest by a week. The price: the driver remembers the path of every file seen in this span, so
# give a smaller ``maxFileAge`` where old files never arrive late.
MAX_FILE_AGE = "36500d"

# File formats without a log of their own; see ``commits``.
PLAIN_FORMATS = frozenset({"parquet", "orc", "json", "csv", "text"})


@dataclass(frozen=True)
class Endpoint:
    """A source or sink known to Structured Streaming."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    schema: T.StructType | None = None


def _files(format: str, schema: T.StructType, options: Mapping[str, str]) -> Endpoint:
    given = {name.lower() for name in options}  # option names are not case-sensitive
    defaults = {}
    if not given & {"maxfilespertrigger", "maxbytespertrigger"}:
        defaults["maxBytesPerTrigger"] = str(BATCH_BYTES)
    if "maxfileage" not in given:
        defaults["maxFileAge"] = MAX_FILE_AGE
    return Endpoint(format, defaults | options, schema)


def csv_landing(path: str, archive: str | None = None, age: str = "7 days", **options: str) -> Endpoint:
    """Directory that CSV files with a header are dropped into. Keep it apart from tables and
    checkpoints: every file below it is read. A cell that is not a number becomes NULL.

    With ``archive`` the engine moves files there when a later batch is planned, and the driver remembers
    only the files of the last ``age``. Files that arrive with an older date are found by
    ``readmit_late``, which ``publish`` calls before each run.
    """
    if archive is not None:
        kept = {"cleanSource": "archive", "sourceArchiveDir": archive, "maxFileAge": f"{round(seconds_of(age))}s"}
        options = kept | options
    return _files("csv", CSV_SCHEMA, {"path": path, "header": "true"} | options)


def text_topic(path: str, **options: str) -> Endpoint:
    """Message topic as a directory of text files, one message per line. Folders in it are read as well."""
    return _files("text", TOPIC_SCHEMA, {"path": path, "recursiveFileLookup": "true"} | options)


def kafka_source(servers: str, topic: str, starting: str = "earliest", **options: str) -> Endpoint:
    """Kafka topic to read; ``starting`` applies until a checkpoint exists. Cap a batch with
    ``maxOffsetsPerTrigger`` and split large topic partitions with ``minPartitions``."""
    return Endpoint(
        "kafka",
        {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting} | options,
    )


def kafka_sink(servers: str, topic: str, **options: str) -> Endpoint:
    """Kafka topic to write ``value`` to."""
    return Endpoint("kafka", {"kafka.bootstrap.servers": servers, "topic": topic} | options)


def table_sink(path: str, format: str = "parquet", **options: str) -> Endpoint:
    """Table directory. Formats with a log of their own use their own sink; see ``append_stream``."""
    return Endpoint(format, {"path": path} | options)


def console(rows: int = 20, truncate: bool = True) -> Endpoint:
    """Console of the driver: the first rows of every batch."""
    return Endpoint("console", {"numRows": str(rows), "truncate": str(truncate).lower()})


def open_stream(spark: SparkSession, source: Endpoint) -> DataFrame:
    """Unbounded frame over a source."""
    reader = spark.readStream.format(source.format).options(**source.options)
    if source.schema is not None:
        reader = reader.schema(source.schema)
    return reader.load()


def append_stream(
    df: DataFrame, sink: Endpoint, checkpoint: str | None = None, partition_by: Sequence[str] = ()
) -> DataStreamWriter:
    """Writer that appends a stream to a sink; the checkpoint makes it resume where it stopped.

    A folder of a plain file format takes batches of any number of checkpoints and of batch writes. Each
    batch is one commit of its checkpoint (see ``commits``): written straight to a folder of its own,
    seen by ``read_table`` when it is complete, and left alone when the batch is repeated.
    """
    if sink.format in PLAIN_FORMATS:
        return fan_out(df, {sink.options["path"]: Output(sink, partition_by=partition_by)}, checkpoint, keep=False)
    writer = df.writeStream.format(sink.format).options(**sink.options).outputMode("append")
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.checkpoint = checkpoint
    return writer


@dataclass(frozen=True)
class Output:
    """One of several sinks of a stream: the rows that it takes from a batch, and where they go."""

    sink: Endpoint
    rows: Callable[[DataFrame], DataFrame] = lambda batch: batch
    partition_by: Sequence[str] = ()


def fan_out(df: DataFrame, outputs: Mapping[str, Output], checkpoint: str | None, keep: bool = True) -> DataStreamWriter:
    """Writer that feeds several sinks from one reading of the source.

    A batch is computed once and kept (in memory, then on disk) while its sinks are written one after
    the other; a lost part of it is read again. Plain files and tables with transactions of their own
    take a repeated batch once, so a run that stops between two sinks ends with both whole.
    """
    if checkpoint is None:
        raise ValueError("a stream into files needs a checkpoint")
    spark = df.sparkSession
    for output in outputs.values():
        if output.sink.format in PLAIN_FORMATS:
            refuse_sink_log(spark, output.sink.options["path"])
    identity = _identity(spark, checkpoint)
    counts: dict[int, dict[str, int]] = {}

    def publish(batch: DataFrame, number: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK) if keep else batch
        try:
            counts[number] = {name: _put(output, kept, identity, number) for name, output in outputs.items()}
        finally:
            if keep:
                kept.unpersist()
        note_rows(batch.sparkSession, checkpoint, number, next(iter(counts[number].values()), 0))

    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(publish)
    writer.checkpoint, writer.output_rows = checkpoint, counts
    return writer


def _put(output: Output, batch: DataFrame, identity: str, number: int) -> int:
    """Write one output's share of a batch; the number of its rows."""
    rows, sink = output.rows(batch), output.sink
    options = {name: value for name, value in sink.options.items() if name != "path"}
    if sink.format in PLAIN_FORMATS:
        folder = current_folder(batch.sparkSession, sink.options["path"])
        return commit(rows, folder, identity, number, sink.format, output.partition_by, options)
    if sink.format == "delta":
        options |= {"txnAppId": identity, "txnVersion": str(number)}
    seen = Observation()
    writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(sink.format).mode("append").options(**options)
    writer = writer.partitionBy(*output.partition_by) if output.partition_by else writer
    writer.save(sink.options.get("path"))
    return seen.get["rows"]


def refuse_sink_log(spark: SparkSession, folder: str) -> None:
    """A folder with the log of the engine's file sink is read by that log alone; nothing else may be added."""
    if exists(spark, f"{folder.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{folder} has the log of a streaming file sink; rewrite it as a plain table first")


def _identity(spark: SparkSession, checkpoint: str) -> str:
    """Name of the ingestion, kept with its checkpoint."""
    path = f"{checkpoint.rstrip('/')}/ingestion"
    if not exists(spark, path):
        write_text(spark, path, new_writer())
    name = read_text(spark, path).strip()
    return name if name.startswith("w") else f"w{name}"


# --- rows of each batch, beside the checkpoint ----------------------------------------------------

_ROWS = "batch-rows"
_FOLDED, _TOGETHER = 500, "all-"  # batches whose numbers of rows are gathered in one file


def note_rows(spark: SparkSession, checkpoint: str, number: int, rows: int) -> None:
    """Keep the number of rows of a batch beside its checkpoint, as the name of an empty file. Now and then
    the names are gathered in one file, so there are never many."""
    folder = f"{checkpoint.rstrip('/')}/{_ROWS}"
    write_text(spark, f"{folder}/{number:012d}={rows}", "")
    if (number + 1) % _FOLDED == 0:
        _fold(spark, checkpoint, folder, number)


def _fold(spark: SparkSession, checkpoint: str, folder: str, number: int) -> None:
    old = names_in(spark, folder)
    lines = "\n".join(f"{k}={n}" for k, n in sorted(noted_rows(spark, checkpoint).items()))
    name = f"{_TOGETHER}{number:012d}"
    write_text(spark, f"{folder}/{name}", lines)
    for spare in old:
        if spare != name and not spare.startswith("."):
            location, files = located(spark, f"{folder}/{spare}")
            files.delete(location, False)


def noted_rows(spark: SparkSession, checkpoint: str) -> dict[int, int]:
    """Rows of every batch that a checkpoint's streams have ended, over all their runs."""
    folder = f"{checkpoint.rstrip('/')}/{_ROWS}"
    names = names_in(spark, folder)
    pairs = [line for name in names if name.startswith(_TOGETHER) for line in read_text(spark, f"{folder}/{name}").split("\n")]
    pairs += [name for name in names if "=" in name and not name.startswith(".")]
    return {int(number): int(rows) for number, rows in (pair.split("=") for pair in pairs if pair)}


def unnoted_batches(spark: SparkSession, checkpoint: str) -> list[int]:
    """Batches that were committed without their rows being noted: the driver was lost just then."""
    done = {int(name) for name in names_in(spark, f"{checkpoint.rstrip('/')}/commits") if name.isdigit()}
    return sorted(done - set(noted_rows(spark, checkpoint)))


# --- landing folders that do not grow ------------------------------------------------------------


def readmit_late(spark: SparkSession, landing: Endpoint, checkpoint: str, age: str = "7 days") -> list[str]:
    """Re-date files that arrived in a landing folder with an old modification time.

    With a short ``maxFileAge`` the file source passes over files that are older than the newest by more
    than that. Those that no batch of the checkpoint has read get the present time, and the next run
    reads them. Which were read is looked up in the source's log by a Spark job; only the names of old
    files, which are few once read files are archived, come to the driver.
    """
    location, files = located(spark, landing.options["path"])
    if not files.exists(location):
        return []
    status = [(s.getPath(), s.getModificationTime()) for s in files.listStatus(location) if s.isFile() and _is_input(s)]
    newest = max((at for _, at in status), default=0)
    old = {path.toUri().getPath(): path for path, at in status if at < newest - 1000 * seconds_of(age)}
    if not old:
        return []
    log = f"{checkpoint.rstrip('/')}/sources/0"
    read: set[str] = set()
    if exists(spark, log):
        names = spark.createDataFrame([(name,) for name in old], "path string")
        entries = spark.read.text(log).select(F.get_json_object("value", "$.path").alias("path")).where("path is not null")
        place = F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")  # without scheme and host
        entries = entries.select(F.url_decode(F.replace(place, F.lit("+"), F.lit("%2B"))).alias("path"))
        read = {row.path for row in entries.join(F.broadcast(names), "path", "left_semi").distinct().collect()}
    late = sorted(set(old) - read)
    now = round(time.time() * 1000)
    for name in late:
        files.setTimes(old[name], now, -1)
    return late


def _is_input(status: JavaObject) -> bool:
    return not status.getPath().getName().startswith((".", "_"))


_UNITS = {"millisecond": 0.001, "second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds_of(interval: str) -> float:
    """Seconds of an interval such as "10 seconds" or "7 days"."""
    number, _, unit = interval.strip().partition(" ")
    unit = unit.strip().rstrip("s")
    if unit not in _UNITS:
        raise ValueError(f"not an interval: {interval}")
    return float(number) * _UNITS[unit]
