"""Bounded runs of streaming queries, and the rows of their batches."""

from __future__ import annotations

import threading
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from gustline.sources.streams import note_rows, noted_rows, seconds_of, unnoted_batches
from gustline.streaming.flows import BATCH

_POLL = 0.05
# Longer than any run: a query with this trigger runs one batch and then waits.
_ONE_BATCH = "1000000 days"
_PATIENCE = 30.0  # seconds that the last events of an ended query may take


class BatchLedger(StreamingQueryListener):
    """Rows of the batches of one query, told by the engine's own events.

    Every batch has an event, so none is missed however many there are. With a checkpoint the numbers
    are kept beside it as they come, and outlive the driver (``lifetime_batches``).
    """

    def __init__(self, spark: SparkSession, checkpoint: str | None):
        self.spark, self.checkpoint = spark, checkpoint
        self.rows: dict[int, int] = {}
        self.moved = False  # whether the last run took anything from its source
        self._lock, self._known = threading.Lock(), threading.Condition()
        self._early: dict[str, list] = {}
        self._run: str | None = None
        self._ended: set[str] = set()

    def follow(self, query: StreamingQuery) -> None:
        """Attach to a started query; events that came before are looked through."""
        with self._lock:
            self._run, self.moved = str(query.runId), False
            for progress in self._early.pop(self._run, []):
                self._take(progress)
            self._early.clear()

    def _take(self, progress) -> None:
        if any(source.startOffset != source.endOffset for source in progress.sources):
            self.moved = True
        elif not progress.numInputRows:
            return  # told while it waits for input
        observed = progress.observedMetrics.get(BATCH)
        rows = progress.numInputRows if observed is None else observed["rows"]
        self.rows[progress.batchId] = rows
        if self.checkpoint is not None:
            note_rows(self.spark, self.checkpoint, progress.batchId, rows)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            run = str(event.progress.runId)
            if run == self._run:
                self._take(event.progress)
            else:
                self._early.setdefault(run, []).append(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._known:
            self._ended.add(str(event.runId))
            self._known.notify_all()

    def await_events(self, query: StreamingQuery) -> None:
        """Wait until all events of an ended query are in."""
        with self._known:
            self._known.wait_for(lambda: str(query.runId) in self._ended, _PATIENCE)


def run_bounded(writer: DataStreamWriter, timeout: float | None = None, every: str | None = None) -> StreamingQuery:
    """Run a query to its end or for about ``timeout`` seconds; it resumes from its checkpoint.

    By default it processes what is there now, in as many batches as the source's limits ask for. With a
    timeout, batches are begun one by one until nothing is left or the time is over: the one that runs
    then is ended and committed, and no other is begun, so the next run repeats none. With an interval
    ``every`` (such as "10 seconds") it looks for new input at that pace until the timeout.
    """
    if every is not None and timeout is None:
        raise ValueError("a query with a trigger interval needs a timeout")
    spark = SparkSession.active()
    counts = getattr(writer, "output_rows", None)  # a writer into files counts, and keeps the counts, itself
    ledger = BatchLedger(spark, None if counts is not None else getattr(writer, "checkpoint", None))
    spark.streams.addListener(ledger)
    try:
        if timeout is None:
            query = writer.trigger(availableNow=True).start()
            ledger.follow(query)
            query.awaitTermination()
            ledger.await_events(query)
        else:
            query = _batch_by_batch(writer, ledger, time.monotonic() + timeout, None if every is None else seconds_of(every))
    finally:
        spark.streams.removeListener(ledger)
    query.output_rows = counts
    query.batch_rows = ledger.rows if counts is None else {k: next(iter(n.values()), 0) for k, n in counts.items()}
    return query


def _batch_by_batch(writer: DataStreamWriter, ledger: BatchLedger, end: float, pace: float | None) -> StreamingQuery:
    while True:
        begun = time.monotonic()
        query = writer.trigger(processingTime=_ONE_BATCH).start()
        ledger.follow(query)
        while query.isActive and not _waits(query):
            time.sleep(_POLL)
        query.stop()
        ledger.await_events(query)
        if query.exception() is not None:
            raise query.exception()
        rest = end - time.monotonic()
        if rest <= 0 or pace is None and not ledger.moved:
            return query
        if pace is not None:
            time.sleep(max(0.0, min(begun + pace - time.monotonic(), rest)))
            if end - time.monotonic() <= 0:
                return query


def _waits(query: StreamingQuery) -> bool:
    """Whether the first batch is over (or there was no input for one)."""
    status = query.status
    return not status["isTriggerActive"] and status["message"].startswith("Waiting")


def batch_counts(query: StreamingQuery) -> list[tuple[int, int]]:
    """(batch, rows) of all batches of a run that had rows."""
    return sorted((k, n) for k, n in query.batch_rows.items() if n)


def total_rows(query: StreamingQuery) -> int:
    """Rows of a whole run."""
    return sum(n for _, n in batch_counts(query))


def lifetime_batches(spark: SparkSession, checkpoint: str) -> list[tuple[int, int]]:
    """(batch, rows) of all batches over all runs with this checkpoint, whatever the sink."""
    return sorted(noted_rows(spark, checkpoint).items())


def lifetime_rows(spark: SparkSession, checkpoint: str) -> int:
    """Rows over all runs. An error if a batch was committed without its rows being noted, which takes
    a driver that is lost between the two; ``unnoted_batches`` names it."""
    missing = unnoted_batches(spark, checkpoint)
    if missing:
        raise ValueError(f"rows of batches {missing} are not known")
    return sum(noted_rows(spark, checkpoint).values())
