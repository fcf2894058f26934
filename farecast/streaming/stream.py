"""Structured Streaming: bronze files -> silver + predictions, upserted.

The micro-batch transform is the batch code applied to the batch frame
(``foreachBatch``), so stream and batch give the same rows. Writes go to the
batches of upsert logs (see ``farecast.operators.sinks``), identified by the
stream's id and the micro-batch's: one retried after a failure is known as
such, so the result is exactly-once without transactional table support.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from farecast.operators.features import model_matrix
from farecast.operators.model import Run, score
from farecast.operators.silver import to_silver
from farecast.operators.sinks import DEFAULT_WRITER, Batch, upsert, upsert_into
from farecast.schemas import BRONZE
from farecast.session import session_id

ROW_GROUP_BYTES = 4 << 20  # of a landed file; Spark's smallest split is as large

BatchFn = Callable[[DataFrame, int], None]


def stream_trips(
    spark: SparkSession,
    path: str,
    schema: T.StructType = BRONZE,
    max_files: int | None = None,
    fmt: str = "parquet",
    max_bytes: int = 64 << 30,
    ignore_missing: bool = True,
    clean_source: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Stream the files landing in ``path``.

    A file source reads every file once, in arrival order. Upstream removals
    and rewrites are passed over (S5): rows that were processed stay in the
    sink, a file rewritten under its name is not read again, and a file that
    is removed before it is read counts as empty (with ``ignore_missing=False``
    the run fails if its batch was planned already). A micro-batch is bounded
    by ``max_bytes``, or by ``max_files`` if given. ``clean_source`` lets the
    source delete or archive (to ``archive``) the files it has completed.
    """
    reader = spark.readStream.schema(schema).format(fmt).option("ignoreMissingFiles", str(ignore_missing).lower())
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive:
            reader = reader.option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files)))
    else:
        reader = reader.option("maxBytesPerTrigger", str(int(max_bytes)))
    return reader.load(path)


def land_files(df: DataFrame, path: str, files: int, key: str = "trip_id") -> None:
    """Write ``df`` as up to ``files`` files split by key range (to feed a stream).

    Their row groups are small, so that a micro-batch of one file is read by many tasks."""
    writer = df.repartitionByRange(int(files), key).write.mode("append")
    writer.option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path)


def _writer(batch: DataFrame) -> str:
    """The stream's id: kept in its checkpoint, so the same after a restart and another for a new checkpoint."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return found or DEFAULT_WRITER


def _write(df: DataFrame, target: str, batch_id: int, table: bool, writer: str, check_unique: bool) -> Batch:
    return (upsert_into if table else upsert)(df, target, batch_id, check_unique=check_unique, writer=writer)


def _write_once(df: DataFrame, target: str, batch_id: int, table: bool, writer: str, check_unique: bool) -> Batch:
    """Write a micro-batch and count its rows as they are written, for the run's progress report.

    One that is checked first is kept meanwhile, so its source is read once."""
    if check_unique:
        df = df.persist()
    rows = Observation()
    try:
        batch = _write(df.observe(rows, F.count(F.lit(1)).alias("rows")), target, batch_id, table, writer, check_unique)
    finally:
        if check_unique:
            df.unpersist()
    _counter(df.sparkSession).wrote(writer, batch_id, _observed(rows, df, batch) if batch.new else 0)
    return batch


def _observed(rows: Observation, df: DataFrame, batch: Batch) -> int:
    try:
        return rows.get["rows"]
    except Py4JJavaError:  # a batch that turns out empty is planned away, and its observation with it
        return df.sparkSession.read.schema(df.schema).parquet(batch.path).count()


def silver_batch(silver_log: str, table: bool = False, check_unique: bool = True) -> BatchFn:
    """foreachBatch function: bronze batch -> silver rows upserted by trip_id.

    ``silver_log`` is a path, or with ``table=True`` an upsert log table (see
    ``create_upsert_table``) whose latest view needs no shuffle.
    ``check_unique`` verifies each batch's keys (one extra job per batch);
    keys assigned by ``load_bronze`` are unique by construction.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        _write_once(to_silver(batch), silver_log, batch_id, table, _writer(batch), check_unique)

    return run


def scoring_batch(
    silver_log: str, prediction_log: str, run: Run, table: bool = False, check_unique: bool = True
) -> BatchFn:
    """foreachBatch function (M3, M4): bronze batch -> silver -> features ->
    prediction, both upserted by trip_id under the micro-batch id.

    Scoring reads the silver partition just written instead of recomputing
    the batch from the source; its keys were checked there, and predictions
    map one to one onto those rows, so they are not checked again.
    """

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        silver, writer = to_silver(batch), _writer(batch)
        written = _write_once(silver, silver_log, batch_id, table, writer, check_unique)
        silver = batch.sparkSession.read.schema(silver.schema).parquet(written.path)
        _write(score(model_matrix(silver), run), prediction_log, batch_id, table, writer, check_unique=False)

    return run_batch


def run_stream(
    source: DataFrame,
    process: BatchFn,
    checkpoint: str,
    trigger: str = "availableNow",
    name: str | None = None,
) -> StreamingQuery:
    """Start ``process`` over ``source`` (M1, M2).

    ``trigger='availableNow'`` drains what is there and stops; any other value
    is a processing-time interval such as ``'10 seconds'`` (continuous).
    Progress is kept in ``checkpoint``; a restart resumes after the last
    committed batch.
    """
    counter = _counter(source.sparkSession)
    writer = source.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if trigger == "availableNow" else writer.trigger(processingTime=trigger)
    query = writer.start()
    _RUNNING[str(query.runId)] = counter
    return query


class _Counter(StreamingQueryListener):
    """Batches with input and rows read of every run, from all of its progress events, and rows its
    batches wrote. A run's entry is dropped when its report is taken after its end."""

    def __init__(self):
        self.seen: dict[str, list[int]] = {}
        self.ended: dict[str, threading.Event] = {}
        self.written: dict[str, dict[int, int]] = {}  # by the stream's id, which all runs on a checkpoint share

    def of(self, run_id: str) -> tuple[list[int], threading.Event]:
        return self.seen.setdefault(run_id, [0, 0]), self.ended.setdefault(run_id, threading.Event())

    def wrote(self, stream: str, batch_id: int, rows: int) -> None:
        self.written.setdefault(stream, {})[batch_id] = int(rows)

    def drop(self, run_id: str, stream: str) -> None:
        for entries, name in ((self.seen, run_id), (self.ended, run_id), (self.written, stream)):
            entries.pop(name, None)

    def onQueryStarted(self, event):
        self.of(str(event.runId))

    def onQueryProgress(self, event):
        counts, _ = self.of(str(event.progress.runId))
        if event.progress.numInputRows > 0:
            counts[0] += 1
            counts[1] += event.progress.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.of(str(event.runId))[1].set()


_COUNTERS: dict[str, _Counter] = {}
_RUNNING: dict[str, _Counter] = {}  # run id -> counter of the session that started it


def _counter(spark: SparkSession) -> _Counter:
    """The application's counter, listening from before its first stream is started."""
    app = session_id(spark)
    if app not in _COUNTERS:
        _COUNTERS[app] = _Counter()
        spark.streams.addListener(_COUNTERS[app])
    return _COUNTERS[app]


@dataclass
class Progress:
    batches: int  # with input
    rows: int  # read
    finished: bool
    written: int = 0  # rows the run's batches wrote to the (first) sink


def await_progress(
    query: StreamingQuery, timeout_s: float | None = None, stop: bool = False, event_timeout_s: float = 60
) -> Progress:
    """Wait for the query and report batches with input, rows read and rows written.

    Counts cover the whole run (every progress event, however many). With
    ``timeout_s`` the wait is bounded and ``finished`` tells whether the run
    had ended; ``stop`` then stops a query that is still running and raises,
    so that a part is never taken for the whole (its progress stays in the
    checkpoint and a restart resumes). The last events are delivered after a
    run has ended; if the end itself is not reported within
    ``event_timeout_s``, the counts may be short and TimeoutError is raised.
    """
    finished = bool(query.awaitTermination(timeout_s)) if timeout_s is not None else (query.awaitTermination() or True)
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    if stop and query.isActive:
        query.stop()
        raise TimeoutError(f"the stream had not ended after {timeout_s} s and was stopped")
    counter, run_id, stream = _RUNNING[str(query.runId)], str(query.runId), str(query.id)
    counts, ended = counter.of(run_id)
    if finished and not ended.wait(event_timeout_s):
        raise TimeoutError(f"the end of run {run_id} was not reported within {event_timeout_s} s: its counts may be short")
    progress = Progress(counts[0], counts[1], finished, sum(counter.written.get(stream, {}).values()))
    if finished:
        counter.drop(run_id, stream)
        _RUNNING.pop(run_id, None)
    return progress
