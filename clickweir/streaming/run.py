"""Starting, feeding and watching streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from clickweir.operators.layout import rebalance_by
from clickweir.sources.stream import ISO_MICROS


@dataclass(frozen=True)
class Sink:
    """Where and how one stream is written.

    ``fmt`` is any streaming sink (parquet, json, delta, kafka, memory, ...);
    with ``batch`` set, each micro-batch goes to that function instead.
    ``trigger`` is a processing-time interval, or None to take all data there
    is now and stop. ``settings`` hold for this stream only. With ``partition_by``
    at most ``spread`` tasks of a batch write to one folder.
    """

    name: str
    df: DataFrame
    checkpoint: str
    fmt: str = "parquet"
    path: str | None = None
    mode: str = "append"
    trigger: str | None = None
    partition_by: Sequence[str] = ()
    spread: int = 4
    options: Mapping[str, str] = field(default_factory=dict)
    batch: Callable[[DataFrame, int], None] | None = None
    settings: Mapping[str, str] = field(default_factory=dict)


# Folds the events of a session within each task before they are shuffled, so a user
# with very many events sends few rows to the task that keeps its state.
LOCAL_SESSIONS = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}

_STARTING = Lock()


# Spark turns adaptive execution off in the session of a stream with state; what a
# micro-batch function does with its rows needs no fixed partitions.
_ADAPTIVE = {"spark.sql.adaptive.enabled": "true"}


@contextmanager
def _settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """``wanted`` set inside the block, and what was there before after it."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def start(sink: Sink) -> StreamingQuery:
    """Start one stream with its own checkpoint, and a copy of its session's settings."""
    with _STARTING, _settings(sink.df.sparkSession, sink.settings):
        return _start(sink)


def _by_folder(df: DataFrame, by: Sequence[str], spread: int) -> DataFrame:
    """Rows of one folder brought to ``spread`` tasks at most, by the tasks they come from.

    Otherwise each task writes a file to every folder it has a row of. The rebalance
    hint would fit the tasks to the rows, but a stream with state drops it.
    """
    dealt = df.withColumn("_dealt", F.spark_partition_id() % spread)
    return dealt.repartition(*by, "_dealt").drop("_dealt")


def _start(sink: Sink) -> StreamingQuery:
    df = sink.df
    if sink.partition_by and not sink.batch:
        df = _by_folder(df, sink.partition_by, sink.spread)
    writer = (
        df.writeStream.queryName(sink.name)
        .outputMode(sink.mode)
        .option("checkpointLocation", sink.checkpoint)
        .options(**dict(sink.options))
    )
    if sink.trigger:
        writer = writer.trigger(processingTime=sink.trigger)
    else:
        writer = writer.trigger(availableNow=True)
    if sink.batch:
        return writer.foreachBatch(sink.batch).start()
    writer = writer.format(sink.fmt)
    if sink.fmt == "json" and "timestampFormat" not in sink.options:
        writer = writer.option("timestampFormat", ISO_MICROS)
    if sink.partition_by:
        writer = writer.partitionBy(*sink.partition_by)
    return writer.start(sink.path) if sink.path else writer.start()


def start_all(sinks: Sequence[Sink]) -> list[StreamingQuery]:
    """Start every stream and return every handle; if one fails to start, stop the others."""
    checkpoints = [s.checkpoint for s in sinks]
    if len(set(checkpoints)) != len(checkpoints):
        raise ValueError("every stream needs its own checkpoint")
    running: list[StreamingQuery] = []
    try:
        for sink in sinks:
            running.append(start(sink))
    except Exception:
        stop_all(running)
        raise
    return running


def wait_all(queries: Sequence[StreamingQuery], timeout: float) -> bool:
    """Wait up to ``timeout`` seconds for all to end; then stop what still runs.

    True when all ended by themselves. As soon as one fails, the others are
    stopped and its error is raised.
    """
    deadline = time.monotonic() + timeout
    try:
        while True:
            for query in queries:
                error = query.exception()
                if error is not None:
                    raise error
            waiting = [query for query in queries if query.isActive]
            left = deadline - time.monotonic()
            if not waiting or left <= 0:
                return not waiting
            waiting[0].awaitTermination(max(0.1, min(1.0, left)))
    finally:
        stop_all(queries)


def stop_all(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def claim(spark: SparkSession, target: str, checkpoint: str) -> None:
    """Note in ``target`` which stream writes it, or raise if another one does.

    Batch numbers are only meaningful within one checkpoint: a second stream, or
    the same one started over with a new checkpoint, would count from 0 again
    and replace folders that are already there.
    """
    writer = spark.read.text(f"{checkpoint}/metadata").first()[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_writer")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        # Fails if another stream creates it meanwhile.
        out = store.create(path, False)
        out.write(bytearray(writer.encode()))
        out.close()
        return
    data = store.open(path)
    found = bytes(data.readAllBytes()).decode()
    data.close()
    if found != writer:
        raise ValueError(f"{target} belongs to the stream {found}, not to {writer}")


def fan_out(
    outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
    base: str,
    checkpoint: str,
    fmt: str = "parquet",
    *,
    formats: Mapping[str, str] | None = None,
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A micro-batch function that reads the source once and writes several outputs.

    Each output replaces its own ``batch_id`` folder, so a repeated batch
    leaves the same rows. ``base`` belongs to the stream of ``checkpoint``.
    ``formats`` and ``partition_by`` are by output, where they are not the default.
    A partitioned output is rebalanced first: otherwise each of the batch's tasks
    would write a file to every folder it has a row of.
    """
    formats, partition_by = formats or {}, partition_by or {}

    def write(batch: DataFrame, batch_id: int) -> None:
        claim(batch.sparkSession, base, checkpoint)
        held = batch.persist()
        try:
            for name, shape in outputs.items():
                kind, by = formats.get(name, fmt), partition_by.get(name)
                # Spark drops the hint where adaptive execution is off.
                with _settings(batch.sparkSession, _ADAPTIVE if by else {}):
                    rows = rebalance_by(shape(held), by) if by else shape(held)
                    writer = rows.write.mode("overwrite").format(kind)
                    if kind == "json":
                        writer = writer.option("timestampFormat", ISO_MICROS)
                    if by:
                        writer = writer.partitionBy(*by)
                    writer.save(f"{base}/{name}/batch_id={batch_id}")
        finally:
            held.unpersist()

    return write


def upsert_batch(
    path: str, checkpoint: str, fmt: str = "parquet"
) -> Callable[[DataFrame, int], None]:
    """A micro-batch function for update mode on plain files.

    Every batch writes only its changed rows, to its own ``batch_id`` folder;
    nothing written before is read or rewritten, and a repeated batch replaces
    itself. ``read_latest`` gives the current row per key. ``path`` belongs to
    the stream of ``checkpoint``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        claim(batch.sparkSession, path, checkpoint)
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")

    return write


def read_latest(
    spark: SparkSession, path: str, keys: Sequence[str], fmt: str = "parquet"
) -> DataFrame:
    """The current row per key of a table written by ``upsert_batch``."""
    newest = Window.partitionBy(*keys).orderBy(F.col("batch_id").desc())
    return (
        spark.read.format(fmt)
        .option("basePath", path)
        .load(path)
        .withColumn("_rank", F.row_number().over(newest))
        .where("_rank = 1")
        .drop("_rank", "batch_id")
    )


def collapse(spark: SparkSession, path: str, target: str, keys: Sequence[str]) -> None:
    """Write the current rows of an upserted table as batch -1 of a new table."""
    read_latest(spark, path, keys).write.mode("overwrite").parquet(f"{target}/batch_id=-1")


PROGRESS = (
    "name string, batch_id long, at string, input_rows long, input_rate double, "
    "processed_rate double, watermark string, state_rows long, late_rows long"
)


class ProgressLog(StreamingQueryListener):
    """Appends one row per micro-batch of the streams started after it to a table.

    Spark itself only remembers the last 100 updates of a stream. Rows are
    written in groups of ``every``, and when a stream ends, so the driver holds
    few of them; rows of a failed write are kept for the next. Streams that ran
    before it was registered are not logged. Register with
    ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 200):
        self._spark, self._path, self._every = spark, path, every
        self._rows: list[tuple] = []
        self._lock = Lock()
        self.started: set[str] = set()
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        self.started.add(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        if str(report.runId) not in self.started:
            return
        states = report.stateOperators
        row = (
            report.name,
            int(report.batchId),
            report.timestamp,
            int(report.numInputRows),
            float(report.inputRowsPerSecond or 0.0),
            float(report.processedRowsPerSecond or 0.0),
            report.eventTime.get("watermark"),
            sum(int(s.numRowsTotal) for s in states),
            sum(int(s.numRowsDroppedByWatermark) for s in states),
        )
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self._every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.started:
            try:
                self.flush()
            finally:
                self.ended.add(str(event.runId))

    def flush(self) -> None:
        """Write what has come in since the last time."""
        with self._lock:
            rows, self._rows = self._rows, []
        if not rows:
            return
        try:
            self._spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(
                self._path
            )
        except Exception:
            with self._lock:
                self._rows = rows + self._rows
            raise


@contextmanager
def logged_progress(spark: SparkSession, path: str, patience: float = 60) -> Iterator[ProgressLog]:
    """A ``ProgressLog`` for the streams started inside the block, complete after it."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
        # Updates reach listeners a little after the stream; an end is the last of them.
        deadline = time.monotonic() + patience
        while log.started - log.ended:
            if any(str(query.runId) in log.started for query in spark.streams.active):
                deadline = time.monotonic() + patience
            elif time.monotonic() > deadline:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
        log.flush()


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch: input, rates, watermark, state, dropped late rows."""
    return spark.read.schema(PROGRESS).parquet(path)
