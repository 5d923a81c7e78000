"""Starting streams, and reading back what they wrote.

Each query has a folder of its own with ``data`` and ``checkpoint`` below it. Results always
go to files that every executor can reach; nothing is gathered on the driver.

=========  ===============================================================
mode       how it is stored
=========  ===============================================================
append     parquet sink; rows are final
update     one folder per micro-batch; reading keeps the latest row per key
complete   one folder per micro-batch; reading takes the latest folder
partials   one folder per micro-batch of sums; reading adds them up
=========  ===============================================================

Folders carry the batch number, and a batch that runs again overwrites its own, so a
restart neither loses nor repeats rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.session import shared_folder

Batch = Callable[[DataFrame, int], None]
Output = Callable[[DataFrame], DataFrame]


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def append_to_files(stream: DataFrame, folder: str, every: str | None = None) -> StreamingQuery:
    """Append-mode parquet sink. Without ``every`` it takes what is there and stops."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", f"{folder}/data").option("checkpointLocation", f"{folder}/checkpoint")
    return writer.trigger(**_trigger(every)).start()


def each_batch(
    stream: DataFrame, folder: str, work: Batch, mode: str = "append", every: str | None = None
) -> StreamingQuery:
    """Run ``work(batch, batch_id)`` on every micro-batch."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(work)
    return writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(**_trigger(every)).start()


def to_console(stream: DataFrame, mode: str = "append", rows: int = 20, every: str | None = None) -> StreamingQuery:
    """Print each batch; a debugging aid."""
    writer = stream.writeStream.format("console").outputMode(mode)
    return writer.option("truncate", "false").option("numRows", rows).trigger(**_trigger(every)).start()


def save_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch to its own folder, replacing what an earlier attempt left there."""
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All saved batches with their ``batch_id``."""
    return spark.read.schema(StructType([*schema.fields, StructField("batch_id", LongType())])).parquet(path)


def run_for(query: StreamingQuery, seconds: int) -> None:
    """Let a continuous query run for a while, then stop it."""
    try:
        query.awaitTermination(timeout=seconds)
    finally:
        query.stop()


def finish(query: StreamingQuery) -> list[dict]:
    """Wait for an available-now query; returns its progress reports."""
    query.awaitTermination()
    return [p if isinstance(p, dict) else _as_dict(p) for p in query.recentProgress]


def _as_dict(progress) -> dict:
    return json.loads(progress.json)


def late_rows(progress: list[dict]) -> int:
    """Rows that came after their window had closed."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in progress for op in p.get("stateOperators", []))


def state_rows(progress: list[dict]) -> int:
    """Rows held in state after the last batch."""
    return sum(op.get("numRowsTotal", 0) for op in progress[-1].get("stateOperators", [])) if progress else 0


_METRICS = "run_id string, batch_id bigint, input_rows bigint, late_rows bigint, state_rows bigint, state_bytes bigint, observed map<string, string>"


class _Recorder(StreamingQueryListener):
    """Rows of ``_METRICS`` for every batch, written to a folder a hundred at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.rows = spark, path, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        total = lambda name: sum(getattr(op, name) for op in p.stateOperators)
        observed = {f"{name}.{k}": str(v) for name, row in p.observedMetrics.items() for k, v in row.asDict().items()}
        figures = p.numInputRows, total("numRowsDroppedByWatermark"), total("numRowsTotal"), total("memoryUsedBytes")
        self.rows.append((str(p.runId), p.batchId, *figures, observed))
        if len(self.rows) >= 100:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, _METRICS).coalesce(1).write.mode("append").parquet(self.path)


@contextmanager
def recorded(spark: SparkSession, path: str):
    """Keep the figures of every batch of the streams that run inside the block: however many, unlike
    ``recentProgress``, which forgets all but the last hundred. Read them with ``progress_table``."""
    recorder = _Recorder(spark, path)
    spark.streams.addListener(recorder)
    try:
        yield recorder
    finally:
        # Reports come a moment after their batch.
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        spark.streams.removeListener(recorder)
        recorder.flush()


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """Input, late rows, size of the state and observed figures of each recorded batch. A batch that ran again in a later run has a row for each."""
    return spark.read.schema(_METRICS).parquet(path)


def state_sizes(spark: SparkSession, folder: str, operator: int = 0) -> DataFrame:
    """Rows that the state of a stopped stream holds, by partition: skew of its keys shows here."""
    state = spark.read.format("statestore").option("operatorId", operator).load(f"{folder}/checkpoint")
    return state.groupBy("partition_id").agg(F.count("*").alias("rows"))


def replay(stream: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Run to the end of the input in append mode and return the written rows. A ``folder`` used before is gone on with."""
    spark = stream.sparkSession
    folder = folder or shared_folder(spark, label)
    finish(append_to_files(stream, folder))
    return spark.read.schema(stream.schema).parquet(f"{folder}/data")


def replay_arrivals(
    parts: list[DataFrame], shape: Output, label: str, mode: str = "append", keys: list[str] | None = None, outputs: dict[str, Output] | None = None
) -> DataFrame | dict[str, DataFrame]:
    """A stream whose rows arrive part by part, as one query that goes on from its checkpoint.

    The files of a part land in the source folder, the query takes them and stops: one batch for its rows and
    one more to let the watermark close windows. ``shape`` makes the result of the stream. Rows are late
    by the watermark that the parts before have set. The result is read as the mode has it: appended
    rows, the latest row per key of ``keys``, or the last complete table. With ``outputs`` these are stored for each batch and
    returned with their ``batch_id``.
    """
    spark = parts[0].sparkSession
    arrive, folder, schema = shared_folder(spark, f"{label}-arrivals"), shared_folder(spark, label), parts[0].schema
    found: DataFrame | dict[str, DataFrame] | None = None
    for part in parts:
        part.write.mode("append").parquet(arrive)
        stream = shape(spark.readStream.schema(schema).parquet(arrive))
        if outputs is not None:
            found = replay_outputs(stream, label, outputs, mode, folder)
        elif mode == "update":
            found = replay_updates(stream, label, keys or [], folder)
        elif mode == "complete":
            found = replay_complete(stream, label, folder)
        else:
            found = replay(stream, label, folder)
    return found


def _before_the_first(stream: DataFrame) -> DataFrame:
    """A bounded frame like a batch of ``stream``, without rows."""
    return stream.sparkSession.createDataFrame([], stream.schema)


def replay_outputs(
    stream: DataFrame, label: str, outputs: dict[str, Output], mode: str = "append", folder: str | None = None
) -> dict[str, DataFrame]:
    """Several outputs of one stream, each stored per batch and returned with its ``batch_id``.

    With more than one output the batch is kept (memory, then disk) while they are written,
    so the source is not read again for each. An empty batch -1 is stored first: a stream
    that gets no rows has an empty result.
    """
    spark = stream.sparkSession
    folder = folder or shared_folder(spark, label)
    empty = _before_the_first(stream)
    schemas = {}
    for name, output in outputs.items():
        nothing = output(empty)
        schemas[name] = nothing.schema
        save_batch(nothing, f"{folder}/{name}", -1)

    def work(batch: DataFrame, batch_id: int) -> None:
        if len(outputs) > 1:
            batch.persist()
        try:
            for name, output in outputs.items():
                save_batch(output(batch), f"{folder}/{name}", batch_id)
        finally:
            if len(outputs) > 1:
                batch.unpersist()

    finish(each_batch(stream, folder, work, mode))
    return {name: read_batches(spark, f"{folder}/{name}", schema) for name, schema in schemas.items()}


def replay_updates(stream: DataFrame, label: str, keys: list[str], folder: str | None = None) -> DataFrame:
    """Update mode: every changed row is stored, the latest per key is returned."""
    saved = replay_outputs(stream, label, {"data": _as_it_is}, "update", folder)["data"]
    newest = F.max_by(F.struct(*stream.columns), "batch_id").alias("row")
    return saved.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(newest).select("row.*")


def replay_complete(stream: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Complete mode: the result as of the last batch."""
    saved = replay_outputs(stream, label, {"data": _as_it_is}, "complete", folder)["data"]
    last = saved.agg(F.max("batch_id")).scalar()
    return saved.filter(F.col("batch_id") == last).drop("batch_id")


def replay_partials(stream: DataFrame, label: str, summarise: Output) -> DataFrame:
    """Store ``summarise(batch)`` of every batch and return all stored rows.

    Running totals without a growing state: the totals are the sum of the stored parts.
    """
    return replay_outputs(stream, label, {"data": summarise})["data"]


def _as_it_is(batch: DataFrame) -> DataFrame:
    return batch


def window_bounds(name: str = "window") -> list[Column]:
    """Start and end of a window column, free of the session time zone."""
    return [
        F.col(f"{name}.start").cast("timestamp_ntz").alias("window_start"),
        F.col(f"{name}.end").cast("timestamp_ntz").alias("window_end"),
    ]
