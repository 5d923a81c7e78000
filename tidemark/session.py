"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a job of this package expects. Sizes follow the cluster, so they are
# not fixed here: give spark.sql.shuffle.partitions when the session is built.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Settings a streaming query takes when it starts.
STREAM_SETTINGS = {
    # State on local disk, with a log of changes per batch: it may outgrow the memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Sessions of one key are merged inside each task before the shuffle as well as after
    # it, so that a hot key sends few rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session with ``SETTINGS``; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STREAM_SETTINGS}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def settings_report(spark: SparkSession) -> dict[str, str]:
    """Current value of each setting above, plus the shuffle partition count."""
    keys = [*SETTINGS, *STREAM_SETTINGS, "spark.sql.shuffle.partitions"]
    return {key: spark.conf.get(key, "Not Set") for key in keys}


@contextmanager
def using(spark: SparkSession, settings: dict[str, str]):
    """Set runtime settings for the duration of a block, then put them back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def partitions_for(df: DataFrame, rows_each: int = 1_000_000, least: int = 8) -> int:
    """How many partitions suit a table, at most ``spark.sql.shuffle.partitions``.

    For what the adaptive planner cannot resize later: state of streams, buckets. The count
    of a stored table is read from its file footers.
    """
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(most, max(least, -(-df.count() // rows_each)))


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local master may run without that setting; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: what depends on the physical layout (partition numbers, range
    bounds) stays as written when an executor is lost and tasks run again.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
