"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from touchline.sinks.records import remove

# 128 MB output files: AQE coalesces and splits shuffle partitions towards it.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
CODEC = "spark.sql.parquet.compression.codec"


def build_session(app: str = "touchline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # Streaming state outside the heap: one row per key of a running table.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # Call-site capture costs a round trip per column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from `spark.checkpoint.dir`.

    Only a local session may go without the setting; it then gets a new
    temporary folder, since there all tasks run on this machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="touchline-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique path below the shared folder (not created yet)."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def freeze(df: DataFrame) -> DataFrame:
    """Compute `df` once into the shared folder and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def stored(df: DataFrame) -> Iterator[DataFrame]:
    """`df` computed once into compressed columns in the shared folder, for the actions inside the block; removed afterwards.

    `freeze` keeps rows as they are in memory, several times as wide, for as long as anything refers to them.
    """
    spark = df.sparkSession
    folder = scratch_dir(spark, "stored")
    try:
        df.write.parquet(folder)
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        remove(spark, folder)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the actions inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def small_on_disk(spark: SparkSession):
    """Settings for a run of many steps, for the queries made and run inside the block.

    Shuffle files go when the query that made them ends; otherwise they stay on the executors' disks until the driver
    happens to collect its garbage, and a run holds the shuffles of all its steps at once. Tables are compressed by zstd,
    unless the session's user has chosen something else.
    """
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
                            CODEC: spark.conf.get(CODEC, None) or "zstd"})
