"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators are written for: times without a zone are read
# as UTC, and Spark re-plans with measured sizes and splits hot join keys.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.chunkBase64String.enabled": "false",
    # State of streams lives on disk, and only its changes are written per micro-batch.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# What one shuffle partition should hold at most.
_PARTITION_BYTES = 128 * 1024 * 1024


def configure(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings to an existing session.

    `shuffle_bytes`, the size of the captures a large job works on, sets how
    many partitions a shuffle starts with. AQE merges those that turn out small
    but does not add any, so 100 TB need the number said up front.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if shuffle_bytes is not None:
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shuffle_bytes // _PARTITION_BYTES)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from `spark.checkpoint.dir`.

    Only a local session may run without the setting; it then gets a temporary
    folder, which its single machine can always see.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is not None:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="chargestream-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


_paths: list[str] = []
# What the `stage_result` under way in this thread has put into the shared folder.
_under_way: ContextVar[list[str] | None] = ContextVar("under_way", default=None)


def release(spark: SparkSession) -> int:
    """Delete what this session has put into the shared folder; how many paths there were.

    For the job that owns the session, once its results are written: tables
    that `stage` returned cannot be read any more.
    """
    return _delete(spark, list(_paths))


def _delete(spark: SparkSession, paths: list[str]) -> int:
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        _paths.remove(path)
    return len(paths)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and go on from there, until `release`.

    For results that are read more than once: the work above is done once, later
    passes read only the columns they need, and lost executors cost nothing.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_result(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """As `stage`, for what `build` returns; deletes what `build` put into the shared folder, and nothing of other threads.

    So the tables an operator works with need the disk no longer than it works.
    """
    own: list[str] = []
    token = _under_way.set(own)
    try:
        built = build()
    finally:
        _under_way.reset(token)
    result = stage(built, name)
    _delete(spark, [path for path in own if path in _paths])
    return result


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder; `release` deletes it."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _paths.append(path)
    if (own := _under_way.get()) is not None:
        own.append(path)
    return path
