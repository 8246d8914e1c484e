"""File sinks. Every writer replaces its own path, so a repeated write is harmless."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_records(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("protocol",), codec: str = "zstd"
) -> None:
    """Flat records as Parquet, one folder per protocol, oldest to newest inside a file.

    The rebalance hint lets AQE merge small partitions and split a hot client,
    so neither tiny files nor one huge task come about.
    """
    spread = [*dict.fromkeys([*partition_by, "client_id"])]
    (
        df.hint("rebalance", *[F.col(name) for name in spread])
        .sortWithinPartitions(*spread, "seq")
        .write.mode("overwrite")
        .option("compression", codec)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_envelopes(df: DataFrame, path: str, codec: str = "zstd") -> None:
    """One row per batch, one folder per protocol: the body, and what delivering it takes.

    Client, chunk, first and last message, route and encoding stay beside the
    body, so that a batch can be posted and matched with its attempts.
    """
    out = df.write.mode("overwrite").option("compression", codec)
    out.partitionBy("protocol").parquet(path)


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_rejected(df: DataFrame, path: str) -> None:
    """The quarantine table."""
    df.hint("rebalance").write.mode("overwrite").partitionBy("protocol").parquet(path)
