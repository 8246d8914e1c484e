"""Bounded buffering: of each client (and flush cycle) the newest messages survive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..session import stage
from .admission import add_reason
from .ordering import bucket_of, total_before

Hold = Callable[[DataFrame], DataFrame]


def _written(table: DataFrame) -> DataFrame:
    return stage(table, "ring")


def _entered(df: DataFrame) -> DataFrame:
    """Rejected messages never enter a buffer and take up no room in it."""
    return df.where(F.col("drop_reason").isNull()) if "drop_reason" in df.columns else df


def _join(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys that may be null; the side's key columns are dropped."""
    side = side.withColumnsRenamed({key: f"__{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in keys]
    return df.join(side, same, how).drop(*[f"__{key}" for key in keys])


def oldest_kept(
    df: DataFrame, capacity: Column | int, keys: Sequence[str], hold: Hold = _written
) -> DataFrame:
    """Per full buffer: `oldest`, the smallest `seq` that is still inside.

    There is one row per full buffer and none for the others. Only the key
    columns are read: first as counts per bucket of `seq`, newest bucket first,
    which tell the one bucket where a buffer runs full; then the rows of that
    bucket, of which there are at most 2**14. No row outside it is shuffled.

    `hold` materialises a small intermediate table, so that Spark joins it by
    its true size: a small one is broadcast, a large one joined by sorting.
    """
    keys = list(keys)
    size = (capacity if isinstance(capacity, Column) else F.lit(capacity)).cast("bigint")
    newest_first = F.bitwise_not("seq")
    rows = _entered(df).select(
        *keys, "seq", size.alias("__size"), bucket_of(newest_first).alias("__slice")
    )
    slices = rows.groupBy(*keys, "__slice").agg(
        F.count(F.lit(1)).alias("__n"), F.max("__size").alias("__room")
    )
    counted = total_before(slices, keys, "__slice", "__n", "__before")
    before = F.coalesce("__before", F.lit(0))
    runs_full = (before < F.col("__room")) & (before + F.col("__n") >= F.col("__room"))
    left = F.col("__room") - before
    edges = hold(counted.where(runs_full).select(*keys, "__slice", left.alias("__left")))
    at_edge = _join(rows.drop("__size"), edges, [*keys, "__slice"], "inner")
    place = F.row_number().over(Window.partitionBy(*keys, "__slice").orderBy(F.col("seq").desc()))
    placed = at_edge.withColumn("__place", place)
    return placed.where(F.col("__place") == F.col("__left")).select(
        *keys, F.col("seq").alias("oldest")
    )


def mark_ring_overflow(
    df: DataFrame,
    capacity: Column | int,
    keys: Sequence[str],
    hold: Hold = _written,
) -> DataFrame:
    """Set `drop_reason` on admitted messages that newer ones pushed out.

    `keys` say what one buffer is. A flush empties it, so on a table they hold
    the flush cycle beside the client; a micro-batch is a cycle by itself.

    The limits are one row per full buffer. Small ones are broadcast, and no
    body is shuffled at all; large ones are joined by sorting, where AQE splits
    a client that is too hot.
    """
    limits = hold(oldest_kept(df, capacity, keys, hold))
    marked = _join(df, limits, keys, "left")
    pushed_out = F.when(F.col("seq") < F.col("oldest"), F.lit(C.RING_OVERFLOW))
    return add_reason(marked, pushed_out).drop("oldest")


def keep_newest(df: DataFrame, capacity: Column | int, keys: Sequence[str]) -> DataFrame:
    """Of each buffer the newest `capacity` messages."""
    marked = mark_ring_overflow(df, capacity, keys)
    return marked.where(F.col("drop_reason").isNull()).select(*df.columns)


def newest(df: DataFrame, n: int) -> DataFrame:
    """The newest `n` messages of a table that holds one client.

    The smallest `seq` to keep is found first and becomes a plain filter, so
    whole rows never meet in one task as they would in a sort with a limit.
    """
    oldest = oldest_kept(df, n, keys=()).select(F.min("oldest")).scalar()
    return _entered(df).where(F.col("seq") >= F.coalesce(oldest, F.col("seq")))
