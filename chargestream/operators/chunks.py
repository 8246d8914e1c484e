"""Cutting a key's messages into batches by number and by bytes, and what whole rows need to find theirs.

A batch ends before the message that would make it too many or too large, so
where it ends depends on where it began, and so on back to the first. The cuts
are found in parallel on narrow rows (keys, `seq`, bytes):

1. Messages are dealt to buckets of `_ROWS` positions, each seeing the next
   messages behind its end as far as one batch can reach.
2. For every message the end of the batch that would begin there is one lookup
   in the bucket's running total of bytes. From these the bucket's map follows:
   for every place where a batch may begin first, where the first batch behind
   the bucket begins, and how many begin inside.
3. The maps of a key are applied one after the other (a narrow row per bucket).
4. Each bucket numbers its messages' batches from its real entry.

Whole rows are then placed by a table with one row per key and range of `seq`:
the places where batches begin there. It is joined like any side table, and is
broadcast if small.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .ordering import bucket_of, with_position

# Positions of one bucket; no batch may have more messages.
_ROWS = 1 << 14


def _cuts(size: np.ndarray, most: int, max_bytes: int) -> np.ndarray:
    """For each message, the first one behind the batch that begins with it."""
    total = np.concatenate([[0], np.cumsum(size)])
    begin = np.arange(len(size))
    reached = np.searchsorted(total, total[:-1] + max_bytes, side="right") - 1
    return np.clip(reached, begin + 1, begin + most)


def _exits(cuts: list[int], n: int, most: int) -> tuple[list[int], list[int]]:
    """For each of the first `most` of n messages: how far behind them the first batch begins, and how many begin among them."""
    beyond, count = [0] * n, [0] * n
    for at in range(n - 1, -1, -1):
        cut = cuts[at]
        if cut >= n:
            beyond[at], count[at] = cut - n, 1
        else:
            beyond[at], count[at] = beyond[cut], count[cut] + 1
    return beyond[:most], count[:most]


def _own(rows: pa.Table) -> tuple[pa.Table, int]:
    """Rows in order, and how many are the bucket's own."""
    ordered = rows.sort_by("__at")
    return ordered, int(np.count_nonzero(ordered.column("__own").to_numpy(zero_copy_only=False)))


def _fields(df: DataFrame, names: Sequence[str]) -> str:
    return "".join(f"`{name}` {df.schema[name].dataType.simpleString()}, " for name in names)


def bytes_chunks(narrow: DataFrame, keys: Sequence[str], size: int, max_bytes: int) -> DataFrame:
    """`chunk` of every row of `narrow` (keys, seq, __bytes): at most `size` rows and `max_bytes`, or a single larger one."""
    keys = list(keys)
    if not 1 <= size <= _ROWS:
        raise ValueError(f"a batch has 1 to {_ROWS} messages")
    placed = with_position(narrow, keys, "__at")
    bucket, inside = F.expr(f"__at div {_ROWS}"), F.col("__at") % _ROWS
    own = F.struct(bucket.alias("bucket"), F.lit(True).alias("own"))
    behind = F.when((inside < size) & (bucket > 0), F.struct((bucket - 1).alias("bucket"), F.lit(False).alias("own")))
    spread = placed.withColumn("__in", F.explode(F.array_compact(F.array(own, behind))))
    spread = spread.select(*keys, "seq", "__bytes", "__at", F.col("__in.bucket").alias("__bucket"), F.col("__in.own").alias("__own"))
    buckets = stage(spread, "chunk-rows")
    group = [*keys, "__bucket"]

    def exits(rows: pa.Table) -> pa.Table:
        rows, n = _own(rows)
        beyond, count = _exits(_cuts(rows.column("__bytes").to_numpy(), size, max_bytes).tolist(), n, size)
        names = {name: rows.column(name)[:1] for name in group}
        return pa.table({**names, "__beyond": pa.array([beyond], pa.list_(pa.int32())), "__count": pa.array([count], pa.list_(pa.int32()))})

    def entries(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("__bucket")
        at, chunk, out = 0, 0, []
        for beyond, count in zip(rows.column("__beyond").to_pylist(), rows.column("__count").to_pylist(), strict=True):
            out.append((at, chunk))
            # A last bucket may end within the batch that an earlier one began.
            if at < len(beyond):
                at, chunk = beyond[at], chunk + count[at]
        first, chunks = zip(*out, strict=True)
        return rows.select(group).append_column("__first", pa.array(first, pa.int64())).append_column("__chunk", pa.array(chunks, pa.int64()))

    def numbered(rows: pa.Table) -> pa.Table:
        rows, n = _own(rows)
        cuts = _cuts(rows.column("__bytes").to_numpy(), size, max_bytes)
        begins = np.zeros(n, np.int64)
        at = rows.column("__first")[0].as_py()
        while at < n:
            begins[at] = 1
            at = int(cuts[at])
        chunk = rows.column("__chunk")[0].as_py() - 1 + np.cumsum(begins)
        return rows.slice(0, n).select([*keys, "seq"]).append_column("chunk", pa.array(chunk))

    fields = _fields(narrow, keys)
    maps = buckets.groupBy(*group).applyInArrow(exits, f"{fields}__bucket long, __beyond array<int>, __count array<int>")
    entered = stage(maps, "chunk-maps").groupBy(*keys).applyInArrow(entries, f"{fields}__bucket long, __first long, __chunk long")
    played = with_side(buckets, stage(entered, "chunk-entries"), group)
    return played.groupBy(*group).applyInArrow(numbered, f"{fields}seq long, chunk long")


def count_chunks(narrow: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """`chunk` of every row of `narrow` (keys, seq): slices of `size` rows."""
    placed = with_position(narrow, keys, "__at")
    return placed.select(*keys, "seq", F.expr(f"__at div {int(size)}").alias("chunk"))


# --- whole rows ------------------------------------------------------------------------


def fits_broadcast(side: DataFrame) -> bool:
    """Whether Spark will broadcast a staged table, whose size it knows from its files."""
    size = int(str(side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= side.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def with_side(rows: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a staged side table by keys that may be null. If it is too large to broadcast, its partitions are hashed:
    wide rows are dealt out once and never sorted."""
    found = side if fits_broadcast(side) else side.hint("shuffle_hash")
    renamed = found.select(*[F.col(name).alias(f"__side_{name}") if name in keys else F.col(name) for name in found.columns])
    same = F.lit(True)
    for name in keys:
        same = same & F.col(name).eqNullSafe(F.col(f"__side_{name}"))
    return rows.join(renamed, same, how).drop(*[f"__side_{name}" for name in keys])


def starts(chunked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key and range of `seq`: `__starts`, where a batch's messages begin there, its number, and whether all are there."""
    keys = list(keys)
    ranges = chunked.withColumn("__range", bucket_of(F.col("seq")))
    pieces = ranges.groupBy(*keys, "__range", "chunk").agg(F.min("seq").alias("start"))
    whole = F.count(F.lit(1)).over(Window.partitionBy(*keys, "chunk")) == 1
    one = F.struct("start", "chunk", "whole")
    return pieces.withColumn("whole", whole).groupBy(*keys, "__range").agg(F.sort_array(F.collect_list(one)).alias("__starts"))


def located(rows: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole rows with their `chunk`, `__whole` (it has no messages in other ranges) and `__range`."""
    ranged = rows.withColumn("__range", bucket_of(F.col("seq")))
    found = with_side(ranged, side, [*keys, "__range"])
    own: Column = F.element_at(F.filter("__starts", lambda one: one["start"] <= F.col("seq")), -1)
    named = found.withColumn("__own", own).withColumns({"chunk": F.col("__own.chunk"), "__whole": F.col("__own.whole")})
    return named.drop("__starts", "__own")
