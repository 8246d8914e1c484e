"""Order-dependent totals that stay balanced when one key holds most rows.

A plain `sum(...).over(partitionBy(key).orderBy(seq))` sends a whole key to one
task. Here the order column is cut into buckets of 2**bucket_bits values. Each
bucket is summed on narrow, pre-aggregated rows, the bucket sums are summed in
the same way, and every bucket then starts from the total of the buckets before
it. A window never sees more than

* 2**bucket_bits rows of the input, provided `order` is unique within a key, and
* 2**ceil((64 - bucket_bits) / 2) narrow bucket sums,

whatever the distribution of keys. The start value travels as an extra row at
the head of its bucket, so no join is needed, null keys are safe, and the wide
rows are shuffled once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

BUCKET_BITS = 14

_BUCKET, _BLOCK, _VALUE, _IS_ROW, _ORDER = "__bucket", "__block", "__value", "__is_row", "__order"


def bucket_of(order: Column, bucket_bits: int = BUCKET_BITS) -> Column:
    """The bucket a value of the order column falls into."""
    return F.shiftright(order, bucket_bits)


def _before(keys: Sequence[str], *order: str) -> WindowSpec:
    rows = Window.partitionBy(*keys).orderBy(*order)
    return rows.rowsBetween(Window.unboundedPreceding, -1)


def _with_starts(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """Put the start values beside the rows; `__is_row` sorts them to the head."""
    return rows.withColumn(_IS_ROW, F.lit(True)).unionByName(
        starts.withColumn(_IS_ROW, F.lit(False)), allowMissingColumns=True
    )


def total_before(
    buckets: DataFrame,
    keys: Sequence[str],
    bucket: str,
    value: str,
    out: str,
    bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """Add `out`: the sum of `value` over all earlier buckets of the same keys.

    `buckets` has one row per key and bucket.
    """
    keys = list(keys)
    spread = buckets.withColumn(_BLOCK, F.shiftright(bucket, math.ceil((64 - bucket_bits) / 2)))
    blocks = spread.groupBy(*keys, _BLOCK).agg(F.sum(value).alias(value))
    before_block = F.sum(value).over(_before(keys, _BLOCK))
    starts = blocks.withColumn(value, F.coalesce(before_block, F.lit(0)))
    before_bucket = F.sum(value).over(_before([*keys, _BLOCK], _IS_ROW, bucket))
    return (
        _with_starts(spread, starts)
        .withColumn(out, before_bucket)
        .where(_IS_ROW)
        .select(*buckets.columns, out)
    )


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    out: str,
    order: Column | None = None,
    bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """Add `out`: the sum of `value` over the rows of the same keys up to and including this one.

    `order` (default: `seq`) is a BIGINT, unique within the keys. `bucket_bits`
    bounds the rows one window task sorts; a larger value suits keys whose rows
    are spread thinly over the order column.
    """
    keys = list(keys)
    order = F.col("seq") if order is None else order
    rows = df.withColumns(
        {_ORDER: order, _BUCKET: bucket_of(order, bucket_bits), _VALUE: value.cast("bigint")}
    )
    sums = rows.groupBy(*keys, _BUCKET).agg(F.sum(_VALUE).alias(_VALUE))
    starts = total_before(sums, keys, _BUCKET, _VALUE, "__start", bucket_bits)
    starts = starts.select(*keys, _BUCKET, F.col("__start").alias(_VALUE))
    upto = (
        Window.partitionBy(*keys, _BUCKET)
        .orderBy(_IS_ROW, _ORDER)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        _with_starts(rows, starts)
        .withColumn(out, F.sum(_VALUE).over(upto))
        .where(_IS_ROW)
        .select(*df.columns, out)
    )


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    out: str = "position",
    order: Column | None = None,
    bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """Add `out`: 0 for the first row of its keys, 1 for the next, and so on."""
    ranked = running_total(df, keys, F.lit(1), out, order, bucket_bits)
    return ranked.withColumn(out, F.col(out) - 1)


def fifo(df: DataFrame, *keys: str) -> DataFrame:
    """Oldest to newest inside every partition; no global sort."""
    return df.sortWithinPartitions(*keys, "seq")
