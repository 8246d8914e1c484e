"""Frames of a stream get charger and tenant from the stream of connects.

Both sides wait in state: a frame for a connect that may still come, a connect
for the frames of its session. `captured_ts` says when either can be let go:
frames when the watermark has passed `wait` beyond them, connects when it has
passed `session`, the longest a session may last. A frame that finds no connect
by then goes on without, as `unknown_connection`, so none is lost inside the
watermark; what comes later than `wait` is dropped by Spark, which counts it.

A connection with most of the frames is dealt to `spread` state partitions: its
frames by their place, its connect to all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.admission import add_reason

WAIT, SESSION = "10 minutes", "1 day"
SPREAD = 8


def with_identity(
    frames: DataFrame, connects: DataFrame, wait: str = WAIT, session: str = SESSION, spread: int = SPREAD
) -> DataFrame:
    """Frames (connection_id, seq, captured_ts, ...) with the columns of their connect.

    A frame belongs to a connect at most `session` before and `wait` after it.
    `connects` has one row per connection.
    """
    part = F.pmod(F.xxhash64("connection_id", "seq"), F.lit(spread))
    left = frames.withWatermark("captured_ts", wait).withColumn("__part", part)
    others = [F.col(name) for name in connects.columns if name not in ("connection_id", "captured_ts")]
    right = connects.withWatermark("captured_ts", wait).select(
        F.col("connection_id").alias("__connection"),
        F.col("captured_ts").alias("__connected"),
        *others,
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))).alias("__place"),
    )
    begun = F.expr(f"__connected >= captured_ts - interval {session} and __connected <= captured_ts + interval {wait}")
    joined = left.join(right, (F.col("connection_id") == F.col("__connection")) & (F.col("__part") == F.col("__place")) & begun, "left")
    unknown = F.when(F.col("__connection").isNull(), F.lit(C.UNKNOWN_CONNECTION))
    return add_reason(joined, unknown).drop("__part", "__place", "__connection", "__connected")
