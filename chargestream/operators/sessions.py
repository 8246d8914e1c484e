"""Connections of charge points: their ids, their identity, their events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import non_blank
from ..session import stage
from .admission import add_reason
from .chunks import with_side
from .ordering import bucket_of, total_before

# Messages of one charger are spread thinly over a client's sequence numbers,
# so a bucket spans more of them than the default.
_CHARGER_BUCKET_BITS = 20
# Connects of one bucket are looked up in stretches of this many.
_STRIDE = 1024
_KEYS = ("client_id", "charger_id")


def connection_id(client_id: Column, charger_id: Column, ordinal: Column) -> Column:
    """Id of a charger's n-th connection; null before the first connect.

    The lengths keep ids apart whose parts join to the same text.
    """
    name = F.concat_ws(
        ":",
        *[
            part
            for text in (client_id, charger_id)
            for part in (F.length(text).cast("string"), text)
        ],
        ordinal.cast("string"),
    )
    return F.when(ordinal > 0, F.sha2(name, 256))


def _connects(df: DataFrame) -> DataFrame:
    """Per charger and bucket of sequence numbers: where its connects are, and how many come in earlier buckets."""
    start = F.when(F.col("event_type") == C.CONNECT, F.col("seq"))
    narrow = df.select(*_KEYS, bucket_of(F.col("seq"), _CHARGER_BUCKET_BITS).alias("__bucket"), start.alias("__start"))
    starts = F.sort_array(F.collect_list("__start"))
    buckets = narrow.groupBy(*_KEYS, "__bucket").agg(F.count("__start").alias("__n"), starts.alias("__starts"))
    placed = total_before(buckets, _KEYS, "__bucket", "__n", "__before", _CHARGER_BUCKET_BITS)
    heads = F.transform(F.sequence(F.lit(0), F.expr(f"(__n - 1) div {_STRIDE}").cast("int")), lambda at: F.get("__starts", at * _STRIDE))
    return placed.withColumn("__heads", F.when(F.col("__n") > 0, heads))


def _up_to(seq: Column) -> Column:
    """Connects of the bucket up to this place: those before its stretch of _STRIDE, then those of the stretch."""
    reached = F.size(F.filter("__heads", lambda head: head <= seq))
    stretch = F.slice("__starts", (reached - 1) * _STRIDE + 1, F.lit(_STRIDE))
    inside = (reached - 1) * _STRIDE + F.size(F.filter(stretch, lambda start: start <= seq))
    return F.when(F.col("__heads").isNull() | (reached <= 0), F.lit(0)).otherwise(inside)


def with_connection_ordinal(df: DataFrame) -> DataFrame:
    """Add `ordinal`: how many connects the charger has had up to this event.

    A disconnect does not end a connection; only the next connect does. All
    connects count, also those that are rejected later. Only connects are
    numbered. An event then looks up its charger's connects in its bucket, so
    whole rows are neither sorted nor put into a window, and stay where they are
    if that table is small.
    """
    ranged = df.withColumn("__bucket", bucket_of(F.col("seq"), _CHARGER_BUCKET_BITS))
    joined = with_side(ranged, stage(_connects(df), "connects"), [*_KEYS, "__bucket"], "left")
    ordinal = F.coalesce("__before", F.lit(0)) + _up_to(F.col("seq"))
    return joined.select(*df.columns, ordinal.cast("bigint").alias("ordinal"))


def with_connection_id(df: DataFrame) -> DataFrame:
    """Turn `ordinal` into `connection_id`."""
    parts = (F.col("client_id"), F.col("charger_id"), F.col("ordinal"))
    return df.withColumn("connection_id", connection_id(*parts))


def assign_connections(df: DataFrame) -> DataFrame:
    """Give every event of a table the id of its connection.

    Events without a charger get none; admission rejects them whatever their id.
    """
    numbered = df.transform(with_connection_ordinal).transform(with_connection_id).drop("ordinal")
    return numbered.withColumn("connection_id", F.when(non_blank(F.col("charger_id")), F.col("connection_id")))


def with_identity(frames: DataFrame, connections: DataFrame) -> DataFrame:
    """Frames of a session carry neither charger nor tenant; its connection supplies them.

    No hint: Spark broadcasts the connections when their table is small, and
    otherwise sorts, where AQE splits a connection that is too hot. For both,
    `connections` has to be a table, or one that `stage` has written. A frame
    of a connection that is not there stays, with that as its drop reason.
    """
    known = connections.withColumn("__known", F.lit(True))
    joined = frames.join(known, "connection_id", "left")
    unknown = F.when(F.col("__known").isNull(), F.lit(C.UNKNOWN_CONNECTION))
    return add_reason(joined, unknown).drop("__known")


def session_events(
    frames: DataFrame,
    connections: DataFrame,
    identify: Callable[[DataFrame, DataFrame], DataFrame] = with_identity,
) -> DataFrame:
    """Each connection's connect, its frames and its disconnect.

    `phase` and `seq` give the order within a connection. On streams, `identify`
    is that of `streaming.sessions`.
    """
    identity = [name for name in connections.columns if name not in ("connection_id", "captured_ts")]
    no_seq = F.lit(None).cast("bigint").alias("seq")

    def lifecycle(event_type: int, phase: int) -> DataFrame:
        return connections.select(
            "connection_id",
            F.lit(phase).alias("phase"),
            no_seq,
            F.lit(event_type).alias("event_type"),
            *identity,
            F.lit(None).cast("string").alias("direction"),
            F.lit(None).cast("binary").alias("payload"),
            F.lit(None).cast("string").alias("drop_reason"),
        )

    messages = identify(frames, connections).select(
        "connection_id",
        F.lit(1).alias("phase"),
        "seq",
        F.lit(C.MESSAGE).alias("event_type"),
        *identity,
        "direction",
        F.col("payload").cast("binary").alias("payload"),
        "drop_reason",
    )
    return lifecycle(C.CONNECT, 0).unionByName(messages).unionByName(lifecycle(C.DISCONNECT, 2))
