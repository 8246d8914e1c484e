"""Validation of captured messages.

Admission never removes a row. It adds `drop_reason` (null = admitted), and
`split` routes the two kinds. A reason that is already there is kept, so steps
can be chained in the order of the contract.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import body_size, encode_frame, non_blank


def tenant_pair(tenant_id: str = "tenant_id", tenant_name: str = "tenant_name") -> Column:
    """Both tenant fields are given, or neither is."""
    return non_blank(F.col(tenant_id)) == non_blank(F.col(tenant_name))


def roaming_identity() -> Column:
    """Identity of an OCPI message: platform id and name, and a whole tenant pair."""
    return non_blank(F.col("platform_id")) & non_blank(F.col("platform_name")) & tenant_pair()


def charger_identity() -> Column:
    """Identity of an OCPP event: charger id and a whole tenant pair."""
    return non_blank(F.col("charger_id")) & tenant_pair()


def within_cap(body: str, cap: Column | int) -> Column:
    """The body has at most `cap` bytes; a missing body is empty."""
    return body_size(F.col(body)) <= (cap if isinstance(cap, Column) else F.lit(cap))


def complete() -> Column:
    """A frame needs bytes (they may be empty) and a direction; any event needs a known kind."""
    frame = F.col("payload").isNotNull() & F.col("direction").isNotNull()
    kind = F.col("event_type")
    return F.coalesce(kind.isin(C.DISCONNECT, C.CONNECT) | ((kind == C.MESSAGE) & frame), F.lit(False))


def add_reason(df: DataFrame, reason: Column) -> DataFrame:
    """Set `drop_reason` on rows that have none yet."""
    if "drop_reason" in df.columns:
        reason = F.coalesce(F.col("drop_reason"), reason)
    return df.withColumn("drop_reason", reason.cast("string"))


def admit_ocpi(df: DataFrame, cap: Column | int = C.DEFAULT_MAX_CAPTURE_BYTES) -> DataFrame:
    """Identity first, then the size of the request body, then of the response body."""
    return add_reason(
        df,
        F.when(~roaming_identity(), F.lit(C.INVALID_IDENTITY))
        .when(~within_cap("request_body", cap), F.lit(C.REQUEST_BODY_OVERSIZE))
        .when(~within_cap("response_body", cap), F.lit(C.RESPONSE_BODY_OVERSIZE)),
    )


def admit_ocpp(df: DataFrame, cap: Column | int = C.DEFAULT_MAX_CAPTURE_BYTES) -> DataFrame:
    """Frames: completeness, identity, size. Connects and disconnects: identity only."""
    is_frame = F.col("event_type") == C.MESSAGE
    return add_reason(
        df,
        F.when(~complete(), F.lit(C.INCOMPLETE_FRAME))
        .when(~charger_identity(), F.lit(C.INVALID_IDENTITY))
        .when(is_frame & ~within_cap("payload", cap), F.lit(C.FRAME_OVERSIZE)),
    )


def withhold(df: DataFrame, *columns: str) -> DataFrame:
    """Empty the given columns of rejected rows, which redaction may not have reached."""
    passed = F.col("drop_reason").isNull()
    return df.withColumns({name: F.when(passed, F.col(name)) for name in columns})


def admitted(df: DataFrame) -> DataFrame:
    return df.where(F.col("drop_reason").isNull()).drop("drop_reason")


def rejected(df: DataFrame, protocol: str) -> DataFrame:
    """The quarantine table: which message was dropped, and why."""
    return df.where(F.col("drop_reason").isNotNull()).select(
        "client_id", "seq", F.lit(protocol).alias("protocol"), "drop_reason"
    )


def split(df: DataFrame, protocol: str) -> tuple[DataFrame, DataFrame]:
    """Admitted rows and the quarantine table of the same input."""
    return admitted(df), rejected(df, protocol)


def stamp_direction(inbound: DataFrame, outbound: DataFrame) -> DataFrame:
    """Inbound exchanges (partner to host) are IN, outbound ones OUT."""
    return inbound.withColumn("direction", F.lit(C.DIRECTION_IN)).unionByName(
        outbound.withColumn("direction", F.lit(C.DIRECTION_OUT))
    )


def stamp_received(df: DataFrame) -> DataFrame:
    """Give rows without a receive time the current one."""
    if "captured_ts" in df.columns:
        return df.withColumn("captured_ts", F.coalesce("captured_ts", F.current_timestamp()))
    return df.withColumn("captured_ts", F.current_timestamp())


def event_code(name: Column, codes: Mapping[str, int] = C.EVENT_CODES) -> Column:
    """Numeric code of an event name; null for a name that is not known."""
    known = [(name == event, code) for event, code in codes.items()]
    column = F.when(known[0][0], F.lit(known[0][1]))
    for is_event, code in known[1:]:
        column = column.when(is_event, F.lit(code))
    return column.cast("int")


def ocpp_events(df: DataFrame) -> DataFrame:
    """Project raw events: name to code, text frames to bytes.

    Connects and disconnects carry identity and connection only, so whatever
    direction or payload came with them is discarded.
    """
    if "event_name" in df.columns:
        df = df.withColumn("event_type", event_code(F.col("event_name"))).drop("event_name")
    is_frame = F.col("event_type") == C.MESSAGE
    return df.withColumns(
        {
            "direction": F.when(is_frame, F.col("direction")),
            "payload": F.when(is_frame, encode_frame(F.col("payload"))),
        }
    )
