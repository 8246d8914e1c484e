"""From captures to records, quarantine and batch bodies.

The same functions serve a table and one micro-batch of a stream.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.admission import admit_ocpi, admit_ocpp, admitted, ocpp_events, rejected, stamp_received, withhold
from ..operators.batching import batch_bodies
from ..operators.clients import with_config
from ..operators.cycles import with_exact_cycle
from ..operators.records import OCPI_FIELDS, OCPP_FIELDS, ocpi_records, ocpp_records
from ..operators.redaction import Redactor, ocpi_redactor, ocpp_redactor
from ..operators.ring import Hold, mark_ring_overflow

FIELDS = {C.OCPI: OCPI_FIELDS, C.OCPP: OCPP_FIELDS}
_OCPI_CONTENT = ("request_headers", "response_headers", "request_body", "response_body")


class Flushed(NamedTuple):
    records: DataFrame
    rejected: DataFrame


def prepare_ocpi(
    captures: DataFrame,
    cap: Column | int = C.DEFAULT_MAX_CAPTURE_BYTES,
    extra_headers: Iterable[str] | Column = (),
    redact: Redactor | None = None,
) -> DataFrame:
    """Stamp the receive time, validate, redact; rejected rows stay, with their reason and without their content."""
    redact = redact or ocpi_redactor(extra_headers)
    prepared = captures.transform(stamp_received).transform(admit_ocpi, cap).transform(redact)
    return prepared.transform(withhold, *_OCPI_CONTENT)


def prepare_ocpp(
    events: DataFrame,
    cap: Column | int = C.DEFAULT_MAX_CAPTURE_BYTES,
    redact: Redactor | None = None,
) -> DataFrame:
    """Project, stamp the receive time, validate, redact; rejected rows stay, with their reason and without their frame."""
    redact = redact or ocpp_redactor()
    prepared = events.transform(ocpp_events).transform(stamp_received).transform(admit_ocpp, cap).transform(redact)
    return prepared.transform(withhold, "payload")


def prepare_ocpi_per_client(captures: DataFrame, config: DataFrame) -> DataFrame:
    """As `prepare_ocpi`, with each client's own cap and header list; keeps `config`."""
    return captures.transform(with_config, config).transform(
        prepare_ocpi, F.col("config.max_capture_bytes"), F.col("config.allowed_headers")
    )


def prepare_ocpp_per_client(events: DataFrame, config: DataFrame) -> DataFrame:
    """As `prepare_ocpp`, with each client's own cap; keeps `config`."""
    return events.transform(with_config, config).transform(
        prepare_ocpp, F.col("config.max_capture_bytes")
    )


def flush_per_client(prepared: DataFrame, protocol: str, poll: float = C.POLL_INTERVAL) -> Flushed:
    """Cut the records of a table whose rows carry their client's `config`, in the flushes of its own interval.

    Records keep `cycle` and `compression`: `batches(records, protocol, ["client_id", "cycle"])` are what the clients send.
    """
    interval = F.col("config.flush_interval")
    flushed = admitted(prepared).transform(with_exact_cycle, interval, poll)
    to_records = ocpi_records if protocol == C.OCPI else ocpp_records
    return Flushed(to_records(flushed), rejected(prepared, protocol))


def flush(
    prepared: DataFrame,
    protocol: str,
    capacity: Column | int | None = None,
    keys: Sequence[str] | None = None,
    hold: Hold | None = None,
) -> Flushed:
    """Cut the records; with a `capacity`, bound each buffer first.

    A buffer is named by `keys`: client and flush cycle on a table, the client
    alone in a micro-batch, which is a cycle.

    `prepared` is read more than once. Hand in a table that `stage` has written,
    or a persisted micro-batch.
    """
    held = prepared
    if capacity is not None:
        if keys is None:
            raise ValueError("a capacity needs the keys of a buffer, such as client_id and cycle")
        options = {} if hold is None else {"hold": hold}
        held = mark_ring_overflow(held, capacity, keys, **options)
    to_records = ocpi_records if protocol == C.OCPI else ocpp_records
    return Flushed(to_records(admitted(held)), rejected(held, protocol))


def batches(
    records: DataFrame,
    protocol: str,
    keys: Sequence[str] = ("client_id",),
    size: int = C.BATCH_CAP,
    compression: Column | str | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Cut records into ordered batches, each written as one body (see `batch_bodies`).

    The codec is the one that is given, or else that of the records' clients.

    `records` is read twice: its keys to number the rows, then whole. Hand in a
    table that `stage` has written, or a persisted micro-batch.
    """
    if compression is None:
        compression = F.col("compression") if "compression" in records.columns else C.DEFAULT_COMPRESSION
    return batch_bodies(records, FIELDS[protocol], keys, size, max_bytes, compression)
