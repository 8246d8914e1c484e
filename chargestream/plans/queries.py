"""One query per operator, over whole test tables. Results hold scalars only:
header maps become sorted `name=value` text, bytes become base64 or a digest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from .. import schemas
from ..functions import body_size, is_credentials_url
from ..operators import admission, batching, clients, cycles, delivery, ordering, records, redaction, ring, sessions
from ..session import configure, scratch_path, stage
from ..sources import captures, sinks, testdata
from ..streaming import buffers as stream_buffers
from ..streaming import connections as stream_connections
from ..streaming import delivery as stream_delivery
from ..streaming import flush as stream_flush
from ..streaming import manifest
from ..streaming import sessions as stream_sessions
from . import flush

Query = Callable[[SparkSession, str], DataFrame]

# Caps small enough that the test bodies exceed them now and then.
OCPI_CAP = 27
OCPP_CAP = 32
DOCUMENT_CAP = 4096
RING_CAPACITY = 1000
CYCLE_CAPACITY = 2
HOUR, DAY = 3600, 86400
# Of flushes on size or interval: far apart, as the test events are.
EXACT_POLL, EXACT_CAP = 120, 4
BODY_BYTES = 6000
STREAM_CAPACITY = 50
# Seconds at which the made-up times of conversations begin.
EPOCH = 1_700_000_000

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def _header_text(headers: str) -> Column:
    entry = F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.sort_array(entry), ";")


def _with_header_text(df: DataFrame) -> DataFrame:
    names = ("request_headers", "response_headers")
    return df.withColumns({name: F.nullif(_header_text(name), F.lit("")) for name in names})


def _ocpi_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = testdata.ocpi_capture(spark, sf_dir).transform(admission.admit_ocpi).transform(admission.admitted)
    redacted = kept.transform(redaction.ocpi_redactor()).transform(admission.admitted)
    return redacted.transform(records.ocpi_records)


def _ocpp_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.ocpp_capture(spark, sf_dir).transform(admission.ocpp_events)


def _ocpp_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _ocpp_events(spark, sf_dir).transform(sessions.assign_connections)
    kept = events.transform(admission.admit_ocpp).transform(admission.admitted)
    return kept.transform(redaction.ocpp_redactor()).transform(records.ocpp_records)


def _session(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    known = stage(testdata.connections(spark, sf_dir), "connections")
    return testdata.session_frames(spark, sf_dir), known


def _epoch_second(ts: str) -> Column:
    return F.unix_seconds(ts)


# --- sources ---------------------------------------------------------------


@query
def ocpi_source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ocpi-capture")
    testdata.ocpi_capture(spark, sf_dir).write.parquet(path)
    return captures.read_ocpi(spark, path).select(
        "seq",
        "client_id",
        "url",
        "status_code",
        _header_text("request_headers").alias("request_headers"),
        F.base64("request_body").alias("request_body"),
    )


@query
def ocpp_source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ocpp-capture")
    _ocpp_events(spark, sf_dir).write.json(path)
    return captures.read_ocpp(spark, path, "json").select(
        "seq", "client_id", "event_type", "charger_id", "direction", F.col("payload").cast("string").alias("payload")
    )


@query
def received_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third event comes without a time; the others keep theirs."""
    absent = F.col("seq") % 3 == 0
    events = testdata.ocpp_capture(spark, sf_dir)
    events = events.withColumn("captured_ts", F.when(~absent, F.col("captured_ts")))
    stamped = events.transform(admission.stamp_received)
    given = F.when(~absent, F.unix_micros("captured_ts"))
    return stamped.select("seq", given.alias("given_us"), F.col("captured_ts").isNotNull().alias("stamped"))


@query
def unparseable_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain text, cut-off objects, lists and wrong types among captures, as they come from a topic."""
    docs, doc_id = testdata.table(spark, sf_dir, "documents"), F.col("doc_id").cast("string")
    case = F.col("doc_id") % 5
    value = (
        F.when(case == 0, F.col("text"))
        .when(case == 1, F.concat(F.lit('{"seq":'), doc_id))
        .when(case == 2, F.concat(F.lit("["), doc_id, F.lit("]")))
        .when(case == 3, F.concat(F.lit('{"seq":"x'), doc_id, F.lit('"}')))
        .otherwise(F.concat(F.lit('{"seq":'), doc_id, F.lit(',"client_id":"gw"}')))
    )
    place = (F.lit("captures").alias("topic"), F.expr("doc_id div 100").cast("int").alias("partition"), F.col("doc_id").alias("offset"))
    sound, lost = captures.split_messages(docs.select(*place, value.cast("binary").alias("value")), schemas.OCPP_CAPTURE)
    kept = sound.select(F.expr("seq div 100").alias("partition"), F.col("seq").alias("offset"), "seq")
    found = lost.select(F.col("partition").cast("bigint").alias("partition"), "offset", F.sha2("value", 256).alias("value_sha256"), "drop_reason")
    return found.unionByName(kept, allowMissingColumns=True)


# --- projections -------------------------------------------------------------


@query
def direction_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    exchanges = testdata.ocpi_capture(spark, sf_dir)
    inbound = exchanges.where(F.col("direction") == C.DIRECTION_IN).drop("direction")
    outbound = exchanges.where(F.col("direction") == C.DIRECTION_OUT).drop("direction")
    return admission.stamp_direction(inbound, outbound).select("seq", "client_id", "direction")


@query
def event_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ocpp_events(spark, sf_dir).select(
        "seq", "event_type", "direction", F.col("payload").cast("string").alias("payload")
    )


@query
def ocpi_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_header_text(_ocpi_records(spark, sf_dir))


@query
def ocpp_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ocpp_records(spark, sf_dir)


@query
def all_records_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = records.all_records(_ocpi_records(spark, sf_dir), _ocpp_records(spark, sf_dir))
    return both.select(
        "protocol", "client_id", "seq", "captured_at", "tenant_id", "direction", "url", "charger_id", "event_type"
    )


# --- validation ----------------------------------------------------------------


@query
def identity_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.ocpi_capture(spark, sf_dir).select(
        "seq",
        admission.non_blank(F.col("platform_id")).alias("has_platform_id"),
        admission.tenant_pair().alias("tenant_pair"),
        admission.roaming_identity().alias("valid"),
    )


@query
def charger_identity_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = testdata.ocpp_capture(spark, sf_dir)
    return events.select("seq", admission.charger_identity().alias("valid"))


@query
def ocpi_admit_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    exchanges = testdata.ocpi_capture(spark, sf_dir)
    return exchanges.transform(admission.admit_ocpi, OCPI_CAP).select("client_id", "seq", "drop_reason")


@query
def ocpp_admit_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _ocpp_events(spark, sf_dir)
    return events.transform(admission.admit_ocpp, OCPP_CAP).select("client_id", "seq", "drop_reason")


@query
def document_size_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    exchanges = testdata.document_capture(spark, sf_dir)
    return exchanges.transform(admission.admit_ocpi, DOCUMENT_CAP).select(
        "seq", body_size(F.col("request_body")).alias("body_bytes"), "drop_reason"
    )


@query
def rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ocpi = testdata.ocpi_capture(spark, sf_dir).transform(admission.admit_ocpi, OCPI_CAP)
    ocpp = _ocpp_events(spark, sf_dir).transform(admission.admit_ocpp, OCPP_CAP)
    return admission.rejected(ocpi, C.OCPI).unionByName(admission.rejected(ocpp, C.OCPP))


@query
def drop_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.dropped_messages(rejected_messages(spark, sf_dir))


# --- redaction -----------------------------------------------------------------


@query
def header_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = testdata.ocpi_capture(spark, sf_dir).transform(redaction.redact_headers)
    return _with_header_text(kept).select("seq", "request_headers", "response_headers")


@query
def header_allowlist_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    exchanges = testdata.ocpi_capture(spark, sf_dir)
    kept = exchanges.transform(redaction.redact_headers, ["X-Trace", None, "\tcookie", 7, ""])
    return _with_header_text(kept).select("seq", "request_headers", "response_headers")


@query
def credentials_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    exchanges = testdata.ocpi_capture(spark, sf_dir)
    return exchanges.where(is_credentials_url(F.col("url"))).select("seq", "url")


@query
def masked_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = testdata.ocpi_capture(spark, sf_dir).transform(redaction.mask_credentials)
    texts = [F.col(body).cast("string").alias(body) for body in ("request_body", "response_body")]
    return masked.select("seq", *texts, "drop_reason")


@query
def custom_redactor(spark: SparkSession, sf_dir: str) -> DataFrame:
    def without_authorization(df: DataFrame) -> DataFrame:
        kept = F.map_filter("request_headers", lambda name, _: F.lower(name) != "authorization")
        return df.withColumn("request_headers", kept)

    exchanges = testdata.ocpi_capture(spark, sf_dir)
    prepared = flush.prepare_ocpi(exchanges, redact=without_authorization)
    return _with_header_text(admission.admitted(prepared)).select("seq", "request_headers")


# --- buffers, chunks, batch bodies ---------------------------------------------


@query
def ring_keep_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = testdata.ocpp_capture(spark, sf_dir)
    return events.transform(ring.keep_newest, RING_CAPACITY, ["client_id"]).select("client_id", "seq", "event_name")


@query
def ring_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    exchanges = testdata.ocpi_capture(spark, sf_dir).transform(admission.admit_ocpi, OCPI_CAP)
    entered = stage(exchanges.select("client_id", "seq", "drop_reason"), "entered")
    marked = entered.transform(ring.mark_ring_overflow, RING_CAPACITY, ["client_id"])
    return marked.select("client_id", "seq", "drop_reason")


@query
def ring_per_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flush empties the buffers: of each client the newest of every hour stay."""
    keys = ["client_id", "cycle"]
    rows = testdata.ocpp_capture(spark, sf_dir).transform(batching.with_cycle, HOUR).select(*keys, "seq")
    kept = stage(rows, "cycles").transform(ring.keep_newest, CYCLE_CAPACITY, keys)
    return kept.withColumn("cycle", _epoch_second("cycle"))


@query
def ring_newest_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.newest(testdata.ocpp_capture(spark, sf_dir), RING_CAPACITY).select("client_id", "seq")


@query
def fifo_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = testdata.ocpp_capture(spark, sf_dir).select("client_id", "seq")
    return ordering.fifo(ordering.with_position(rows, ["client_id"]), "client_id")


@query
def chunk_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = testdata.ocpi_capture(spark, sf_dir).transform(admission.admit_ocpi).transform(admission.admitted)
    return batching.chunk_summary(batching.with_chunk(rows.select("client_id", "seq")))


@query
def flush_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["client_id", "cycle"]
    rows = testdata.ocpp_capture(spark, sf_dir).transform(batching.with_cycle, HOUR)
    chunks = rows.select(*keys, "seq").transform(batching.with_chunk, keys, 2)
    return batching.chunk_summary(chunks, keys).withColumn("cycle", _epoch_second("cycle"))


@query
def flush_cycles_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flushes of four messages, or an hour after the last one, seen every two minutes."""
    rows = testdata.ocpp_capture(spark, sf_dir).select("client_id", "seq", "captured_ts")
    keys = ["client_id", "cycle", "trigger"]
    found = rows.transform(cycles.with_exact_cycle, HOUR, EXACT_POLL, EXACT_CAP)
    return batching.chunk_summary(found, keys).withColumn("cycle", _epoch_second("cycle"))


@query
def envelope_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = flush.batches(stage(_ocpi_records(spark, sf_dir), "records"), C.OCPI)
    return bodies.withColumn("body", F.md5("body"))


@query
def ocpp_envelope_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = flush.batches(stage(_ocpp_records(spark, sf_dir), "records"), C.OCPP, compression="gzip")
    return bodies.withColumn("body", F.md5("body"))


@query
def chunk_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of at most a thousand messages and six thousand bytes."""
    sent = stage(_ocpp_records(spark, sf_dir), "records")
    bodies = flush.batches(sent, C.OCPP, max_bytes=BODY_BYTES)
    return bodies.select("client_id", "chunk", "n_messages", "first_seq", "last_seq", "body_bytes", F.md5("body").alias("body"))


@query
def content_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["client_id", "cycle"]
    day = F.to_timestamp("captured_at")
    rows = _ocpi_records(spark, sf_dir).withColumn("cycle", batching.flush_cycle(day, DAY))
    return flush.batches(stage(rows, "records"), C.OCPI, keys).select(
        "client_id", _epoch_second("cycle").alias("cycle"), "n_messages", "body_bytes", "route", "content_encoding"
    )


@query
def envelope_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = flush.batches(stage(_ocpi_records(spark, sf_dir), "records"), C.OCPI)
    decoded = batching.decode_ocpi(bodies.select("client_id", "body"))
    texts = {name: F.col(name).cast("string") for name in ("request_body", "response_body")}
    return _with_header_text(decoded).withColumns(texts)


@query
def routed_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "envelopes")
    sinks.write_envelopes(flush.batches(stage(_ocpp_records(spark, sf_dir), "records"), C.OCPP), path)
    sent = batching.decode_ocpp(sinks.read_envelopes(spark, path))
    return sent.drop("n_messages", "first_seq", "last_seq", "body_bytes")


@query
def envelope_decode_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies whose base64 is broken in every third record; the others decode."""
    docs = testdata.table(spark, sf_dir, "documents")
    sent = F.when(F.col("doc_id") % 3 == 0, F.lit("a")).otherwise(F.base64(F.col("text").cast("binary")))
    message = F.struct(F.col("doc_id").cast("string").alias("url"), sent.alias("request_body"))
    bodies = docs.select(F.to_json(F.struct(F.array(message).alias("messages"))).alias("body"))
    sound = batching.decode_ocpi(bodies).select("url", F.sha2("request_body", 256).alias("sha256"))
    faults = batching.decode_faults(bodies, C.OCPI).select("url", "drop_reason")
    return sound.unionByName(faults, allowMissingColumns=True)


@query
def record_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "records")
    both = records.all_records(_ocpi_records(spark, sf_dir), _ocpp_records(spark, sf_dir))
    sinks.write_records(both, path)
    return spark.read.parquet(path).select(
        "protocol", "client_id", "seq", "captured_at", "request_body", "raw_frame"
    )


# --- connections ---------------------------------------------------------------


@query
def session_identity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames, known = _session(spark, sf_dir)
    return sessions.with_identity(frames, known).select(
        "connection_id", "seq", "charger_id", "tenant_id", "tenant_name", "direction", "drop_reason"
    )


@query
def orphan_frames_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the connections is not known; their frames are rejected, none is lost."""
    frames, known = _session(spark, sf_dir)
    some = known.where(~F.col("connection_id").rlike("[05]$"))
    events = sessions.session_events(frames, some).transform(admission.admit_ocpp, DOCUMENT_CAP)
    return events.where("phase = 1").select("connection_id", "seq", "drop_reason")


@query
def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged_events(sessions.session_events(*_session(spark, sf_dir)))


def _judged_events(events: DataFrame) -> DataFrame:
    return events.transform(admission.admit_ocpp, DOCUMENT_CAP).select(
        "connection_id",
        "phase",
        "seq",
        "event_type",
        "charger_id",
        "direction",
        body_size(F.col("payload")).alias("payload_bytes"),
        "drop_reason",
    )


@query
def connection_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _ocpp_events(spark, sf_dir).drop("payload", "direction", "captured_ts")
    numbered = sessions.with_connection_id(sessions.with_connection_ordinal(events))
    return numbered.select("client_id", "charger_id", "seq", "event_type", "ordinal", "connection_id")


# --- delivery ------------------------------------------------------------------


@query
def delivery_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.delivery_outcomes(testdata.delivery_attempts(spark, sf_dir))


@query
def delivery_drop_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.dropped_batches(delivery_outcomes(spark, sf_dir))


# --- configuration -------------------------------------------------------------


@query
def client_config_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = clients.resolve_config(testdata.client_config(spark, sf_dir))
    return resolved.withColumn("allowed_headers", F.array_join("allowed_headers", ","))


@query
def config_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clients.config_warnings(testdata.client_config(spark, sf_dir))
    return found.withColumn("warnings", F.array_join("warnings", ","))


@query
def active_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clients.active_clients(testdata.client_config(spark, sf_dir))


@query
def inert_clients_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    exchanges, config = testdata.ocpi_capture(spark, sf_dir), testdata.client_config(spark, sf_dir)
    return clients.exclude_inert(exchanges, config).select("client_id", "seq", "url")


@query
def inert_clients_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    exchanges, config = testdata.ocpi_capture(spark, sf_dir), testdata.client_config(spark, sf_dir)
    return admission.rejected(clients.only_inert(exchanges, config), C.OCPI)


@query
def per_client_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    exchanges, config = testdata.ocpi_capture(spark, sf_dir), testdata.client_config(spark, sf_dir)
    prepared = stage(flush.prepare_ocpi_per_client(exchanges, config), "per-client")
    held = ring.mark_ring_overflow(prepared, F.col("config.buffer_capacity"), ["client_id"])
    kept = F.when(F.col("drop_reason").isNull(), F.nullif(_header_text("request_headers"), F.lit("")))
    return held.select("client_id", "seq", "drop_reason", kept.alias("request_headers"))


@query
def client_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every client sends at its own interval and with its own codec."""
    exchanges, config = testdata.ocpi_capture(spark, sf_dir), testdata.client_config(spark, sf_dir)
    prepared = stage(flush.prepare_ocpi_per_client(exchanges, config), "per-client")
    sent = stage(flush.flush_per_client(prepared, C.OCPI).records, "records")
    bodies = flush.batches(sent, C.OCPI, ["client_id", "cycle"])
    return bodies.select(
        "client_id", F.unix_micros("cycle").alias("cycle"), "chunk", "n_messages", "body_bytes", "content_encoding"
    )


# --- streams -------------------------------------------------------------------


@query
def stream_ocpp_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = testdata.ocpp_capture_stream(spark, sf_dir).transform(admission.ocpp_events)
    connected = events.transform(stream_connections.assign_connections)
    path = scratch_path(spark, "stream")
    stream_flush.start_flushing(connected, path, flush.prepare_ocpp, C.OCPP, interval=None).awaitTermination()
    return stream_flush.read_flushed(spark, path, protocol=C.OCPP).drop("flush", "date", "hour")


def _slices(df: DataFrame, parts: int) -> list[DataFrame]:
    """A table in parts of about equal size, the earlier first."""
    shares = [part / parts for part in range(1, parts)]
    (cuts,) = df.agg(F.percentile_approx(F.unix_micros("captured_ts"), shares, 10_000)).first()
    at = F.unix_micros("captured_ts")
    part = sum(((at > cut).cast("int") for cut in sorted(set(cuts or ()))), F.lit(0))
    return [df.where(part == number) for number in range(parts)]


def _arriving(parts: list[DataFrame], path: str) -> DataFrame:
    """A stream of micro-batches, one for each part, in their order."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    reader = parts[0].sparkSession.readStream.schema(parts[0].schema)
    return reader.option("maxFilesPerTrigger", "1").option("latestFirst", "false").parquet(path)


def _drained(stream: DataFrame, path: str) -> DataFrame:
    writer = stream.writeStream.option("checkpointLocation", f"{path}/progress")
    writer.trigger(availableNow=True).format("parquet").start(f"{path}/out").awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


@query
def stream_size_or_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flushes of `flush_cycles_exact` from six micro-batches; what the stream's clock has not reached still waits."""
    rows = testdata.ocpp_capture(spark, sf_dir).select("client_id", "seq", "captured_ts")
    path = scratch_path(spark, "buffers")
    arriving = _arriving(_slices(rows, 6), f"{path}/in")
    found = stream_buffers.buffered(arriving, HOUR, EXACT_POLL, EXACT_CAP, clock=stream_buffers.CAPTURE)
    chunks = batching.chunk_summary(_drained(found, path), ["client_id", "cycle", "trigger"])
    return chunks.withColumn("cycle", _epoch_second("cycle"))


@query
def stream_connection_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight micro-batches that come out of order; connects renumber what was sent before them."""
    events = _ocpp_events(spark, sf_dir).where(admission.non_blank(F.col("charger_id"))).drop("payload", "direction")
    parts = _slices(events, 8)
    path = scratch_path(spark, "ordinals")
    arriving = _arriving([parts[at] for at in (3, 0, 6, 1, 7, 2, 5, 4)], f"{path}/in")
    sent = stream_connections.revised_ordinals(arriving, keep=1 << 62)
    return stream_connections.settled(_drained(sent, path))


@query
def stream_session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames and connects as two streams, four micro-batches each; a fifth of the connections never shows up."""
    frames, known = _session(spark, sf_dir)
    begin = F.regexp_extract("connection_id", "([0-9]+)$", 1).cast("bigint") * 1000
    # A stream's clock begins at the epoch, so its messages are later than that.
    timed = frames.withColumn("captured_ts", F.timestamp_seconds(F.col("seq") + EPOCH))
    connects = known.where(~F.col("connection_id").rlike("[05]$")).withColumn("captured_ts", F.timestamp_seconds(begin + EPOCH))
    path = scratch_path(spark, "sessions")
    streams = []
    for name, table in (("frames", timed), ("connects", connects)):
        # A last row of a later time moves the watermark past the others; it is still waiting when the stream ends.
        latest = table.agg(F.max("captured_ts").alias("captured_ts")).withColumn("captured_ts", F.expr("captured_ts + interval 30 days"))
        closing = table.limit(0).unionByName(latest, allowMissingColumns=True)
        streams.append(_arriving([*_slices(table, 4), closing], f"{path}/{name}"))
    events = _judged_events(sessions.session_events(*streams, stream_sessions.with_identity))
    return _drained(events, path).where(F.col("connection_id").isNotNull())


@query
def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five flushes, of which the first three become one set of files by date and hour."""
    path = scratch_path(spark, "compacted")
    events = _ocpp_events(spark, sf_dir).withColumn("connection_id", F.lit(None).cast("string"))
    arriving = _arriving(_slices(events, 5), f"{path}/in")
    stream_flush.start_flushing(arriving, f"{path}/out", flush.prepare_ocpp, C.OCPP, interval=None).awaitTermination()
    manifest.compact(spark, f"{path}/out", upto=2)
    manifest.vacuum(spark, f"{path}/out")
    kept = stream_flush.read_flushed(spark, f"{path}/out", protocol=C.OCPP)
    return kept.select("client_id", "seq", "protocol", "date", "hour", "captured_at", "raw_frame")


@query
def stream_ring_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five micro-batches of up to seven days; each client's buffer holds fifty messages."""
    path = scratch_path(spark, "ring")
    events = _ocpp_events(spark, sf_dir).withColumn("connection_id", F.lit(None).cast("string"))
    week = F.expr("day(captured_ts) div 7")
    arriving = _arriving([events.where(week == number) for number in range(5)], f"{path}/in")
    options = {"interval": None, "capacity": STREAM_CAPACITY}
    stream_flush.start_flushing(arriving, f"{path}/out", flush.prepare_ocpp, C.OCPP, **options).awaitTermination()
    kept = stream_flush.read_flushed(spark, f"{path}/out", protocol=C.OCPP).select("client_id", "seq")
    lost = stream_flush.read_flushed(spark, f"{path}/out", manifest.REJECTED).select("client_id", "seq", "drop_reason")
    return lost.unionByName(kept, allowMissingColumns=True)


@query
def stream_delivery_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First attempts, then second ones, and so on; late ones come last."""
    attempts = testdata.delivery_attempts(spark, sf_dir)
    turn = F.least(F.col("attempt"), F.lit(C.MAX_ATTEMPTS - 1))
    path = scratch_path(spark, "attempts")
    arriving = _arriving([attempts.where(turn == number) for number in range(C.MAX_ATTEMPTS)], f"{path}/in")
    return _drained(stream_delivery.delivery_outcomes(arriving, forget=None), path)


@query
def stream_close_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that is closed while it has work: each message is flushed, or in a file that is left."""
    path = scratch_path(spark, "closed")
    events = _ocpp_events(spark, sf_dir).withColumn("connection_id", F.lit(None).cast("string"))
    arriving = _arriving(_slices(events, 6), f"{path}/in")
    running = stream_flush.start_flushing(arriving, f"{path}/out", flush.prepare_ocpp, C.OCPP, interval=0.1)
    stream_flush.close(running, deadline=4.0)
    flushed = [stream_flush.read_flushed(spark, f"{path}/out", what, C.OCPP) for what in (manifest.RECORDS, manifest.REJECTED)]
    left = stream_flush.unread(spark, f"{path}/out", f"{path}/in")
    parts = [part.select("client_id", "seq") for part in flushed]
    if left:
        parts.append(spark.read.schema(arriving.schema).parquet(*left).select("client_id", "seq"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole
