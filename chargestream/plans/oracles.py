"""What DuckDB must find for each query of `queries.py`, from the same test tables."""

from __future__ import annotations

from ..sources import testdata
from .queries import BODY_BYTES, CYCLE_CAPACITY, DAY, DOCUMENT_CAP, EXACT_CAP, EXACT_POLL, HOUR, OCPI_CAP, OCPP_CAP, RING_CAPACITY, STREAM_CAPACITY

_NAMES = ("orders", "customer", "nation", "events", "conversations", "documents")


def _sql(template: str) -> str:
    return template.format(**{name: name for name in _NAMES}).strip()


def _filled(column: str) -> str:
    """The test data has ASCII blanks only, so `trim` is enough here."""
    return f"coalesce(trim({column}) <> '', false)"


def _header_text(entries: str) -> str:
    return f"nullif(array_to_string(list_sort(list_transform({entries}, lambda e: e.key || '=' || e.value)), ';'), '')"


# The header allowlist of the contract.
ALLOWED = """'ocpi-from-country-code','ocpi-from-party-id','ocpi-to-country-code','ocpi-to-party-id','content-type',
  'accept','user-agent','x-correlation-id','x-request-id','x-total-count','x-limit','link'"""

_TENANT_PAIR = f"({_filled('tenant_id')} = {_filled('tenant_name')})"
_ROAMING = f"({_filled('platform_id')} AND {_filled('platform_name')} AND {_TENANT_PAIR})"
_CHARGER = f"({_filled('charger_id')} AND {_TENANT_PAIR})"

_CTE = f"""WITH exchange AS ({_sql(testdata.OCPI_SQL)}),
ocpi AS (
  SELECT *,
    CASE WHEN seq % 9 = 0 THEN MAP([]::VARCHAR[], []::VARCHAR[])
         WHEN seq % 9 = 1 THEN MAP(['Cookie'], ['sid=' || seq])
         ELSE MAP(['Authorization', 'Content-Type', 'OCPI-from-party-id', 'X-Trace'],
                  ['Token ' || seq, 'application/json', client_id, seq::VARCHAR]) END AS request_headers,
    MAP(['X-Total-Count', 'Set-Cookie'], ['3', 'sid=' || seq]) AS response_headers,
    {_ROAMING} AS valid,
    regexp_matches(url, '(?i)/credentials/?(\\?|$)') AS credentials
  FROM exchange),
masked AS (
  SELECT *,
    CASE WHEN NOT credentials OR NOT coalesce(json_valid(request_body_text), false) THEN request_body_text
         WHEN json_type(request_body_text, '$.token') = 'VARCHAR' AND json_extract_string(request_body_text, '$.token') <> ''
         THEN '{{"token":"[redacted]","url":' || json_extract(request_body_text, '$.url') || '}}'
         ELSE request_body_text END AS request_masked,
    CASE WHEN NOT credentials OR NOT coalesce(json_valid(response_body_text), false) THEN response_body_text
         WHEN json_type(response_body_text, '$.data.token') = 'VARCHAR' AND json_extract_string(response_body_text, '$.data.token') <> ''
         THEN '{{"status_code":' || json_extract(response_body_text, '$.status_code') || ',"data":{{"token":"[redacted]"}}}}'
         ELSE response_body_text END AS response_masked
  FROM ocpi),
ocpi_record AS (
  SELECT client_id, seq, 'ocpi' AS protocol,
    strftime(captured_ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS captured_at,
    platform_id, platform_name, nullif(tenant_id, '') AS tenant_id, nullif(tenant_name, '') AS tenant_name,
    direction, method AS http_method, url, nullif(status_code, 0)::INTEGER AS response_status_code,
    list_filter(map_entries(request_headers), lambda e: lower(e.key) IN ({ALLOWED})) AS request_entries,
    to_base64(encode(nullif(request_masked, ''))) AS request_body,
    list_filter(map_entries(response_headers), lambda e: lower(e.key) IN ({ALLOWED})) AS response_entries,
    to_base64(encode(nullif(response_masked, ''))) AS response_body
  FROM masked WHERE valid),
raw_event AS ({_sql(testdata.OCPP_SQL)}),
ocpp AS (
  SELECT * EXCLUDE (direction, payload_text),
    CASE event_name WHEN 'CONNECT' THEN 1 WHEN 'MESSAGE' THEN 2 ELSE 0 END AS event_type,
    CASE WHEN event_name = 'MESSAGE' THEN direction END AS direction,
    CASE WHEN event_name = 'MESSAGE' THEN payload_text END AS payload_text,
    {_CHARGER} AS valid,
    (sum(CASE WHEN event_name = 'CONNECT' THEN 1 ELSE 0 END)
      OVER (PARTITION BY client_id, charger_id ORDER BY seq ROWS UNBOUNDED PRECEDING))::BIGINT AS ordinal
  FROM raw_event),
connected AS (
  SELECT *, CASE WHEN ordinal > 0 THEN sha256(length(client_id) || ':' || client_id || ':' || length(charger_id)
      || ':' || charger_id || ':' || ordinal) END AS connection_id
  FROM ocpp),
ocpp_record AS (
  SELECT client_id, seq, 'ocpp' AS protocol, charger_id, connection_id,
    nullif(tenant_id, '') AS tenant_id, nullif(tenant_name, '') AS tenant_name,
    strftime(captured_ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS captured_at, event_type, direction,
    to_base64(encode(nullif(payload_text, ''))) AS raw_frame
  FROM connected
  WHERE valid AND (event_type <> 2 OR (payload_text IS NOT NULL AND direction IS NOT NULL))),
ocpi_reason AS (
  SELECT client_id, seq, CASE WHEN NOT valid THEN 'invalid_identity'
    WHEN strlen(request_body_text) > {OCPI_CAP} THEN 'request_body_oversize'
    WHEN strlen(response_body_text) > {OCPI_CAP} THEN 'response_body_oversize' END AS drop_reason
  FROM ocpi),
ocpp_reason AS (
  SELECT client_id, seq,
    CASE WHEN event_type = 2 AND (payload_text IS NULL OR direction IS NULL) THEN 'incomplete_frame'
    WHEN NOT valid THEN 'invalid_identity'
    WHEN strlen(payload_text) > {OCPP_CAP} THEN 'frame_oversize' END AS drop_reason
  FROM ocpp),
rejected AS (
  SELECT client_id, seq, 'ocpi' AS protocol, drop_reason FROM ocpi_reason WHERE drop_reason IS NOT NULL
  UNION ALL
  SELECT client_id, seq, 'ocpp' AS protocol, drop_reason FROM ocpp_reason WHERE drop_reason IS NOT NULL),
frame AS ({_sql(testdata.FRAMES_SQL)}),
connection AS ({_sql(testdata.CONNECTIONS_SQL)}),
attempt AS ({_sql(testdata.ATTEMPTS_SQL)}),
attempt_step AS (
  SELECT *, coalesce(status, 0) AS code, coalesce(status IN (200, 400, 401, 413), false) AS decisive FROM attempt WHERE attempt < 5),
settled AS (
  SELECT batch_id, protocol, n_messages, (attempt + 1)::INTEGER AS attempts, code AS final_status, decisive
  FROM attempt_step
  QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY decisive DESC, CASE WHEN decisive THEN attempt ELSE -attempt END) = 1),
outcome AS (
  SELECT batch_id, protocol, n_messages, attempts, final_status,
    CASE WHEN decisive AND final_status = 200 THEN 'accepted' WHEN decisive THEN 'permanent'
         WHEN attempts >= 5 THEN 'exhausted' ELSE 'in_flight' END AS outcome,
    CASE WHEN decisive AND final_status = 200 THEN NULL
         WHEN decisive THEN 'permanent rejection: HTTP ' || final_status
         WHEN attempts >= 5 AND final_status <> 0 THEN 'retries exhausted (last HTTP ' || final_status || ')'
         WHEN attempts >= 5 THEN 'retries exhausted (network error / timeout)' END AS reason
  FROM settled),
config AS ({_sql(testdata.CONFIG_SQL)}),
resolved AS (
  SELECT client_id, debug,
    CASE WHEN regexp_matches(trim(endpoint), '^(?i:https?)://[^/?#]+') THEN rtrim(trim(endpoint), '/') END AS endpoint,
    has_api_key AND regexp_matches(trim(endpoint), '^(?i:https?)://[^/?#]+') AS active,
    CASE WHEN buffer_capacity >= 1 THEN buffer_capacity ELSE 10000 END AS buffer_capacity,
    CASE WHEN max_capture_bytes >= 1 THEN max_capture_bytes ELSE 65536 END AS max_capture_bytes,
    CASE WHEN flush_interval >= 0.001 THEN flush_interval ELSE 5.0 END::DOUBLE AS flush_interval,
    CASE WHEN drain_timeout >= 5.0 THEN drain_timeout ELSE 10.0 END::DOUBLE AS drain_timeout,
    CASE WHEN compression IN ('gzip', 'zstd') THEN compression ELSE 'zstd' END AS compression,
    coalesce(CASE WHEN allowed_headers_csv IS NULL THEN ''
      WHEN allowed_headers_csv = 'Cookie' THEN 'cookie' ELSE 'x-trace,x-request-id' END, '') AS allowed_headers
  FROM config)
"""

# JSON text of one record, fields in wire order.
_HEADER_JSON = "CASE WHEN len({0}) > 0 THEN to_json(map_from_entries({0})) END"
_OCPI_JSON = f"""json_object('captured_at', captured_at, 'platform_id', platform_id, 'platform_name', platform_name,
  'tenant_id', tenant_id, 'tenant_name', tenant_name, 'direction', direction, 'http_method', http_method, 'url', url,
  'response_status_code', response_status_code, 'request_headers', {_HEADER_JSON.format('request_entries')},
  'request_body', request_body, 'response_headers', {_HEADER_JSON.format('response_entries')},
  'response_body', response_body)"""
_OCPP_JSON = """json_object('charger_id', charger_id, 'connection_id', connection_id, 'tenant_id', tenant_id,
  'tenant_name', tenant_name, 'captured_at', captured_at, 'event_type', event_type, 'direction', direction,
  'raw_frame', raw_frame)"""


def _bodies(record: str, json: str, keys: str) -> str:
    return f"""SELECT protocol, {keys}, chunk, count(*)::INTEGER AS n_messages, min(seq) AS first_seq, max(seq) AS last_seq,
    '{{"messages":[' || string_agg(json, ',' ORDER BY seq) || ']}}' AS body
  FROM (SELECT *, ({json})::VARCHAR AS json,
          (row_number() OVER (PARTITION BY {keys} ORDER BY seq) - 1) // 1000 AS chunk FROM {record})
  GROUP BY protocol, {keys}, chunk"""


def _envelopes(record: str, json: str, codec: str) -> str:
    return f"""SELECT protocol, client_id, chunk, n_messages, first_seq, last_seq, md5(body) AS body,
    '/v1/' || protocol AS route, strlen(body)::INTEGER AS body_bytes,
    CASE WHEN strlen(body) < 1024 THEN 'identity' ELSE '{codec}' END AS content_encoding
  FROM ({_bodies(record, json, 'client_id')})"""


_OCPI_RECORD_COLUMNS = f"""captured_at, platform_id, platform_name, tenant_id, tenant_name, direction, http_method, url,
  response_status_code, {_header_text('request_entries')} AS request_headers, request_body,
  {_header_text('response_entries')} AS response_headers, response_body"""

_OCPP_FIELDS = "charger_id, connection_id, tenant_id, tenant_name, captured_at, event_type, direction"

_SELECTS = {
    "ocpi_source_scan": f"""SELECT seq, client_id, url, status_code,
        coalesce({_header_text('map_entries(request_headers)')}, '') AS request_headers,
        to_base64(encode(request_body_text)) AS request_body FROM ocpi""",
    "ocpp_source_scan": """SELECT seq, client_id, event_type, charger_id, direction, payload_text AS payload FROM ocpp""",
    "received_stamp": "SELECT event_id AS seq, CASE WHEN event_id % 3 <> 0 THEN epoch_us(ts) END AS given_us, true AS stamped FROM events",
    "direction_stamp": "SELECT seq, client_id, direction FROM exchange",
    "event_projection": "SELECT seq, event_type, direction, payload_text AS payload FROM ocpp",
    "ocpi_records": f"SELECT client_id, seq, protocol, {_OCPI_RECORD_COLUMNS} FROM ocpi_record",
    "ocpp_records": f"SELECT client_id, seq, protocol, {_OCPP_FIELDS}, raw_frame FROM ocpp_record",
    "all_records_union": """SELECT protocol, client_id, seq, captured_at, tenant_id, direction, url,
        NULL::VARCHAR AS charger_id, NULL::INTEGER AS event_type FROM ocpi_record
      UNION ALL SELECT protocol, client_id, seq, captured_at, tenant_id, direction, NULL, charger_id, event_type FROM ocpp_record""",
    "identity_checks": f"""SELECT seq, {_filled('platform_id')} AS has_platform_id, {_TENANT_PAIR} AS tenant_pair, valid FROM ocpi""",
    "charger_identity_checks": "SELECT seq, valid FROM ocpp",
    "ocpi_admit_reasons": "SELECT client_id, seq, drop_reason FROM ocpi_reason",
    "ocpp_admit_reasons": "SELECT client_id, seq, drop_reason FROM ocpp_reason",
    "document_size_cap": f"""SELECT doc_id AS seq, strlen(text)::INTEGER AS body_bytes,
        CASE WHEN strlen(text) > {DOCUMENT_CAP} THEN 'request_body_oversize' END AS drop_reason FROM documents""",
    "rejected_messages": "SELECT client_id, seq, protocol, drop_reason FROM rejected",
    "drop_accounting": "SELECT protocol, drop_reason, count(*) AS n_messages FROM rejected GROUP BY protocol, drop_reason",
    "header_allowlist": f"""SELECT seq,
        {_header_text(f"list_filter(map_entries(request_headers), lambda e: lower(e.key) IN ({ALLOWED}))")} AS request_headers,
        {_header_text(f"list_filter(map_entries(response_headers), lambda e: lower(e.key) IN ({ALLOWED}))")} AS response_headers
      FROM ocpi""",
    "header_allowlist_extended": f"""SELECT seq,
        {_header_text(f"list_filter(map_entries(request_headers), lambda e: lower(e.key) IN ({ALLOWED}, 'x-trace', 'cookie'))")} AS request_headers,
        {_header_text(f"list_filter(map_entries(response_headers), lambda e: lower(e.key) IN ({ALLOWED}, 'x-trace', 'cookie'))")} AS response_headers
      FROM ocpi""",
    "credentials_urls": "SELECT seq, url FROM ocpi WHERE credentials",
    "masked_tokens": """SELECT seq, request_masked AS request_body, response_masked AS response_body,
        NULL::VARCHAR AS drop_reason FROM masked""",
    "custom_redactor": f"""SELECT seq,
        {_header_text("list_filter(map_entries(request_headers), lambda e: lower(e.key) <> 'authorization')")} AS request_headers
      FROM ocpi WHERE valid""",
    "ring_keep_newest": f"""SELECT client_id, seq, event_name FROM raw_event
      QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY seq DESC) <= {RING_CAPACITY}""",
    "ring_per_cycle": f"""SELECT client_id, cycle, seq
      FROM (SELECT client_id, seq, epoch_us(captured_ts) // {HOUR}000000::BIGINT * {HOUR} AS cycle FROM raw_event)
      QUALIFY row_number() OVER (PARTITION BY client_id, cycle ORDER BY seq DESC) <= {CYCLE_CAPACITY}""",
    "ring_overflow": f"""SELECT client_id, seq, coalesce(drop_reason,
        CASE WHEN row_number() OVER (PARTITION BY client_id, drop_reason IS NULL ORDER BY seq DESC) > {RING_CAPACITY}
             THEN 'ring_overflow' END) AS drop_reason FROM ocpi_reason""",
    "ring_newest_global": f"SELECT client_id, seq FROM raw_event ORDER BY seq DESC LIMIT {RING_CAPACITY}",
    "fifo_positions": """SELECT client_id, seq, row_number() OVER (PARTITION BY client_id ORDER BY seq) - 1 AS position
      FROM raw_event""",
    "chunk_sizes": """SELECT client_id, chunk, count(*) AS n_messages, min(seq) AS first_seq, max(seq) AS last_seq
      FROM (SELECT client_id, seq, (row_number() OVER (PARTITION BY client_id ORDER BY seq) - 1) // 1000 AS chunk
            FROM ocpi WHERE valid) GROUP BY client_id, chunk""",
    "flush_cycles": f"""SELECT client_id, cycle, chunk, count(*) AS n_messages, min(seq) AS first_seq, max(seq) AS last_seq
      FROM (SELECT *, (row_number() OVER (PARTITION BY client_id, cycle ORDER BY seq) - 1) // 2 AS chunk
            FROM (SELECT client_id, seq, epoch_us(captured_ts) // {HOUR}000000::BIGINT * {HOUR} AS cycle FROM raw_event))
      GROUP BY client_id, cycle, chunk""",
    "envelope_summary": _envelopes("ocpi_record", _OCPI_JSON, "zstd"),
    "ocpp_envelope_summary": _envelopes("ocpp_record", _OCPP_JSON, "gzip"),
    "content_encoding": f"""SELECT client_id, cycle, n_messages, strlen(body)::INTEGER AS body_bytes, '/v1/ocpi' AS route,
        CASE WHEN strlen(body) < 1024 THEN 'identity' ELSE 'zstd' END AS content_encoding
      FROM ({_bodies(
          f"(SELECT *, epoch_us(captured_at::TIMESTAMP) // {DAY}000000::BIGINT * {DAY} AS cycle FROM ocpi_record)",
          _OCPI_JSON, 'client_id, cycle')})""",
    "envelope_roundtrip": f"""SELECT client_id, {_OCPI_RECORD_COLUMNS.replace(
        'request_body,', 'decode(from_base64(request_body)) AS request_body,').replace(
        ' response_body', ' decode(from_base64(response_body)) AS response_body')} FROM ocpi_record""",
    "routed_sink": f"""SELECT protocol, client_id, chunk, route, content_encoding, {_OCPP_FIELDS},
        decode(from_base64(raw_frame)) AS raw_frame
      FROM (SELECT *, (row_number() OVER (PARTITION BY client_id ORDER BY seq) - 1) // 1000 AS chunk FROM ocpp_record)
      JOIN (SELECT client_id, chunk, route, content_encoding FROM ({_envelopes("ocpp_record", _OCPP_JSON, "zstd")}))
        USING (client_id, chunk)""",
    "envelope_decode_faults": """SELECT doc_id::VARCHAR AS url, CASE WHEN doc_id % 3 <> 0 THEN sha256(text) END AS sha256,
        CASE WHEN doc_id % 3 = 0 THEN 'undecodable_body' END AS drop_reason FROM documents""",
    "record_sink": """SELECT protocol, client_id, seq, captured_at, request_body, NULL::VARCHAR AS raw_frame FROM ocpi_record
      UNION ALL SELECT protocol, client_id, seq, captured_at, NULL, raw_frame FROM ocpp_record""",
    "session_identity_join": """SELECT connection_id, seq, charger_id, tenant_id, tenant_name, direction,
        NULL::VARCHAR AS drop_reason FROM frame JOIN connection USING (connection_id)""",
    "orphan_frames_rejected": f"""SELECT connection_id, seq, CASE
          WHEN regexp_matches(connection_id, '[05]$') THEN 'unknown_connection'
          WHEN direction IS NULL THEN 'incomplete_frame'
          WHEN trim(charger_id) = '' THEN 'invalid_identity'
          WHEN strlen(payload_text) > {DOCUMENT_CAP} THEN 'frame_oversize' END AS drop_reason
      FROM frame JOIN connection USING (connection_id)""",
    "session_events": f"""SELECT *, CASE
          WHEN event_type = 2 AND direction IS NULL THEN 'incomplete_frame'
          WHEN trim(charger_id) = '' THEN 'invalid_identity'
          WHEN payload_bytes > {DOCUMENT_CAP} THEN 'frame_oversize' END AS drop_reason
      FROM (SELECT connection_id, 0 AS phase, NULL::BIGINT AS seq, 1 AS event_type, charger_id,
              NULL::VARCHAR AS direction, 0 AS payload_bytes FROM connection
            UNION ALL
            SELECT connection_id, 1, seq, 2, charger_id, direction, strlen(payload_text)::INTEGER
              FROM frame JOIN connection USING (connection_id)
            UNION ALL SELECT connection_id, 2, NULL, 0, charger_id, NULL, 0 FROM connection)""",
    "stream_ring_overflow": f"""SELECT client_id, seq, coalesce(drop_reason,
        CASE WHEN row_number() OVER (PARTITION BY client_id, day(captured_ts) // 7, drop_reason IS NULL ORDER BY seq DESC) > {STREAM_CAPACITY}
             THEN 'ring_overflow' END) AS drop_reason
      FROM (SELECT client_id, seq, captured_ts, CASE WHEN event_type = 2 AND (payload_text IS NULL OR direction IS NULL)
              THEN 'incomplete_frame' WHEN NOT valid THEN 'invalid_identity' END AS drop_reason FROM ocpp)""",
    "unparseable_captures": """SELECT doc_id // 100 AS partition, doc_id AS offset, CASE doc_id % 5
          WHEN 0 THEN sha256(text) WHEN 1 THEN sha256('{"seq":' || doc_id) WHEN 2 THEN sha256('[' || doc_id || ']')
          WHEN 3 THEN sha256('{"seq":"x' || doc_id || '"}') END AS value_sha256,
        CASE WHEN doc_id % 5 < 4 THEN 'unparseable' END AS drop_reason,
        CASE WHEN doc_id % 5 = 4 THEN doc_id END AS seq FROM documents""",
    "stream_delivery_outcomes": "SELECT * FROM outcome WHERE outcome <> 'in_flight'",
    "stream_close_backlog": "SELECT client_id, seq FROM raw_event",
    "stream_compacted": """SELECT client_id, seq, protocol, left(captured_at, 10) AS date, captured_at[12:13] AS hour, captured_at, raw_frame
      FROM ocpp_record""",
    "stream_session_events": f"""SELECT *, CASE
          WHEN event_type = 2 AND regexp_matches(connection_id, '[05]$') THEN 'unknown_connection'
          WHEN event_type = 2 AND direction IS NULL THEN 'incomplete_frame'
          WHEN trim(charger_id) = '' THEN 'invalid_identity'
          WHEN payload_bytes > {DOCUMENT_CAP} THEN 'frame_oversize' END AS drop_reason
      FROM (SELECT connection_id, 0 AS phase, NULL::BIGINT AS seq, 1 AS event_type, charger_id,
              NULL::VARCHAR AS direction, 0 AS payload_bytes FROM connection WHERE NOT regexp_matches(connection_id, '[05]$')
            UNION ALL
            SELECT connection_id, 1, seq, 2, CASE WHEN NOT regexp_matches(connection_id, '[05]$') THEN charger_id END,
              direction, strlen(payload_text)::INTEGER FROM frame JOIN connection USING (connection_id)
            UNION ALL SELECT connection_id, 2, NULL, 0, charger_id, NULL, 0 FROM connection WHERE NOT regexp_matches(connection_id, '[05]$'))""",
    "connection_ordinals": "SELECT client_id, charger_id, seq, event_type, ordinal, connection_id FROM connected",
    "delivery_outcomes": "SELECT * FROM outcome",
    "delivery_drop_accounting": """SELECT protocol, reason, count(*) AS n_batches, sum(n_messages)::BIGINT AS n_messages
      FROM outcome WHERE reason IS NOT NULL GROUP BY protocol, reason""",
    "client_config_resolved": "SELECT * FROM resolved",
    "config_warnings": """SELECT client_id, CASE WHEN debug THEN array_to_string(list_filter([
        CASE WHEN buffer_capacity < 1 THEN 'buffer_capacity' END,
        CASE WHEN max_capture_bytes < 1 THEN 'max_capture_bytes' END,
        CASE WHEN flush_interval < 0.001 THEN 'flush_interval' END,
        CASE WHEN drain_timeout < 5 THEN 'drain_timeout' END,
        CASE WHEN compression NOT IN ('gzip', 'zstd') THEN 'compression' END], lambda w: w IS NOT NULL), ',') END AS warnings
      FROM config""",
    "active_clients": "SELECT client_id FROM resolved WHERE active",
    "inert_clients_excluded": "SELECT client_id, seq, url FROM ocpi WHERE client_id IN (SELECT client_id FROM resolved WHERE active)",
    "inert_clients_rejected": """SELECT client_id, seq, 'ocpi' AS protocol, 'inert_client' AS drop_reason FROM ocpi
      WHERE client_id NOT IN (SELECT client_id FROM resolved WHERE active)""",
    "per_client_limits": f"""SELECT client_id, seq, drop_reason, CASE WHEN drop_reason IS NULL THEN
        {_header_text(f'''list_filter(map_entries(request_headers), lambda e: lower(e.key) IN ({ALLOWED})
          OR (lower(e.key) <> '' AND list_contains(string_split(allowed_headers, ','), lower(e.key))))''')} END AS request_headers
      FROM (SELECT *, coalesce(reason, CASE WHEN row_number()
                OVER (PARTITION BY client_id, reason IS NULL ORDER BY seq DESC) > buffer_capacity THEN 'ring_overflow' END) AS drop_reason
            FROM (SELECT o.*, r.buffer_capacity, r.allowed_headers,
                    CASE WHEN r.client_id IS NULL THEN 'inert_client' WHEN NOT valid THEN 'invalid_identity'
                         WHEN strlen(request_body_text) > max_capture_bytes THEN 'request_body_oversize'
                         WHEN strlen(response_body_text) > max_capture_bytes THEN 'response_body_oversize' END AS reason
                  FROM ocpi o LEFT JOIN (SELECT * FROM resolved WHERE active) r USING (client_id)))""",
    "client_codec": f"""SELECT client_id, cycle, chunk, n_messages, strlen(body)::INTEGER AS body_bytes,
        CASE WHEN strlen(body) < 1024 THEN 'identity' WHEN client_id = 'gw-1' THEN 'gzip' ELSE 'zstd' END AS content_encoding
      FROM ({_bodies(
          f"""(SELECT r.* REPLACE (CASE WHEN r.client_id <> 'gw-1' THEN list_filter(map_entries(m.request_headers),
                lambda e: lower(e.key) IN ({ALLOWED}, CASE WHEN m.client_id = 'gw-2' THEN 'cookie' ELSE 'x-trace' END)) ELSE request_entries END AS request_entries),
              epoch_us(m.captured_ts) + CASE WHEN r.client_id <> 'gw-1' AND m.captured_ts = min(m.captured_ts) OVER (PARTITION BY r.client_id)
                THEN 5000000 ELSE 200000 END AS cycle
            FROM ocpi_record r JOIN masked m ON m.client_id = r.client_id AND m.seq = r.seq WHERE r.client_id IN ('gw-0', 'gw-1', 'gw-2')
              AND (r.client_id <> 'gw-2' OR greatest(coalesce(strlen(m.request_body_text), 0), coalesce(strlen(m.response_body_text), 0)) <= 28))""",
          _OCPI_JSON, 'client_id, cycle')})""",
    "stream_connection_ordinals": "SELECT client_id, charger_id, seq, ordinal FROM connected WHERE trim(charger_id) <> ''",
    "stream_ocpp_records": f"SELECT client_id, seq, protocol, {_OCPP_FIELDS}, raw_frame FROM ocpp_record",
}

ORACLES = {name: f"{_CTE}{select}" for name, select in _SELECTS.items()}

# One poll with messages after the other: f is the last flush, o what waits since, g an interval that ended before this poll.
_STEPS = HOUR // EXACT_POLL
ORACLES["flush_cycles_exact"] = f"""WITH RECURSIVE raw_event AS ({_sql(testdata.OCPP_SQL)}),
timed AS (SELECT client_id, seq, epoch_us(captured_ts) // {EXACT_POLL}000000 AS tick FROM raw_event),
polled AS (
  SELECT client_id, tick, n, row_number() OVER (PARTITION BY client_id ORDER BY tick) AS i
  FROM (SELECT client_id, tick, count(*) AS n FROM timed GROUP BY client_id, tick)),
played AS (
  SELECT client_id, 0::BIGINT AS i, tick - 1 AS f, 0::HUGEINT AS o, NULL::BIGINT AS g, NULL::BIGINT AS p, NULL::VARCHAR AS why FROM polled WHERE i = 1
  UNION ALL
  SELECT client_id, i, CASE WHEN due THEN tick ELSE f END, CASE WHEN due THEN 0 ELSE o END, g, CASE WHEN due THEN tick END,
    CASE WHEN o >= {EXACT_CAP} THEN 'count' ELSE 'interval' END
  FROM (
    SELECT *, tick - f >= {_STEPS} OR o >= {EXACT_CAP} AS due FROM (
      SELECT s.client_id, q.i, q.tick, CASE WHEN s.o > 0 AND q.tick > s.f + {_STEPS} THEN s.f + {_STEPS} ELSE s.f END AS f,
        CASE WHEN s.o > 0 AND q.tick > s.f + {_STEPS} THEN 0 ELSE s.o END + q.n AS o,
        CASE WHEN s.o > 0 AND q.tick > s.f + {_STEPS} THEN s.f + {_STEPS} END AS g
      FROM played s JOIN polled q ON q.client_id = s.client_id AND q.i = s.i + 1))),
flushed AS (
  SELECT client_id, g AS p, 'interval' AS why FROM played WHERE g IS NOT NULL
  UNION ALL SELECT client_id, p, why FROM played WHERE p IS NOT NULL
  UNION ALL SELECT client_id, f + {_STEPS}, 'interval' FROM played WHERE o > 0
    QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY i DESC) = 1 AND i = (SELECT max(i) FROM polled q WHERE q.client_id = played.client_id)),
placed AS (
  SELECT t.client_id, t.seq, x.p, x.why AS trigger,
    (row_number() OVER (PARTITION BY t.client_id, x.p ORDER BY t.tick, t.seq) - 1) // {EXACT_CAP} AS chunk
  FROM timed t ASOF JOIN flushed x ON t.client_id = x.client_id AND t.tick <= x.p)
SELECT client_id, (p + 1) * {EXACT_POLL} AS cycle, trigger, chunk, count(*) AS n_messages, min(seq) AS first_seq, max(seq) AS last_seq
FROM placed GROUP BY client_id, p, trigger, chunk"""

ORACLES["chunk_bytes"] = _CTE.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
sized AS (
  SELECT client_id, seq, json, row_number() OVER w AS i, sum(strlen(json) + 1) OVER (w ROWS UNBOUNDED PRECEDING) AS upto
  FROM (SELECT client_id, seq, ({_OCPP_JSON})::VARCHAR AS json FROM ocpp_record) WINDOW w AS (PARTITION BY client_id ORDER BY seq)),
cut AS (
  SELECT client_id, 0::BIGINT AS chunk, 1::BIGINT AS i FROM sized WHERE i = 1
  UNION ALL
  SELECT b.client_id, b.chunk + 1, min(n.i)
  FROM (SELECT c.client_id, c.chunk, c.i, s.upto - strlen(s.json) - 1 AS before FROM cut c JOIN sized s ON s.client_id = c.client_id AND s.i = c.i) b
  JOIN sized n ON n.client_id = b.client_id WHERE n.i > b.i AND (n.upto - b.before > {BODY_BYTES} - 14 OR n.i - b.i >= 1000) GROUP BY b.client_id, b.chunk)
SELECT client_id, chunk, count(*)::INTEGER AS n_messages, min(seq) AS first_seq, max(seq) AS last_seq,
  strlen(any_value(body))::INTEGER AS body_bytes, md5(any_value(body)) AS body
FROM (SELECT *, '{{"messages":[' || string_agg(json, ',' ORDER BY seq) OVER (PARTITION BY client_id, chunk) || ']}}' AS body
  FROM (SELECT s.client_id, s.seq, s.json, c.chunk FROM sized s ASOF JOIN cut c ON s.client_id = c.client_id AND s.i >= c.i))
GROUP BY client_id, chunk"""

ORACLES["stream_size_or_interval"] = ORACLES["flush_cycles_exact"].replace(
    "FROM placed GROUP", f"FROM placed WHERE (p + 1) * {EXACT_POLL} <= (SELECT max(epoch_ms(captured_ts)) // 1000 FROM raw_event) GROUP"
)
