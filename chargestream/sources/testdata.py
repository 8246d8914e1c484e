"""Capture tables derived from the analytic test tables (see FIXTURES.md, part 2).

The SELECTs are plain SQL that Spark and DuckDB read alike, so that queries and
their oracles start from the same rows. What differs between the dialects
(binary casts, header maps) is added per side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .captures import stream

OCPI_SQL = """
SELECT o_orderkey AS seq,
  'gw-' || (o_custkey % 4) AS client_id,
  o_orderdate AS captured_ts,
  CASE WHEN o_orderkey % 2 = 0 THEN 'IN' ELSE 'OUT' END AS direction,
  CASE WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 19 = 0 THEN '   '
       WHEN o_orderkey % 23 = 0 THEN NULL ELSE c_name END AS platform_id,
  c_mktsegment AS platform_name,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN ''
       ELSE 'n' || c_nationkey END AS tenant_id,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN '  '
       WHEN o_orderkey % 11 = 0 THEN NULL ELSE n_name END AS tenant_name,
  CASE o_orderstatus WHEN 'O' THEN 'POST' WHEN 'F' THEN 'PUT' ELSE 'GET' END AS method,
  CASE WHEN o_orderkey % 40 = 0 THEN '/ocpi/2.2/credentials'
       WHEN o_orderkey % 40 = 10 THEN '/ocpi/2.2/CREDENTIALS/?x=1'
       WHEN o_orderkey % 40 = 20 THEN '/ocpi/2.2/credentials/foo'
       ELSE '/ocpi/2.2/cdrs/' || o_orderkey END AS url,
  CASE WHEN o_orderkey % 13 = 0 THEN 0 WHEN o_orderkey % 3 = 0 THEN NULL ELSE 200 END AS status_code,
  CASE WHEN o_orderkey % 160 < 40 THEN NULL
       WHEN o_orderkey % 160 < 80 THEN '{{"token":"","url":"u' || o_orderkey || '"}}'
       WHEN o_orderkey % 160 < 90 THEN 'not json'
       ELSE '{{"token":"S' || o_orderkey || '","url":"u"}}' END AS request_body_text,
  CASE WHEN o_orderkey % 6 = 0
       THEN '{{"status_code":1000,"data":{{"token":"R' || o_orderkey || '"}}}}' ELSE NULL END AS response_body_text
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
"""

OCPP_SQL = """
SELECT event_id AS seq,
  'csms-' || (user_id % 4) AS client_id,
  ts AS captured_ts,
  CASE WHEN event_id % 29 = 0 THEN '  ' ELSE 'CP-' || user_id END AS charger_id,
  CASE WHEN user_id % 3 = 0 THEN NULL ELSE 't' || (user_id % 5) END AS tenant_id,
  CASE WHEN user_id % 3 = 0 THEN NULL WHEN event_id % 31 = 0 THEN ''
       ELSE 'Tenant ' || (user_id % 5) END AS tenant_name,
  CASE event_type WHEN 'signup' THEN 'CONNECT' WHEN 'error' THEN 'DISCONNECT' ELSE 'MESSAGE' END AS event_name,
  CASE WHEN event_type = 'view' THEN 'TO_CP' WHEN event_type = 'click' THEN 'FROM_CP'
       WHEN event_id % 2 = 0 THEN 'FROM_CP' ELSE NULL END AS direction,
  CASE WHEN event_id % 37 = 0 THEN NULL
       ELSE '[2,"' || event_id || '","' || event_type || '",' || props || ']' END AS payload_text
FROM {events}
"""

FRAMES_SQL = """
SELECT conv_id * 1000 + turn AS seq,
  'conn-' || conv_id AS connection_id,
  CASE role WHEN 'user' THEN 'FROM_CP' WHEN 'assistant' THEN 'TO_CP' ELSE NULL END AS direction,
  text AS payload_text
FROM {conversations}
"""

CONNECTIONS_SQL = """
SELECT DISTINCT 'conn-' || conv_id AS connection_id,
  CASE WHEN conv_id % 13 = 0 THEN ' ' ELSE 'CP-' || conv_id END AS charger_id,
  CASE WHEN conv_id % 2 = 0 THEN 't' || (conv_id % 5) ELSE NULL END AS tenant_id,
  CASE WHEN conv_id % 2 = 0 THEN 'Tenant ' || (conv_id % 5) ELSE NULL END AS tenant_name
FROM {conversations}
"""

DOCUMENTS_SQL = """
SELECT doc_id AS seq, 'gw-' || (doc_id % 4) AS client_id, text AS request_body_text FROM {documents}
"""

# Every 36 events in a row are batches of 1 to 8 attempts: some are still under
# way, some go on after the limit. No event is left out.
ATTEMPTS_SQL = """
SELECT base + size AS batch_id, CASE WHEN size % 2 = 0 THEN 'ocpi' ELSE 'ocpp' END AS protocol,
  CAST(size * 10 AS BIGINT) AS n_messages,
  CAST(event_id - base - CASE size WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 3 WHEN 4 THEN 6 WHEN 5 THEN 10 WHEN 6 THEN 15
    WHEN 7 THEN 21 ELSE 28 END AS INTEGER) AS attempt,
  CASE event_type WHEN 'view' THEN (CASE WHEN event_id % 4 = 0 THEN 200 ELSE 502 END) WHEN 'click' THEN 503
    WHEN 'signup' THEN 500
    WHEN 'purchase' THEN (CASE WHEN event_id % 3 = 0 THEN 400 WHEN event_id % 3 = 1 THEN 401 ELSE 413 END)
    ELSE NULL END AS status
FROM (SELECT event_id, event_type, event_id - event_id % 36 AS base,
        CASE WHEN event_id % 36 < 1 THEN 1 WHEN event_id % 36 < 3 THEN 2 WHEN event_id % 36 < 6 THEN 3
          WHEN event_id % 36 < 10 THEN 4 WHEN event_id % 36 < 15 THEN 5 WHEN event_id % 36 < 21 THEN 6
          WHEN event_id % 36 < 28 THEN 7 ELSE 8 END AS size FROM {events}) e
"""

CONFIG_SQL = """
SELECT 'gw-' || c_custkey AS client_id,
  CASE c_custkey % 5 WHEN 3 THEN 'ftp://ingest.example.com' WHEN 4 THEN '   '
    ELSE 'https://ingest.example.com/' END AS endpoint,
  CASE WHEN c_custkey % 7 = 6 THEN FALSE ELSE TRUE END AS has_api_key,
  CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 500 END AS buffer_capacity,
  CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN -1 ELSE 28 END AS max_capture_bytes,
  CASE c_custkey % 3 WHEN 0 THEN CAST(0.0 AS DOUBLE) WHEN 1 THEN CAST(0.001 AS DOUBLE) ELSE NULL END AS flush_interval,
  CASE c_custkey % 3 WHEN 0 THEN CAST(2.0 AS DOUBLE) WHEN 1 THEN CAST(5.0 AS DOUBLE) ELSE NULL END AS drain_timeout,
  CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'gzip' WHEN 2 THEN 'zstd' ELSE 'brotli' END AS compression,
  CASE WHEN c_custkey % 2 = 0 THEN TRUE ELSE FALSE END AS debug,
  CASE c_custkey % 3 WHEN 0 THEN '  X-Trace ,x-trace,X-Request-Id,   ' WHEN 1 THEN NULL ELSE 'Cookie' END AS allowed_headers_csv
FROM {customer}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def select(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    """Run one of the SELECTs above over the named test tables."""
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in names})


def _binary(*names: str) -> dict:
    return {name: F.col(f"{name}_text").cast("binary") for name in names}


def _with_headers(df: DataFrame) -> DataFrame:
    seq = F.col("seq").cast("string")
    none = F.create_map().cast("map<string,string>")
    usual = F.create_map(
        F.lit("Authorization"), F.concat(F.lit("Token "), seq),
        F.lit("Content-Type"), F.lit("application/json"),
        F.lit("OCPI-from-party-id"), F.col("client_id"),
        F.lit("X-Trace"), seq,
    )
    cookie = F.create_map(F.lit("Cookie"), F.concat(F.lit("sid="), seq))
    answer = F.create_map(
        F.lit("X-Total-Count"), F.lit("3"), F.lit("Set-Cookie"), F.concat(F.lit("sid="), seq)
    )
    case = F.col("seq") % 9
    return df.withColumns(
        {
            "request_headers": F.when(case == 0, none).when(case == 1, cookie).otherwise(usual),
            "response_headers": answer,
        }
    )


def ocpi_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = select(spark, sf_dir, OCPI_SQL, "orders", "customer", "nation")
    return (
        base.transform(_with_headers)
        .withColumns(_binary("request_body", "response_body"))
        .withColumn("captured_ts", F.col("captured_ts").cast("timestamp"))
        .drop("request_body_text", "response_body_text")
    )


def ocpp_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events, with an event name and without a connection id."""
    return _ocpp_columns(select(spark, sf_dir, OCPP_SQL, "events"))


def _ocpp_columns(events: DataFrame) -> DataFrame:
    return (
        events.withColumns(_binary("payload"))
        .withColumn("captured_ts", F.col("captured_ts").cast("timestamp"))
        .drop("payload_text")
    )


def session_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = select(spark, sf_dir, FRAMES_SQL, "conversations")
    return frames.withColumns(_binary("payload")).drop("payload_text")


def connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(spark, sf_dir, CONNECTIONS_SQL, "conversations")


def ocpp_capture_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as `ocpp_capture`, arriving as a stream."""
    schema = table(spark, sf_dir, "events").schema
    # A pattern matches a table that is one file as well as a folder of files.
    events = stream(spark, f"{sf_dir}/events.parque[t]", schema)
    return _ocpp_columns(spark.sql(OCPP_SQL, events=events))


def document_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchanges with document texts as request bodies, all from one platform."""
    none = F.lit(None).cast("string")
    return (
        select(spark, sf_dir, DOCUMENTS_SQL, "documents")
        .withColumns(_binary("request_body"))
        .drop("request_body_text")
        .withColumns(
            {
                "platform_id": F.lit("acme"),
                "platform_name": F.lit("Acme Mobility"),
                "tenant_id": none,
                "tenant_name": none,
                "url": F.lit("/ocpi/2.2/cdrs"),
                "response_body": F.lit(None).cast("binary"),
            }
        )
    )


def delivery_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(spark, sf_dir, ATTEMPTS_SQL, "events")


def client_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null list stays null; an absent one and an empty one mean the same."""
    config = select(spark, sf_dir, CONFIG_SQL, "customer")
    return config.withColumn("allowed_headers", F.split("allowed_headers_csv", ",")).drop(
        "allowed_headers_csv"
    )
