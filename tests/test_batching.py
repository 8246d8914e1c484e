"""Records, cycles, chunks and batch bodies."""

from __future__ import annotations

import base64
import json
import re
from datetime import UTC, datetime

from pyspark.sql import functions as F

from chargestream import constants as C
from chargestream.operators import batching as B
from chargestream.operators import records as R
from chargestream.plans.flush import batches

from .conftest import by_seq

MOMENT = datetime(2026, 5, 18, 12, 34, 56, 789_123, UTC)


def message(at: int) -> dict:
    return {
        "captured_ts": MOMENT,
        "tenant_id": "north",
        "tenant_name": "North Grid",
        "url": f"/v3/sessions/{at}",
        "status_code": 202,
        "request_headers": {"Lane": str(at)},
        "response_headers": {"link": "next"},
        "request_body": b"\x00payload %d" % at,
    }


def bodies(df) -> list[dict]:
    return [json.loads(row.body) for row in df.orderBy("client_id", "chunk").collect()]


def test_ocpi_record(ocpi):
    row = by_seq(ocpi(message(7)).transform(R.ocpi_records))[0].asDict()
    assert list(row)[3:] == R.OCPI_FIELDS
    assert re.match(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$", row["captured_at"])
    assert row["captured_at"] == "2026-05-18T12:34:56.789Z"
    assert (row["direction"], row["http_method"], row["response_status_code"]) == ("IN", "POST", 202)
    assert row["request_headers"] == {"Lane": "7"}
    assert base64.standard_b64decode(row["request_body"]) == b"\x00payload 7"


# What an exchange need not have: everything but who, when, which way and where.
REQUIRED = {"captured_at", "platform_id", "platform_name", "direction", "http_method", "url"}
NULLABLE = [name for name in R.OCPI_FIELDS if name not in REQUIRED]


def test_absent_values_are_null_on_the_wire(ocpi):
    sparse = {"method": "GET", "url": "/x", "direction": "OUT", "captured_ts": MOMENT}
    empty = {**sparse, "tenant_id": "", "status_code": 0, "request_body": b"", "response_body": b""}
    for given in (sparse, empty):
        records = ocpi(given).transform(R.ocpi_records)
        (sent,) = bodies(batches(records, C.OCPI))[0]["messages"]
        assert [name for name in R.OCPI_FIELDS if sent[name] is None] == [
            name for name in R.OCPI_FIELDS if name in NULLABLE
        ]
        assert list(sent) == R.OCPI_FIELDS
        assert (sent["platform_id"], sent["direction"], sent["http_method"]) == ("acme", "OUT", "GET")


def test_a_blank_tenant_pair_is_valid_and_blanks_stay(ocpi):
    row = by_seq(ocpi({"tenant_id": "", "tenant_name": "  "}).transform(R.ocpi_records))[0]
    assert (row.tenant_id, row.tenant_name) == (None, "  ")


def test_event_type_zero_is_not_null(ocpp):
    event = {"event_type": C.DISCONNECT, "connection_id": "conn-1", "captured_ts": MOMENT}
    (sent,) = bodies(batches(ocpp(event).transform(R.ocpp_records), C.OCPP))[0]["messages"]
    assert sent == {
        "charger_id": "CP-001",
        "connection_id": "conn-1",
        "tenant_id": None,
        "tenant_name": None,
        "captured_at": "2026-05-18T12:34:56.789Z",
        "event_type": 0,
        "direction": None,
        "raw_frame": None,
    }


def test_an_empty_frame_is_kept_without_content(ocpp):
    row = by_seq(ocpp({"payload": b"", "direction": "TO_CP"}).transform(R.ocpp_records))[0]
    assert (row.raw_frame, row.direction, row.event_type) == (None, "TO_CP", 2)


def test_union_of_both_kinds_keeps_duplicates(ocpi, ocpp):
    records = ocpi({}).transform(R.ocpi_records)
    both = R.all_records(records.unionByName(records), ocpp({}).transform(R.ocpp_records))
    assert sorted(row.protocol for row in both.collect()) == ["ocpi", "ocpi", "ocpp"]


def test_chunks_hold_at_most_a_thousand_in_order(ocpi):
    df = ocpi(*[message(at) for at in range(2500)]).repartition(7)
    sent = batches(df.transform(R.ocpi_records), C.OCPI, compression="gzip")
    summary = sent.orderBy("chunk").collect()
    assert [(row.n_messages, row.first_seq, row.last_seq) for row in summary] == [
        (1000, 0, 999),
        (1000, 1000, 1999),
        (500, 2000, 2499),
    ]
    assert {row.content_encoding for row in summary} == {"gzip"}
    assert {row.route for row in summary} == {"/v1/ocpi"}
    urls = [record["url"] for body in bodies(sent) for record in body["messages"]]
    assert urls == [f"/v3/sessions/{at}" for at in range(2500)]


def test_chunks_of_several_clients_and_cycles(spark):
    df = spark.range(100).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, F.lit("a")).otherwise("hot").alias("client_id"),
        F.timestamp_seconds(F.col("id")).alias("captured_ts"),
    )
    keys = ["client_id", "cycle"]
    chunked = df.transform(B.with_cycle, 20.0).transform(B.with_chunk, keys, 5)
    rows = B.chunk_summary(chunked, keys).collect()
    assert sum(row.n_messages for row in rows) == 100
    assert all(row.n_messages <= 5 and row.last_seq - row.first_seq < 20 for row in rows)
    per_cycle = {}
    for row in rows:
        per_cycle.setdefault((row.client_id, row.cycle), []).append(row)
    for parts in per_cycle.values():
        parts.sort(key=lambda row: row.chunk)
        assert [row.chunk for row in parts] == [*range(len(parts))]
        assert all(row.n_messages == 5 for row in parts[:-1])
        assert all(a.last_seq < b.first_seq for a, b in zip(parts, parts[1:]))


def test_cycles_are_aligned_to_the_epoch(spark):
    df = spark.createDataFrame(
        [(0, 4.999999, 5.0), (1, 5.0, 5.0), (2, -0.5, 5.0), (3, 7.25, 0.001), (4, 7.0, float("inf"))],
        "i INT, t DOUBLE, step DOUBLE",
    ).withColumn("ts", F.timestamp_micros(F.round(F.col("t") * 1_000_000).cast("bigint")))
    found = df.select("i", F.unix_micros(B.flush_cycle(F.col("ts"), F.col("step"))).alias("start"))
    assert [row.start for row in found.orderBy("i").collect()] == [0, 5_000_000, -5_000_000, 7_250_000, 0]


def test_small_bodies_are_sent_as_they_are(spark):
    df = spark.createDataFrame([(0, 1023), (1, 1024), (2, 1025)], "seq INT, n INT")
    found = df.select("seq", B.content_encoding(F.col("n"), F.lit("zstd")).alias("c")).orderBy("seq")
    assert [row.c for row in found.collect()] == ["identity", "zstd", "zstd"]


def test_codec_per_client(ocpi):
    df = ocpi(*[{"client_id": c, "request_body": b"x" * 2000} for c in "ab"]).transform(R.ocpi_records)
    codec = F.when(F.col("client_id") == "a", "gzip").otherwise("zstd")
    sent = batches(df, C.OCPI, compression=codec).orderBy("client_id").collect()
    assert [row.content_encoding for row in sent] == ["gzip", "zstd"]


def test_bodies_are_ascii(ocpi):
    df = ocpi({"platform_name": 'é "😀" \\ \n'}).transform(R.ocpi_records)
    row = batches(df, C.OCPI).collect()[0]
    assert row.body.isascii() and row.body_bytes == len(row.body)
    assert json.loads(row.body)["messages"][0]["platform_name"] == 'é "😀" \\ \n'


def test_body_size_is_that_of_compact_ascii_json(ocpi):
    odd = "Žižkov 😀 \x7f \x00\x1f \u2028 \\ / \" '"
    records = ocpi(message(0), {"platform_name": odd}).transform(R.ocpi_records)
    row = batches(records, C.OCPI).collect()[0]
    want = {"messages": [{name: row[name] for name in R.OCPI_FIELDS} for row in by_seq(records)]}
    assert row.body_bytes == len(json.dumps(want, separators=(",", ":")))


def test_decode_undoes_assemble(ocpi, ocpp):
    records = ocpi(*[message(at) for at in range(30)]).transform(R.ocpi_records)
    decoded = B.decode_ocpi(batches(records, C.OCPI).select("body"))
    assert [row.request_body for row in decoded.orderBy(F.length("url"), "url").collect()] == [
        b"\x00payload %d" % at for at in range(30)
    ]
    frames = ocpp(*[{"payload": f"é{at}".encode(), "direction": "TO_CP"} for at in range(9)])
    decoded = B.decode_ocpp(batches(frames.transform(R.ocpp_records), C.OCPP).select("body"))
    assert sorted(row.raw_frame for row in decoded.collect()) == [f"é{at}" for at in range(9)]


def test_malformed_bodies_yield_no_records(spark):
    df = spark.createDataFrame(
        [
            (body,)
            for body in (
                None,
                "",
                "not json",
                "{}",
                '{"messages":[]}',
                '{"messages":null}',
                '{"messages":{"url":"/x"}}',
                '{"messages":["x"]}',
                '[{"messages":[{"url":"/x"}]}]',
                '{"messages":[{"url":"/x"}]',
                '{"messages":[{"url":"/x"}]} junk',
                '{"messages":[{"url":"/x"}]}{"messages":[]}',
                '{"messages":[{"url":"/x"}]},{"messages":[]}',
            )
        ],
        "body STRING",
    )
    assert B.decode_ocpi(df).collect() == B.decode_ocpp(df).collect() == []


def test_unknown_fields_are_passed_over(spark):
    df = spark.createDataFrame([(' {"x":[1],"messages":[{"url":"/x","y":2}]}\n',)], "body STRING")
    assert [row.url for row in B.decode_ocpi(df).collect()] == ["/x"]


def test_a_body_that_is_no_base64_costs_one_record_and_not_the_job(spark):
    sent = [{"url": f"/{at}", "request_body": body} for at, body in enumerate(["YQ==", "a", None, "%%%", "Yg=="])]
    df = spark.createDataFrame([(json.dumps({"messages": sent}),)], "body STRING")
    assert [(r.url, r.request_body) for r in B.decode_ocpi(df).collect()] == [("/0", b"a"), ("/2", None), ("/4", b"b")]
    faults = B.decode_faults(df, C.OCPI).collect()
    assert [(r.url, r.request_body, r.drop_reason) for r in faults] == [("/1", "a", C.UNDECODABLE_BODY), ("/3", "%%%", C.UNDECODABLE_BODY)]
