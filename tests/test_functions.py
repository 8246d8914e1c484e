"""Column helpers against plain Python written from the contract."""

from __future__ import annotations

import base64
import json
import re
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chargestream.functions import (
    body_base64,
    body_size,
    encode_frame,
    headers_or_null,
    is_credentials_url,
    is_valid_endpoint,
    non_blank,
    normalise_endpoint,
    null_if_empty,
    null_if_zero,
    route,
    strip_blanks,
    value_or_default,
    wire_timestamp,
)
from chargestream.functions.tokens import mask_token


def values(spark, column, given, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], f"i INT, v {kind}")
    return [row.out for row in df.withColumn("out", column).orderBy("i").collect()]


def test_non_blank_agrees_with_strip_on_every_code_point(spark):
    points = [c for c in range(1, 0x11000) if not 0xD800 <= c < 0xE000]
    found = values(spark, non_blank(F.col("v")), [chr(c) for c in points])
    assert [c for c, out in zip(points, found) if out != (chr(c).strip() != "")] == []


def test_strip_agrees_with_strip_on_every_code_point(spark):
    points = [c for c in range(1, 0x11000) if not 0xD800 <= c < 0xE000]
    texts = [f"{chr(c)}a{chr(c)}b{chr(c)}" for c in points]
    found = values(spark, strip_blanks(F.col("v")), texts)
    assert [t for t, out in zip(texts, found) if out != t.strip()] == []


def test_non_blank_is_never_null(spark):
    assert values(spark, non_blank(F.col("v")), [None, "", "  ", "\t\n", " x "]) == [False] * 4 + [True]


URLS = [
    "/party/credentials",
    "/v3/Credentials/",
    "/credentials?page",
    "/a/b/cREDENTIALS/?",
    "/credentials\n",
    "/credentials\r",
    "/credentials\r\n",
    "/credentials ",
    "/credentials//",
    "/credentials/foo",
    "/credentials#frag",
    "/x?r=/credentials",
    "/xcredentials",
    "/credentialſ",
    "/credentıals",
    "/credentials/\n",
    "/credentials\n\n",
    "credentials",
    "/ocpi/2.2/cdrs",
    "",
]


def test_credentials_url_agrees_with_python_search(spark):
    pattern = re.compile(r"/credentials/?(?:\?|$)", re.IGNORECASE)
    found = values(spark, is_credentials_url(F.col("v")), [*URLS, None])
    assert found == [bool(pattern.search(url)) for url in URLS] + [False]


@pytest.mark.parametrize(
    ("endpoint", "expected"),
    [
        ("https://sink.example.org/", "https://sink.example.org"),
        ("  http://localhost:8080  ", "http://localhost:8080"),
        ("HTTPS://X.example.com//", "HTTPS://X.example.com"),
        ("https://x.example.com/base/", "https://x.example.com/base"),
        (" \t", None),
        ("https", None),
        ("ws://sink.example.org", None),
        ("sink.example.org/v1", None),
        ("https:///path", None),
        ("https://?x", None),
        ("https://[::1]:8080/", "https://[::1]:8080"),
        ("https://user@[fe80::1]", "https://user@[fe80::1]"),
        ("https://user:pw@host:1/p?q#f", "https://user:pw@host:1/p?q#f"),
        ("https://[::1", None),
        ("https://host]", None),
        ("https://[host]", None),
        (None, None),
    ],
)
def test_endpoint(spark, endpoint, expected):
    assert values(spark, normalise_endpoint(F.col("v")), [endpoint]) == [expected]
    assert values(spark, is_valid_endpoint(F.col("v")), [endpoint]) == [expected is not None]


def test_empty_becomes_null_but_blanks_stay(spark):
    assert values(spark, null_if_empty(F.col("v")), [None, "", "  ", "t"]) == [None, None, "  ", "t"]


def test_zero_becomes_null(spark):
    assert values(spark, null_if_zero(F.col("v")), [None, 0, 200], "INT") == [None, None, 200]


def test_empty_headers_become_null(spark):
    given = [None, {}, {"A": "b"}]
    assert values(spark, headers_or_null(F.col("v")), given, "MAP<STRING,STRING>") == [None, None, {"A": "b"}]


@pytest.mark.parametrize("chunked", ["true", "false"])
def test_base64_is_one_line_under_either_setting(spark, chunked):
    setting = "spark.sql.chunkBase64String.enabled"
    spark.conf.set(setting, chunked)
    try:
        bodies = [None, b"", b"x", bytes(range(256)) * 5]
        found = values(spark, body_base64(F.col("v")), [b and bytearray(b) for b in bodies], "BINARY")
    finally:
        spark.conf.set(setting, "false")
    assert found == [base64.standard_b64encode(b).decode() if b else None for b in bodies]


def test_sizes_are_bytes(spark):
    assert values(spark, body_size(encode_frame(F.col("v"))), [None, "", "abc", "é", "😀"]) == [0, 0, 3, 2, 4]


def test_timestamp_cuts_off_below_a_millisecond(spark):
    moments = [
        datetime(2026, 5, 18, 12, 34, 56, 789_999, UTC),
        datetime(2026, 1, 1, tzinfo=UTC),
        datetime(1969, 12, 31, 23, 59, 59, 999_999, UTC),
    ]
    found = values(spark, wire_timestamp(F.col("v")), moments, "TIMESTAMP")
    assert found == ["2026-05-18T12:34:56.789Z", "2026-01-01T00:00:00.000Z", "1969-12-31T23:59:59.999Z"]


def test_route(spark):
    assert values(spark, route(F.col("v")), ["ocpi", "ocpp"]) == ["/v1/ocpi", "/v1/ocpp"]


def test_value_or_default(spark):
    ints = values(spark, value_or_default(F.col("v"), 1, 10_000), [None, -1, 0, 1, 500], "INT")
    assert ints == [10_000, 10_000, 10_000, 1, 500]
    seconds = [None, 0.0, 0.001, 7.5, float("nan"), float("inf")]
    found = values(spark, value_or_default(F.col("v"), 0.001, 5.0), seconds, "DOUBLE")
    assert found == [5.0, 5.0, 0.001, 7.5, 5.0, float("inf")]


# --- token mask --------------------------------------------------------------

UNTOUCHED = [
    b"not json at all",
    b'["token"]',
    b'{"url":"https://x"}',
    b'{"token":""}',
    b'{"token":5}',
    b'{"token":null}',
    b'{"data":["token"]}',
    b'{"data":{"token":""}}',
    b'{"data":{"token":{"a":1}}}',
    b'{"a":{"token":"x"}}',
    b'\xef\xbb\xbf{"token":"x"}',
    b'"token"',
    b"   ",
]


@pytest.mark.parametrize("body", UNTOUCHED)
def test_bodies_without_a_token_come_back_byte_for_byte(body):
    assert mask_token(body) == body


@pytest.mark.parametrize(
    ("body", "masked"),
    [
        ('{"token": "S", "url": "u"}', '{"token":"[redacted]","url":"u"}'),
        ('{"data":{"token":"S"}}', '{"data":{"token":"[redacted]"}}'),
        ('{"token":"","data":{"token":"S"}}', '{"token":"","data":{"token":"[redacted]"}}'),
        # Only the root token when both are there.
        ('{"token":"a","data":{"token":"b"}}', '{"token":"[redacted]","data":{"token":"b"}}'),
        # The body is written anew: numbers, duplicate keys and letters change form.
        ('{"token":"a","n":1e5}', '{"token":"[redacted]","n":100000.0}'),
        ('{"token":"a","k":1,"k":2}', '{"token":"[redacted]","k":2}'),
        ('{"token":"a","n":"é"}', '{"token":"[redacted]","n":"\\u00e9"}'),
        ('{"token":"a","n":NaN}', '{"token":"[redacted]","n":NaN}'),
        ('{"t\\u006fken":"a"}', '{"token":"[redacted]"}'),
        ('{"token":" "}', '{"token":"[redacted]"}'),
    ],
)
def test_mask(body, masked):
    assert mask_token(body.encode()) == masked.encode()


def test_broken_utf8_is_replaced_before_parsing():
    assert json.loads(mask_token(b'{"token":"a","n":"\xff"}')) == {"token": "[redacted]", "n": "�"}


def test_wire_timestamps_do_not_depend_on_the_session_zone(spark):
    moments = [0, -1, 1_234_567, 1_394_951_399_999_999, 1_394_951_400_000_000, 1_793_000_000_123_456, -62_000_000_000_000_001]
    want = [(datetime(1970, 1, 1) + timedelta(microseconds=m)).isoformat(timespec="milliseconds") + "Z" for m in moments]
    df = spark.createDataFrame([(m,) for m in moments], "m BIGINT")
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            found = df.select(wire_timestamp(F.timestamp_micros("m")).alias("t")).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert [row.t for row in found] == want


def test_wire_timestamps_of_far_years_and_before_the_epoch(spark):
    micros = [-1, -62_135_596_800_000_000, 253_402_300_800_000_000, 9_223_372_036_854_775_807, 1_709_251_199_999_999, 0]
    df = spark.createDataFrame([(m,) for m in micros], "m BIGINT").withColumn("t", wire_timestamp(F.timestamp_micros("m")))
    assert [row.t for row in df.collect()] == [
        "1969-12-31T23:59:59.999Z", "0001-01-01T00:00:00.000Z", "+10000-01-01T00:00:00.000Z", "+294247-01-10T04:00:54.775Z",
        "2024-02-29T23:59:59.999Z", "1970-01-01T00:00:00.000Z",
    ]
