"""Random captures through the whole job, against a few lines of plain Python."""

from __future__ import annotations

import base64
import json
import random
import re
from datetime import UTC, datetime, timedelta

import pytest

from chargestream import constants as C
from chargestream.operators.records import OCPI_FIELDS
from chargestream.plans.flush import batches, flush, prepare_ocpi
from chargestream.session import stage

CAP, CAPACITY, SIZE = 60, 25, 10
EXTRA = ["X-Trace"]

TEXTS = ["", " ", "\t ", None, "acme", "Žofie 😀", 'q"\\/', "\x7f\x1f", "t1"]
URLS = ["/credentials", "/x/Credentials/", "/credentials?a=b", "/credentials/foo", "/cdrs/1", ""]
BODIES = [
    None,
    b"",
    b"not json",
    b'{"token":"S"}',
    b'{"token":"S","data":{"token":"T"},"n":1.50}',
    b'{ "data" : {"token":"T","k":[1,2,{}]}, "e":"\xc3\xa9" }',
    b'{"token":"","url":"u"}',
    b'{"token":"\xff"}',
    b"x" * CAP,
    b"x" * (CAP + 1),
]
HEADERS = ["Accept", "accept", "Authorization", "X-TRACE", "Link", "Cookie", "OCPI-To-Party-Id"]


def capture(rng: random.Random, at: int) -> dict:
    def headers():
        return {name: f"v{at}" for name in rng.sample(HEADERS, rng.randint(0, 4))}

    return {
        "seq": at * 3 - 200,
        "client_id": rng.choice(["hot"] * 4 + ["gw", None]),
        "captured_ts": datetime(2026, 3, 1, tzinfo=UTC) + timedelta(microseconds=rng.randrange(10**12)),
        "direction": rng.choice(["IN", "OUT"]),
        "platform_id": rng.choice(TEXTS[3:] * 3 + TEXTS),
        "platform_name": rng.choice(TEXTS[4:]),
        "tenant_id": rng.choice(TEXTS[:4] * 3 + TEXTS),
        "tenant_name": rng.choice(TEXTS[:4] * 3 + TEXTS),
        "method": rng.choice(["GET", "POST"]),
        "url": rng.choice(URLS),
        "status_code": rng.choice([None, 0, 200, 404]),
        "request_headers": headers(),
        "response_headers": headers(),
        "request_body": rng.choice(BODIES),
        "response_body": rng.choice(BODIES),
    }


def verdict(row: dict) -> str | None:
    given = {name: bool((row[name] or "").strip()) for name in ("platform_id", "platform_name", "tenant_id", "tenant_name")}
    if not (given["platform_id"] and given["platform_name"]) or given["tenant_id"] != given["tenant_name"]:
        return C.INVALID_IDENTITY
    for side in ("request_body", "response_body"):
        if len(row[side] or b"") > CAP:
            return f"{side}_oversize"
    return None


def sent_body(body: bytes | None, url: str) -> str | None:
    if not body:
        return None
    if re.search(r"/credentials/?(\?|$)", url, re.I):
        try:
            doc = json.loads(body.decode("utf-8", "replace"))
        except ValueError:
            doc = None
        if isinstance(doc, dict):
            inner = doc["data"] if isinstance(doc.get("data"), dict) else {}
            place = doc if doc.get("token") else inner
            if isinstance(place.get("token"), str) and place["token"]:
                place["token"] = "[redacted]"
                body = json.dumps(doc, separators=(",", ":")).encode()
    return base64.b64encode(body).decode()


def wire(row: dict) -> dict:
    allowed = {*C.DEFAULT_HEADER_ALLOWLIST, "x-trace"}

    def kept(headers):
        return {name: value for name, value in headers.items() if name.lower() in allowed} or None

    moment = row["captured_ts"]
    values = [
        f"{moment:%Y-%m-%dT%H:%M:%S}.{moment.microsecond // 1000:03d}Z",
        row["platform_id"],
        row["platform_name"],
        row["tenant_id"] or None,
        row["tenant_name"] or None,
        row["direction"],
        row["method"],
        row["url"],
        row["status_code"] or None,
        kept(row["request_headers"]),
        sent_body(row["request_body"], row["url"]),
        kept(row["response_headers"]),
        sent_body(row["response_body"], row["url"]),
    ]
    return dict(zip(OCPI_FIELDS, values))


@pytest.mark.parametrize("seed", [1, 2])
def test_whole_job(ocpi, seed):
    rng = random.Random(seed)
    rows = [capture(rng, at) for at in range(300)]

    reasons = {row["seq"]: verdict(row) for row in rows}
    want = {}
    for client in ("hot", "gw", None):
        entered = [row for row in rows if row["client_id"] == client and reasons[row["seq"]] is None]
        for row in entered[:-CAPACITY]:
            reasons[row["seq"]] = C.RING_OVERFLOW
        held = entered[-CAPACITY:]
        for start in range(0, len(held), SIZE):
            want[client, start // SIZE] = [wire(row) for row in held[start : start + SIZE]]

    shuffled = rng.sample(rows, len(rows))
    prepared = stage(prepare_ocpi(ocpi(*shuffled).repartition(5), CAP, EXTRA), "whole")
    done = flush(prepared, C.OCPI, CAPACITY, ["client_id"])
    lost = {row.seq: row.drop_reason for row in done.rejected.collect()}
    assert lost == {seq: reason for seq, reason in reasons.items() if reason}

    sent = {(row.client_id, row.chunk): row for row in batches(done.records, C.OCPI, size=SIZE).collect()}
    assert {key: json.loads(row.body)["messages"] for key, row in sent.items()} == want
    for key, row in sent.items():
        compact = json.dumps({"messages": want[key]}, separators=(",", ":"))
        assert row.body.isascii() and row.body_bytes == len(compact)
        assert row.content_encoding == ("identity" if len(compact) < 1024 else "zstd")
