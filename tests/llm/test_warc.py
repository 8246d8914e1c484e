from __future__ import annotations

import base64
import hashlib
import io

import pytest
import zstandard

from chargestream.llm import warc
from chargestream.session import scratch_path

PAGE = "page_id long, url string, html string, extra string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(llm):
    body = "<p>Straße</p>" * 50
    rows = [(i, f"http://h/{i}", body if i % 3 == 0 else f"<p>{i}</p>" * 20, "x") for i in range(200)]
    rows += [(500, None, None, "x"), (501, "u\nv", "", "x"), (None, "u", body, "x"), (None, "u", "alone", "x"), (198, "http://h/198", body, "x"), (-5, "n", "negative", "x")]
    found = sorted((tuple(r) for r in warc.round_trip(llm, llm.createDataFrame(rows, PAGE)).drop("url").collect()), key=str)
    want = []
    for page, _, text, _ in rows:
        same = [p for p, _, t, _ in rows if (t or "") == (text or "") and p is not None]
        last = max(same, default=None)
        is_response = last is None or page == last
        want.append((page, "response" if is_response else "revisit", len((text or "").encode()), digest(text), None if is_response else last))
    assert found == sorted(want, key=str)


def test_an_archive_is_a_dictionary_frame_and_a_frame_per_record(llm):
    rows = [(i, "http://h/", f"<p>page {i} of many</p>" * 30, "") for i in range(300)]
    folder = "file://" + scratch_path(llm, "warc-test").removeprefix("file:")
    archives = warc.write(llm.createDataFrame(rows, PAGE).coalesce(1), folder, archive_bytes=50_000)
    listed = archives.collect()
    assert sum(r.records for r in listed) == 300 and len(listed) > 1
    raw = open(listed[0].path.removeprefix("file://"), "rb").read()
    size = int.from_bytes(raw[4:8], "little")
    assert raw[:4] == bytes.fromhex("5d2a4d18")
    known = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(raw[8 : 8 + size]))
    first = zstandard.ZstdDecompressor(dict_data=known).decompressobj().decompress(raw[8 + size :])
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: ") and first.endswith(b"\r\n\r\n")
    payloads = warc.read(archives, payload=True)
    assert {r.payload.decode() for r in payloads.collect()} == {r[2] for r in rows}


def test_empty_table(llm):
    assert warc.round_trip(llm, llm.createDataFrame([], PAGE)).collect() == []


def test_damage_is_noticed():
    out = io.BytesIO()
    warc.write_archive([warc.record(1, "u", b"payload", 1, True)], out)
    with pytest.raises(ValueError, match="within"):
        list(warc.read_archive(io.BytesIO(out.getvalue()[:-3])))
    good = next(iter(warc.read_archive(io.BytesIO(out.getvalue()))))
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(good.replace(b"payload\r\n", b"paxload\r\n"))


@pytest.mark.parametrize("page", [0, 1, -1, 2**63 - 1, -(2**63), 1 << 62])
def test_record_ids_carry_the_page(page):
    assert warc.page_of(warc.record_id(page, "", None)) == page
    assert warc.page_of(warc.record_id(None, "d", "u")) is None
