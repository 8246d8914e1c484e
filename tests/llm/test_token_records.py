"""Token ids in binary records, against the tokenizer itself and checksums taken bit by bit."""

from __future__ import annotations

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pytest

from chargestream.llm import token_records as T
from chargestream.llm.queries import QUERIES

from .conftest import prose

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"

ODD = [
    None,
    "",
    " ",
    "\n",
    " \n a\n\n b\nc",
    "été,  là. ça!? non oui… si",
    "it's 's a\n'll don't",
    "<|endoftext|> x<|endoftext|>",
    "a\x1c b\x1d c\x85d",
    "x" * 3000,
    "日本 語 テスト",
    "a , b ;c . . d",
]


def bitwise_crc32c(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def plain_ids(text: str | None) -> list[int]:
    return [*T.encoder(PATH, 0).tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def folder(tmp_path) -> str:
    return f"file://{tmp_path}/records"


def test_checksums():
    assert bitwise_crc32c(b"123456789") == 0xE3069283
    data = np.random.default_rng(5).integers(0, 256, 5000, dtype=np.uint8)
    start, end = np.array([0, 9, 700, 1, 3]), np.array([4, 1033, 2749, 5000, 2051])
    want = [bitwise_crc32c(data[a:b].tobytes()) for a, b in zip(start, end, strict=True)]
    assert T.crc32c(data, start, end).tolist() == want
    # The mask, as the format states it.
    assert T.masked(np.array([0x8A9136AA], np.uint32))[0] == ((0x8A9136AA >> 15 | 0x8A9136AA << 17) + 0xA282EAD8) % 2**32


@pytest.mark.parametrize("most", [2_000_000, 40])
def test_pieces_encode_as_whole_texts(monkeypatch, most):
    monkeypatch.setattr(T, "CACHE_PIECES", most)
    encode = T.Encoder(PATH)
    assert encode.cuts
    rnd = random.Random(3)
    mixed = ["".join(rnd.choices([" ", "\n", "a", "É", ".", ",", "'s", "é", "word", " ", "7", "…"], k=rnd.randrange(40))) for _ in range(400)]
    for texts in (ODD, mixed, ODD[::-1] + mixed[:50]):
        ids, counts = encode.encode(pa.array(texts, pa.string()))
        assert np.split(ids, np.cumsum(counts))[:-1] and [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [plain_ids(t) for t in texts]


def test_other_tokenizers_encode_whole_texts():
    other = T.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not other.cuts
    ids, counts = other.encode(pa.array(["Hello  World", None]))
    assert ids.tolist() == [*other.tokenizer.encode("Hello  World", add_special_tokens=False).ids, 0, 0] and counts[1] == 1


def test_files_hold_the_documents_in_order(llm, tmp_path):
    rnd = random.Random(1)
    rows = [(at * 3 - 50, " ".join(prose(rnd, rnd.randrange(60)))) for at in range(300)]
    rows += [(1000 + at, text) for at, text in enumerate(ODD)] + [(None, "no id"), (None, None), (4, "again"), (4, "again"), (4, "other")]
    rnd.shuffle(rows)
    docs = llm.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, start string, path int").repartition(5)
    files = T.write(docs, folder(tmp_path), PATH, file_bytes=4096)
    assert files.count() > 3
    got = [tuple(r) for r in T.read(files, ids=True).orderBy("start").collect()]
    ids = [i for i, *_ in got]
    assert ids[:2] == [None, None] and ids[2:] == sorted(i for i, _ in rows if i is not None)
    start = 0
    for _, at, n, crc, own in got:
        assert (at, n, crc) == (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += n
    key = lambda row: (row[0] is None, row[0] or 0, row[1])
    assert sorted(((r[0], r[4]) for r in got), key=key) == sorted(((i, plain_ids(t)) for i, t in rows), key=key)


def test_the_layout_is_that_of_the_format(llm, documents, tmp_path):
    files = T.write(documents((7, "one two"), (9, None)), folder(tmp_path), PATH)
    (path,) = (r.path for r in files.collect())
    raw = pafs.LocalFileSystem().open_input_file(path.removeprefix("file://")).read()
    at, seen = 0, []
    while at < len(raw):
        length = int.from_bytes(raw[at : at + 8], "little")
        body = raw[at + 12 : at + 12 + length]
        for part, stored in ((raw[at : at + 8], raw[at + 8 : at + 12]), (body, raw[at + 12 + length : at + 16 + length])):
            crc = bitwise_crc32c(part)
            assert int.from_bytes(stored, "little") == ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF
        seen.append((int.from_bytes(body[4:12], "little"), np.frombuffer(body[12:], "<u2").tolist()))
        at += 16 + length
    assert seen == [(7, plain_ids("one two")), (9, [0])]


@pytest.mark.parametrize("at", [3, 9, 14, 30, -1])
def test_damage_is_found(llm, documents, tmp_path, at):
    (path,) = (r.path for r in T.write(documents((1, "a few words to damage")), folder(tmp_path), PATH).collect())
    raw = bytearray(open(path.removeprefix("file://"), "rb").read())
    raw[at] ^= 4
    with pytest.raises(ValueError):
        list(T.read_file(io.BytesIO(bytes(raw)), "x"))


def test_reads_in_any_order_and_across_pieces(llm, documents, tmp_path, monkeypatch):
    rnd = random.Random(2)
    rows = [(i, " ".join(prose(rnd, rnd.randrange(1, 400)))) for i in range(60)]
    files = T.write(documents(*rows).repartition(3), folder(tmp_path), PATH, file_bytes=9000)
    want = {i: plain_ids(t) for i, t in rows}
    one, other = (T.read_shuffled(files, seed, epoch).orderBy("draw").collect() for seed, epoch in ((1, 0), (1, 1)))
    for got in (one, other):
        assert {r.doc_id: r.ids for r in got} == want and [r.doc_id for r in got] != sorted(want)
    assert [r.doc_id for r in one] != [r.doc_id for r in other]
    monkeypatch.setattr(T, "PIECE_BYTES", 100)
    for row in files.collect():
        with open(row.path.removeprefix("file://"), "rb") as source:
            assert [r.ids.tolist() for r in T.read_file(source, row.path)] == [want[r.doc_id] for r in T.read_file(open(row.path[7:], "rb"), "x")]


def test_empty_table_and_a_very_long_text(llm, documents, tmp_path):
    assert T.round_trip(llm, documents(), PATH).count() == 0
    long = "some words again. " * 1_200_000
    (row,) = T.round_trip(llm, documents((1, long)), PATH).collect()
    assert row.n_tokens == len(plain_ids(long)) and row.start == 0


def test_query_against_plain_encoding(llm):
    got = [tuple(r) for r in QUERIES["op12_binary_records"](llm, SF).orderBy("start").collect()]
    docs = sorted(tuple(r) for r in llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    start, want = 0, []
    for doc_id, text in docs:
        ids = plain_ids(text)
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
