"""WARC archives whose records share a Zstandard dictionary.

An archive begins with a skippable frame that holds the dictionary (compressed,
as readers of dictionary-compressed WARC files expect); every record is a frame
of its own after it, so one record can be read without the others. The
dictionary is built from records spread evenly over the archive it leads.

Records are written where Spark has put their rows. A task fills one archive at
a time up to `archive_bytes`, writes it aside and renames it, and returns its
path; the returned table is the list of archives, so files of lost or repeated
tasks are simply not on it. Any folder that pyarrow can open will do.

Equal payloads: the digests are counted on narrow rows; each page then learns
the largest page_id of its digest by a join that splits hot digests. That page's
record is the response, the others are revisits that refer to it.

Defined cases: null html is an empty payload. A page without an id is never
referred to: among equal payloads it is a revisit when another page has an id,
else a response; its page_id reads back as null. Rows equal in page_id and
payload are all responses if theirs is the largest page_id. A null url leaves
its header out. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, stage
from .text import column

ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 9
DATE = "1970-01-01T00:00:00Z"

# Fixed by the file formats.
_SKIPPABLE = 0x184D2A5D
_FRAME = b"\x28\xb5\x2f\xfd"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, digest: str, url: str | None) -> str:
    """An id that carries the page_id (a version 8 UUID), or one of the content if there is none."""
    if page_id is None:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{digest} {url}')}>"
    bits = page_id & (1 << 64) - 1
    value = (bits >> 62) << 64 | 8 << 76 | 2 << 62 | bits & (1 << 62) - 1
    return f"<urn:uuid:{uuid.UUID(int=value)}>"


def page_of(record: str | None) -> int | None:
    if not record:
        return None
    value = uuid.UUID(record.strip("<>").removeprefix("urn:uuid:")).int
    if value >> 76 & 15 != 8:
        return None
    bits = (value >> 64 & 3) << 62 | value & (1 << 62) - 1
    return bits - (1 << 64) if bits >> 63 else bits


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(first: str, fields: list[tuple[str, str | None]]) -> bytes:
    lines = [first, *(f"{k}: {v}" for k, v in fields if v is not None)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _one_line(url: str | None) -> str | None:
    return None if url is None else "".join(f"%{ord(c):02X}" if c < "!" else c for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, response: int | None, is_response: bool) -> bytes:
    """One record. A revisit keeps the HTTP header and leaves the payload out."""
    digest = payload_digest(payload)
    http = _header("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))])
    block = http + payload if is_response else http
    block_digest = payload_digest(block)
    fields = [
        ("WARC-Type", "response" if is_response else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest, url)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _one_line(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{block_digest}"),
        ("WARC-Profile", None if is_response else _REVISIT_PROFILE),
        ("WARC-Refers-To", None if is_response else record_id(response, digest, None)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return _header("WARC/1.1", fields) + block + b"\r\n\r\n"


def dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict:
    """Trained on records from all over the archive; a small archive's records serve as they are."""
    step = max(1, sum(map(len, records)) // (100 * size))
    samples = records[::step]
    try:
        return zstandard.train_dictionary(size, samples, k=1024, d=8)
    except zstandard.ZstdError:  # too few samples to train on
        raw = b"".join(samples)[-size:]
        return zstandard.ZstdCompressionDict(b"\0" * (8 - len(raw)) + raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(records: list[bytes], out: BinaryIO) -> None:
    known = dictionary(records)
    frame = zstandard.ZstdCompressor(level=19).compress(known.as_bytes())
    out.write(_SKIPPABLE.to_bytes(4, "little") + len(frame).to_bytes(4, "little") + frame)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
    for one in records:
        out.write(compressor.compress(one))


def read_archive(source: BinaryIO, piece: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    head = source.read(8)
    if int.from_bytes(head[:4], "little") != _SKIPPABLE:
        raise ValueError("no dictionary frame")
    frame = source.read(int.from_bytes(head[4:], "little"))
    known = zstandard.ZstdDecompressor().decompress(frame) if frame[:4] == _FRAME else frame
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(known))
    rest = b""
    while rest or (rest := source.read(piece)):
        one, parts = reader.decompressobj(), []
        while True:
            parts.append(one.decompress(rest))
            rest = one.unused_data if one.eof else source.read(piece)
            if one.eof:
                break
            if not rest:
                raise ValueError("archive ends within a record")
        yield b"".join(parts)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}


def parse(raw: bytes) -> dict:
    """Headers and payload of one record; what was written must be what is read."""
    end = raw.index(b"\r\n\r\n")
    fields = _fields(raw[:end])
    block = raw[end + 4 : end + 4 + int(fields["content-length"])]
    if fields["warc-block-digest"] != f"sha1:{payload_digest(block)}":
        raise ValueError(f"block of {fields['warc-record-id']} is damaged")
    at = block.index(b"\r\n\r\n")
    is_response = fields["warc-type"] == "response"
    payload = block[at + 4 :] if is_response else None
    written = fields["warc-payload-digest"].removeprefix("sha1:")
    return {
        "page_id": page_of(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "payload_bytes": len(payload) if is_response else int(_fields(block[:at])["content-length"]),
        "payload_digest": payload_digest(payload) if is_response else written,
        "refers_to": page_of(fields.get("warc-refers-to")),
        "payload": payload,
    }


def with_response(pages: DataFrame) -> DataFrame:
    """Add `payload` and `response`, the largest page_id with an equal payload."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    largest = rows.groupBy("sha1").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
    shared = largest.where("n > 1").select("sha1", "response")
    joined = rows.join(stage(shared, "warc-equal"), "sha1", "left").drop("sha1")
    return joined.withColumn("response", F.coalesce("response", "page_id"))


def write(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archive every row of `pages` (page_id, url, html); the written archives: (path, records, bytes)."""
    root, base = pafs.FileSystem.from_uri(folder)
    root.create_dir(base, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(folder)
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            path = f"{base}/{uuid.uuid4().hex}.warc.zst"
            with files.open_output_stream(f"{path}.part", compression=None) as out:
                write_archive(held, out)
            files.move(f"{path}.part", path)
            n = files.get_file_info(path).size
            row = {"path": [f"{folder}/{path.rpartition('/')[2]}"], "records": [len(held)], "bytes": [n]}
            held.clear()
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            names = ("page_id", "url", "payload", "response")
            for page, url, payload, response in zip(*(column(batch, c) for c in names), strict=True):
                page, response = page.as_py(), response.as_py()
                is_response = response is None or page == response
                held.append(record(page, url.as_py(), payload.as_py(), response, is_response))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return stage(with_response(pages).mapInArrow(run, "path string, records long, bytes long"), "warc-archives")


_RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def read(archives: DataFrame, payload: bool = False, batch_rows: int = 64) -> DataFrame:
    """The records of all archives on the list, an archive being a task's least work."""
    names = [part.split()[0] for part in _RECORD.split(", ")] + ["payload"] * payload
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({n: pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=False)})

        for batch in batches:
            for path in column(batch, "path").to_pylist():
                files, name = pafs.FileSystem.from_uri(path)
                rows: list[dict] = []
                with files.open_input_stream(name, compression=None) as source:
                    for raw in read_archive(source):
                        rows.append(parse(raw))
                        if not payload:
                            rows[-1]["payload"] = None
                        if len(rows) >= batch_rows:
                            yield out(rows)
                            rows = []
                if rows:
                    yield out(rows)

    count = archives.count()
    spread = archives.select("path").repartition(max(1, count))
    return spread.mapInArrow(run, _RECORD + ", payload binary" * payload)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive to the shared folder and read back."""
    path = scratch_path(spark, "warc")
    return read(write(pages, path if "://" in path else f"file://{path.removeprefix('file:')}"))
