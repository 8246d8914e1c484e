"""Token ids of documents in files of length-delimited binary records.

A record is framed as readers of such files expect: eight bytes of length, the
masked CRC-32C of these, the payload, the masked CRC-32C of the payload. The
payload is a small header (bytes per id, flags, doc_id) and the ids, each in the
fewest bytes that hold the vocabulary. Beside every data file lies an index with
the place and length of each record, so that `read_shuffled` can fetch records
in any order without the files' being scanned.

Documents are dealt to files by ranges of (doc_id, hash of the text, row), so the
files in their order hold ascending doc_ids, and an id that a third of the rows
share is many ranges. A task encodes the rows of its range as they come, rolls
to a new file every `file_bytes`, and returns the list of its files; what lost or
repeated attempts wrote is on no list. Any folder that pyarrow can open will do.

A byte-level tokenizer that splits words never merges over a blank between two
characters that are no blanks, nor over some other places. Texts are cut there,
and a worker has the library encode what it has not met yet, in runs whose ids
are told apart by the leading blank; the rest is a lookup of two 64-bit hashes
of the piece (together 128 bits). Tokenizers of other kinds encode whole texts.

Defined cases: null text is empty, and an empty text is its end id. Rows without
a doc_id come first and read back as null. Equal doc_ids go by a hash of their
text; equal rows are a record each. A table without rows has no files. Extra
columns are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import BinaryIO, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..operators.ordering import running_total
from ..session import scratch_path, stage
from .text import PLAIN, buffer, column, hashes, slices

FILE_BYTES = 64 << 20
# What the writer holds before it frames it, and the reader fetches at a time.
PIECE_BYTES = 4 << 20
# Pieces of text whose ids a worker remembers.
CACHE_PIECES = 2_000_000
# Longer pieces are encoded as they come: the hashes are meant for short texts.
_LONGEST = 64
_SECOND = np.random.default_rng(0xB17E).integers(0, 1 << 63, 256, dtype=np.uint64)

_HEAD = np.dtype([("width", "<u2"), ("flags", "<u2"), ("doc_id", "<i8")])
_PLACE = np.dtype([("offset", "<u8"), ("length", "<u8")])
_NO_ID = 1
_FRAME_BYTES = 16  # of a record, beside its payload

# --- CRC-32C -------------------------------------------------------------------

# Fixed by the record format: the reversed polynomial, and the mask of a checksum.
_POLYNOMIAL = 0x82F63B78
_MASK = 0xA282EAD8
_BLOCK = 1024


@lru_cache(maxsize=1)
def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """What a byte adds to a checksum when k bytes follow (k < _BLOCK), and what _BLOCK zeros make of a checksum's bytes."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, value >> 1 ^ np.uint32(_POLYNOMIAL), value >> 1)
    step = value
    follow = np.empty((_BLOCK, 256), np.uint32)
    for k in range(_BLOCK):
        follow[k] = value
        value = step[value & 0xFF] ^ value >> 8
    state = np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
    for _ in range(_BLOCK):
        state = step[state & 0xFF] ^ state >> 8
    return follow, state


def crc32c(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32C of the slices data[start:end], each of four bytes or more.

    A checksum is linear in its bytes: each adds what `follow` says for its
    distance to the end of its block, blocks being counted from a slice's end.
    """
    follow, shift = _crc_tables()
    size = end - start
    blocks = -(-size // _BLOCK)
    first = np.concatenate([[0], np.cumsum(blocks)])
    out = np.zeros(first[-1], np.uint32)  # of each slice's blocks, the last one first
    rank = np.arange(first[-1]) - np.repeat(first[:-1], blocks)
    upto = np.repeat(end, blocks) - rank * _BLOCK
    begin = np.maximum(upto - _BLOCK, np.repeat(start, blocks))
    lengths = upto - begin
    at = 0
    while at < len(lengths):  # about a megabyte of blocks at a time
        to = min(len(lengths), at + 1024)
        own = lengths[at:to]
        heads = np.concatenate([[0], np.cumsum(own)[:-1]])
        inside = np.arange(own.sum()) - np.repeat(heads, own)
        place = np.repeat(begin[at:to], own) + inside
        head = place - np.repeat(np.repeat(start, blocks)[at:to], own) < 4  # the checksum starts from all ones
        byte = np.where(head, ~data[place], data[place])
        out[at:to] = np.bitwise_xor.reduceat(follow[np.repeat(own, own) - 1 - inside, byte], heads)
        at = to
    total = np.zeros(len(size), np.uint32)
    for k in range(int(blocks.max(initial=0)) - 1, -1, -1):
        has = np.flatnonzero(blocks > k)
        old = total[has]
        moved = shift[0, old & 0xFF] ^ shift[1, old >> 8 & 0xFF] ^ shift[2, old >> 16 & 0xFF] ^ shift[3, old >> 24]
        total[has] = moved ^ out[first[has] + k]
    return ~total


def masked(crc: np.ndarray) -> np.ndarray:
    return (crc >> np.uint32(15) | crc << np.uint32(17)) + np.uint32(_MASK)


# --- texts to ids ----------------------------------------------------------------


def _white(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space, Unicode's and the four information separators included."""
    white = np.zeros(256, bool)
    white[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
    out = white[data]
    if (data >= 0xC2).any():
        padded = np.concatenate([data, np.zeros(2, np.uint8)])
        second, third = padded[1:-1], padded[2:]
        two = (data == 0xC2) & ((second == 0x85) | (second == 0xA0))
        general = (third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF)
        three = (
            ((data == 0xE1) & (second == 0x9A) & (third == 0x80))
            | ((data == 0xE2) & (second == 0x80) & general)
            | ((data == 0xE2) & (second == 0x81) & (third == 0x9F))
            | ((data == 0xE3) & (second == 0x80) & (third == 0x80))
        )
        for at, size in ((np.flatnonzero(two), 2), (np.flatnonzero(three), 3)):
            for k in range(size):
                out[at + k] = True
    return out


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the rows may be cut without a change of their ids, the rows' starts included.

    Cut is before a blank, and before and after a line feed, between characters
    that are no white space; and between a Latin letter and a mark.
    """
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        solid = ~_white(data)
        between = solid[:-2] & solid[2:]
        middle = data[1:-1]
        cut[1 : n - 1] = between & ((middle == 0x20) | (middle == 0x0A))
        cut[2:n] |= between & (middle == 0x0A)
        letter = np.zeros(256, bool)
        letter[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
        accented = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        is_letter = letter[data]
        is_letter[1:] |= accented
        mark = np.zeros(256, bool)
        mark[list(b".,;:!?")] = True
        cut[1:n] |= is_letter[:-1] & mark[data[1:]]
    # A row's edge is not between characters of its own: what touches it counts only if it is a cut of the row itself.
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    for at in (edges, edges + 1, edges - 1):
        at = at[(at > 0) & (at < n)]
        blank = (data[at] == 0x20) | (data[at] == 0x0A) | (data[at - 1] == 0x0A)
        cut[at[blank]] = False
    cut[offsets[:-1][offsets[:-1] < n]] = True
    cut[n] = False
    return np.flatnonzero(cut)


class Encoder:
    """Ids of texts as little-endian integers of `width` bytes, with an end id.

    Pieces up to _LONGEST bytes are remembered under two 64-bit hashes.
    """

    def __init__(self, path: str, end_id: int = 0):
        self.tokenizer = Tokenizer.from_file(path)
        ids = self.tokenizer.get_vocab(with_added_tokens=True)
        self.kind = np.dtype("<u2" if max([end_id, *ids.values()]) < 1 << 16 else "<u4")
        self.end_id = end_id
        kind = json.loads(self.tokenizer.to_str())
        before = kind["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        marked = any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in kind["added_tokens"])
        usual = kind["normalizer"] is None and kind["model"]["type"] == "BPE" and kind["model"]["dropout"] is None
        # A cut must not part what an added token's text would be found in.
        whole = not any(len(piece_starts(*buffer(pa.array([t["content"]])))) > 1 for t in kind["added_tokens"])
        self.cuts = bool(plain and usual and whole and not marked)
        self.leads = np.zeros(max(ids.values()) + 1, bool)
        self.leads[[n for token, n in ids.items() if token.startswith("Ġ")]] = True
        self._forget()

    def _forget(self) -> None:
        self.keys = self.checks = np.zeros(0, np.uint64)
        self.first = self.count = np.zeros(0, np.int64)
        self.pool = np.zeros(0, self.kind)

    def _each(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one after the other, and how many each has."""
        runs = np.array([p[:1] == b" " and p.count(b" ") == 1 for p in pieces], bool)
        lone = np.flatnonzero(~runs)
        out: list[np.ndarray | None] = [None] * len(pieces)
        for at, own in zip(lone.tolist(), self._each([pieces[i].decode() for i in lone]), strict=True):
            out[at] = own
        places = np.flatnonzero(runs)
        for a in range(0, len(places), 4096):
            part = places[a : a + 4096].tolist()
            texts = [pieces[i] for i in part]
            # Of each of these, only the first token begins with a blank.
            (ids,) = self._each([b"".join(texts).decode()])
            heads = np.flatnonzero(self.leads[ids])
            told = len(heads) == len(part) and heads[0] == 0
            split = np.split(ids, heads[1:]) if told else self._each([t.decode() for t in texts])
            for at, own in zip(part, split, strict=True):
                out[at] = own
        return np.concatenate([np.zeros(0, self.kind), *out]), np.array([len(x) for x in out], np.int64)

    def _learn(self, keys: np.ndarray, checks: np.ndarray, pieces: list[bytes]) -> None:
        """Remember pieces under their hashes (sorted, and not known)."""
        if len(self.keys) + len(keys) > CACHE_PIECES:
            self._forget()
        ids, count = self._ids(pieces)
        at = np.searchsorted(self.keys, keys)
        first = np.cumsum(count) - count + len(self.pool)
        self.keys, self.checks = np.insert(self.keys, at, keys), np.insert(self.checks, at, checks)
        self.first, self.count = np.insert(self.first, at, first), np.insert(self.count, at, count)
        self.pool = np.concatenate([self.pool, ids])

    def _places(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        known = (self.keys[at] == keys) & (self.checks[at] == checks) if len(self.keys) else np.zeros(len(keys), bool)
        return at, known

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        if not self.cuts:
            each = [np.append(x, self.kind.type(self.end_id)) for x in self._each([t or "" for t in texts.to_pylist()])]
            return np.concatenate([np.zeros(0, self.kind), *each]), np.array([len(x) for x in each], np.int64)
        data, offsets = buffer(texts)
        start = piece_starts(data, offsets)
        end = np.append(start[1:], len(data)) if len(start) else start
        row = np.searchsorted(offsets, start, side="right") - 1
        keys = hashes(data, start, end, PLAIN.value)
        checks = hashes(data, start, end, _SECOND)
        short = np.flatnonzero(end - start <= _LONGEST)
        unique, at, back = np.unique(keys[short], return_index=True, return_inverse=True)
        at = short[at]
        clash = checks[at][back] != checks[short]  # pieces that only share the first hash
        place, known = self._places(unique, checks[at])
        taken = np.isin(unique, self.keys[place[~known]]) if len(self.keys) else np.zeros(len(unique), bool)
        new = np.flatnonzero(~known & ~taken)
        raw = data.tobytes()
        self._learn(unique[new], checks[at[new]], [raw[a:b] for a, b in zip(start[at[new]].tolist(), end[at[new]].tolist(), strict=True)])
        if len(self.keys) == len(new):  # the others were forgotten
            rest = np.flatnonzero(known)
            if len(rest):
                self._learn(unique[rest], checks[at[rest]], [raw[a:b] for a, b in zip(start[at[rest]].tolist(), end[at[rest]].tolist(), strict=True)])
        place, known = self._places(unique, checks[at])
        usable = known[back] & ~clash
        first, count = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        first[short], count[short] = self.first[place[back]], self.count[place[back]]
        other = np.concatenate([np.flatnonzero(end - start > _LONGEST), short[~usable]])
        ids, own = self._ids([raw[a:b] for a, b in zip(start[other].tolist(), end[other].tolist(), strict=True)])
        pool = np.concatenate([self.pool, ids, np.array([self.end_id], self.kind)]) if len(ids) else self.pool
        first[other], count[other] = np.cumsum(own) - own + len(self.pool), own
        out_count = np.bincount(row, count, len(texts)).astype(np.int64) + 1
        upto = np.cumsum(out_count)
        out = np.full(upto[-1] if len(upto) else 0, self.end_id, self.kind)
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        out[np.arange(len(inside)) + np.repeat(row, count)] = pool[np.repeat(first, count) + inside]
        return out, out_count


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> Encoder:
    """One per worker, so that what it has met serves its next tasks too."""
    return Encoder(path, end_id)


# --- records ---------------------------------------------------------------------


def framed(doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Records of documents, one after the other, and the length of each payload."""
    heads = np.zeros(len(counts), _HEAD)
    heads["width"] = ids.itemsize
    heads["flags"] = np.where(doc_ids.is_null().to_numpy(zero_copy_only=False), _NO_ID, 0)
    heads["doc_id"] = doc_ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
    lengths = (_HEAD.itemsize + counts * ids.itemsize).astype("<u8")
    sizes = lengths.astype(np.int64)
    upto = np.cumsum(sizes + _FRAME_BYTES)
    at = upto - sizes - _FRAME_BYTES
    body = counts * ids.itemsize
    out = np.empty(upto[-1] if len(upto) else 0, np.uint8)
    out[at[:, None] + np.arange(8)] = lengths.view(np.uint8).reshape(-1, 8)
    out[at[:, None] + np.arange(12, 12 + _HEAD.itemsize)] = heads.view(np.uint8).reshape(-1, _HEAD.itemsize)
    inside = np.arange(body.sum()) + np.repeat(at + 12 + _HEAD.itemsize - (np.cumsum(body) - body), body)
    out[inside] = ids.view(np.uint8)
    for start, end in ((at, at + 8), (at + 12, at + 12 + sizes)):
        out[end[:, None] + np.arange(4)] = masked(crc32c(out, start, end)).astype("<u4").view(np.uint8).reshape(-1, 4)
    return out, lengths


class Record(NamedTuple):
    doc_id: int | None
    ids: np.ndarray


def payloads(buffer: np.ndarray, begin: np.ndarray, lengths: np.ndarray, name: str) -> Iterator[Record]:
    """Records whose frames start at `begin`; both checksums of each must hold."""
    begin, sizes = begin.astype(np.int64), lengths.astype(np.int64)
    for start, end in ((begin, begin + 8), (begin + 12, begin + 12 + sizes)):
        stored = np.ascontiguousarray(buffer[end[:, None] + np.arange(4)]).view("<u4")[:, 0]
        bad = np.flatnonzero(masked(crc32c(buffer, start, end)) != stored)
        if len(bad):
            raise ValueError(f"{name}: record at byte {begin[bad[0]]} of the piece is damaged")
    for b, size in zip(begin.tolist(), sizes.tolist(), strict=True):
        raw = buffer[b + 12 : b + 12 + size].tobytes()
        head = np.frombuffer(raw, _HEAD, 1)[0]
        ids = np.frombuffer(raw, f"<u{head['width']}", offset=_HEAD.itemsize)
        yield Record(None if head["flags"] & _NO_ID else int(head["doc_id"]), ids)


def read_file(source: BinaryIO, name: str) -> Iterator[Record]:
    """The records of a data file in order; holds one piece, or one record if that is longer."""
    rest = b""
    while piece := source.read(PIECE_BYTES):
        rest += piece
        at, begin, lengths = 0, [], []
        while at + 12 <= len(rest):
            length = int.from_bytes(rest[at : at + 8], "little")
            if at + _FRAME_BYTES + length > len(rest):
                # A damaged length must not make the reader take in the whole file.
                if length > PIECE_BYTES:
                    head = np.frombuffer(rest, np.uint8, 12, at)
                    if masked(crc32c(head, np.array([0]), np.array([8])))[0] != int.from_bytes(rest[at + 8 : at + 12], "little"):
                        raise ValueError(f"{name}: damaged length")
                    rest += source.read(at + _FRAME_BYTES + length - len(rest))
                    if at + _FRAME_BYTES + length > len(rest):
                        raise ValueError(f"{name}: ends within a record")
                else:
                    break
            begin.append(at)
            lengths.append(length)
            at += _FRAME_BYTES + length
        yield from payloads(np.frombuffer(rest, np.uint8), np.array(begin, np.int64), np.array(lengths, np.int64), name)
        rest = rest[at:]
    if rest:
        raise ValueError(f"{name}: ends within a record")


# --- jobs ------------------------------------------------------------------------

_FILES = "path string, part long, number long, records long, tokens long, bytes long"


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write every row of `docs` (doc_id, text); the files: path, place in their order, records, tokens, bytes."""
    root, base = pafs.FileSystem.from_uri(folder)
    root.create_dir(base, recursive=True)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id())
    keyed = rows.withColumns({"__hash": order[1], "__row": order[2]})
    ranges = keyed.repartitionByRange(order[0], F.col("__hash"), F.col("__row"))
    sorted_rows = ranges.sortWithinPartitions(order[0], F.col("__hash"), F.col("__row")).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(folder)
        part, number = TaskContext.get().partitionId(), 0
        encode = encoder(tokenizer, end_id)
        out = None

        def close() -> pa.RecordBatch:
            nonlocal out, number
            out.close()
            with files.open_output_stream(f"{path}.index", compression=None) as index:
                all_places = np.concatenate(places)
                index.write(all_places.tobytes())
            row = [f"{folder}/{path.rpartition('/')[2]}", part, number, len(all_places), tokens, size]
            out, number = None, number + 1
            return pa.RecordBatch.from_pydict({n.split()[0]: [v] for n, v in zip(_FILES.split(", "), row, strict=True)})

        for batch in slices(batches, "text", min(PIECE_BYTES, file_bytes)):
            ids, counts = encode.encode(column(batch, "text"))
            data, lengths = framed(column(batch, "doc_id"), ids, counts)
            if out is None:
                path = f"{base}/part-{part:06d}-{number:04d}-{uuid.uuid4().hex}.records"
                out, places, size, tokens = files.open_output_stream(path, compression=None), [], 0, 0
            place = np.empty(len(lengths), _PLACE)
            sizes = lengths + np.uint64(_FRAME_BYTES)
            place["offset"], place["length"] = np.cumsum(sizes) - sizes + np.uint64(size), lengths
            places.append(place)
            out.write(memoryview(data))
            size += len(data)
            tokens += len(ids)
            if size >= file_bytes:
                yield close()
        if out is not None:
            yield close()

    return stage(sorted_rows.mapInArrow(run, _FILES), "token-files")


def with_start(files: DataFrame) -> DataFrame:
    """Add `start`: the ids in all files before this one."""
    one = files.withColumns({"__all": F.lit(0), "__at": F.col("part") * (1 << 20) + F.col("number")})
    upto = running_total(one, ["__all"], F.col("tokens"), "__upto", order=F.col("__at"))
    return upto.withColumn("start", F.col("__upto") - F.col("tokens")).select(*files.columns, "start")


_ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _row(record: Record, start: int, ids: bool) -> tuple:
    row = (record.doc_id, start, len(record.ids), zlib.crc32(record.ids.astype("<u4").tobytes()))
    return (*row, record.ids.astype(np.int32)) if ids else row


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))]
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_pydict({n: pa.array(list(c), k) for (n, k), c in zip(kinds, columns, strict=False)})


def _spread(df: DataFrame, rows: int) -> DataFrame:
    return df.repartition(max(1, rows))


def read(files: DataFrame, ids: bool = False, batch_rows: int = 512) -> DataFrame:
    """Every record of the listed files: doc_id, start, n_tokens, the CRC-32 of its ids, and on request the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(column(batch, "path").to_pylist(), column(batch, "start").to_pylist(), strict=True):
                source_files, name = pafs.FileSystem.from_uri(path)
                rows: list[tuple] = []
                with source_files.open_input_stream(name, compression=None) as source:
                    for record in read_file(source, path):
                        rows.append(_row(record, start, ids))
                        start += len(record.ids)
                        if len(rows) >= batch_rows:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    listed = stage(with_start(files).select("path", "start"), "token-starts")
    return _spread(listed, files.count()).mapInArrow(run, _ROWS + ", ids array<int>" * ids)


def index(files: DataFrame) -> DataFrame:
    """Place of every record: path, offset, length of its payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in column(batch, "path").to_pylist():
                source_files, name = pafs.FileSystem.from_uri(path)
                with source_files.open_input_stream(f"{name}.index", compression=None) as source:
                    while raw := source.read(_PLACE.itemsize << 16):
                        place = np.frombuffer(raw, _PLACE)
                        columns = {n: pa.array(np.ascontiguousarray(place[n]).astype(np.int64)) for n in ("offset", "length")}
                        yield pa.RecordBatch.from_pydict({"path": pa.array([path] * len(place)), **columns})

    return _spread(files.select("path"), files.count()).mapInArrow(run, "path string, offset long, length long")


def read_shuffled(files: DataFrame, seed: int, epoch: int = 0) -> DataFrame:
    """Every record once, in an order drawn from seed and epoch: `draw`, doc_id, n_tokens, ids.

    Places are dealt to tasks by ranges of `draw` and fetched one by one; within
    a task, and from task to task, `draw` ascends.
    """
    draw = F.xxhash64(F.lit(seed), F.lit(epoch), F.col("path"), F.col("offset"))
    places = index(files).withColumn("draw", draw)
    dealt = places.repartitionByRange("draw").sortWithinPartitions("draw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            names = ("path", "offset", "length", "draw")
            for path, offset, length, drawn in zip(*(column(batch, c).to_pylist() for c in names), strict=True):
                source_files, name = pafs.FileSystem.from_uri(path)
                with source_files.open_input_file(name) as source:
                    raw = np.frombuffer(source.read_at(length + _FRAME_BYTES, offset), np.uint8)
                (record,) = payloads(raw, np.array([0]), np.array([length]), path)
                rows.append({"draw": drawn, "doc_id": record.doc_id, "n_tokens": len(record.ids), "ids": record.ids.astype(np.int32)})
            if rows:
                kinds = {"draw": pa.int64(), "doc_id": pa.int64(), "n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
                yield pa.RecordBatch.from_pydict({n: pa.array([r[n] for r in rows], k) for n, k in kinds.items()})

    return dealt.mapInArrow(run, "draw long, doc_id long, n_tokens long, ids array<int>")


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write to the shared folder and read back."""
    path = scratch_path(spark, "token-records")
    return read(write(docs, path if "://" in path else f"file://{path.removeprefix('file:')}", tokenizer, end_id))
