"""Words of whole Arrow columns as 64-bit hashes, without a Python object per word.

A word's hash is a polynomial over its bytes modulo 2**64, taken from one
running sum over the column's buffer and then mixed. Equal words always have
equal hashes. Two different words collide with a chance of about 2**-64, which
over n distinct words is n * n / 2**65; operators whose result must not depend
on that compare the bytes as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# One slice of a batch is worked on at a time. A longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x5851F42D4C957F2D)
_ODD = np.random.default_rng(0x5EED).integers(0, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


class Alphabet(NamedTuple):
    """Which bytes part words, and the value of the others."""

    parts: np.ndarray
    value: np.ndarray


def alphabet(separators: bytes, lower: bool) -> Alphabet:
    value = np.arange(256, dtype=np.uint64)
    if lower:
        value[65:91] += np.uint64(32)
    parts = np.zeros(256, dtype=bool)
    parts[list(separators)] = True
    return Alphabet(parts, value + np.uint64(1))


WHITE = b" \t\n\x0b\x0c\r"
PLAIN = alphabet(WHITE, lower=False)
LOWER = alphabet(WHITE, lower=True)
# Runs of a-z, 0-9 and everything outside ASCII; A-Z count as a-z.
ALNUM = alphabet(bytes(b for b in range(128) if not chr(b).isalnum()), lower=True)
LINES = alphabet(b"\n", lower=False)


class Words(NamedTuple):
    """Of a column with `rows` rows: per word its hash, row, and place in `data`."""

    hash: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    counts: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def bounds(self) -> np.ndarray:
        """Where each row's words begin; one more entry than rows."""
        return np.concatenate([[0], np.cumsum(self.counts)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE, dtype=np.uint64)
    up[0] = 1
    down = np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64)), dtype=np.uint64)
    down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text or binary column; null counts as empty."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0 or column.null_count == n:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    buffers = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(column: pa.Array, of: Alphabet, hashed: bool = True) -> Words:
    """`hashed`: else the words come without their hashes, which cost as much as all else."""
    data, offsets = buffer(column)
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), none, none, none, np.zeros(len(offsets) - 1, np.int64), data, offsets)
    inside = ~of.parts[data]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[begins] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[-1] = False
    after[begins[begins > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    counts = np.bincount(row, minlength=len(offsets) - 1)
    return Words(hashes(data, start, end, of.value) if hashed else np.zeros(0, np.uint64), row, start, end, counts, data, offsets)


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Hash of each slice data[start:end] under a value per byte."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        base = start[at]
        upto = max(int(np.searchsorted(end, base + SLICE_BYTES, side="right")), at + 1)
        size = int(end[upto - 1] - base)
        up, down = _powers(max(SLICE_BYTES, 1 << size.bit_length()))
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(value[data[base : base + size]] * up[:size], out=total[1:])
        s, e = start[at:upto] - base, end[at:upto] - base
        out[at:upto] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        at = upto
    return out


def ngrams(found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of n words inside a row, in order."""
    size = len(found.hash) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole = found.row[:size] == found.row[n - 1 :]
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total += found.hash[k : k + size] * _ODD[k]
    return mix(total[whole] + np.uint64(n)), found.row[:size][whole]


def whole_rows(found: Words, rows: np.ndarray) -> np.ndarray:
    """One hash for the whole word sequence of each of the (short) rows."""
    bounds = found.bounds()
    total = np.zeros(len(rows), np.uint64)
    for at, row in enumerate(rows):
        own = found.hash[bounds[row] : bounds[row + 1]]
        total[at] = np.sum(own * _ODD[: len(own)], dtype=np.uint64) + np.uint64(len(own))
    return mix(total)


def shingles(found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n-word shingles per row; a row with 1 to n - 1 words has one, its whole sequence."""
    grams, rows = ngrams(found, n)
    short = np.flatnonzero((found.counts > 0) & (found.counts < n))
    if not len(short):
        return grams, rows
    grams = np.concatenate([grams, whole_rows(found, short)])
    rows = np.concatenate([rows, short])
    order = np.argsort(rows, kind="stable")
    return grams[order], rows[order]


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `size` bytes of text, one row at least."""
    for batch in batches:
        _, offsets = buffer(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            upto = max(int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1, at + 1)
            upto = min(upto, batch.num_rows)
            yield batch.slice(at, upto - at)
            at = upto


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
