"""Sorted hash arrays in the shared folder, memory-mapped by the tasks that look values up.

Arrays are cut into shards by the top bits of the hash, so that one task builds
one shard and a lookup touches few pages. The folder of `spark.checkpoint.dir`
has to be mounted on the workers (NFS, Lustre, a FUSE mount), because a task
maps the files; other folders are refused.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Bytes of input that one shard stands for.
SHARD_BYTES = 4 << 20


def set_aside(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`docs` with every column but the text under a name that no operator adds, and what gives the names back."""
    own = {name: name if name == "text" else f"__own_{at}" for at, name in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{name}`").alias(aside) for name, aside in own.items()])
    return renamed, lambda df: df.select(*[F.col(aside).alias(name) for name, aside in own.items()])


def mounted(path: str) -> str:
    """A shared path as the operating system names it."""
    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"{path}: arrays are memory-mapped, so spark.checkpoint.dir must be a mounted folder")
    return unquote(parsed.path)


def new_folder(spark: SparkSession, name: str) -> str:
    path = mounted(scratch_path(spark, name))
    os.makedirs(path)
    return path


def input_bytes(docs: DataFrame) -> int:
    """Size of a table of texts: that of its files where the optimiser knows it, else of its texts."""
    known = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if known < 1 << 56:
        return known
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def shard_bits(size: int, least: int = 3) -> int:
    return max(least, (size // SHARD_BYTES).bit_length())


def save(path: str, array: np.ndarray) -> None:
    """Written aside and then renamed, so that a repeated task does no harm."""
    aside = f"{path}.{uuid.uuid4().hex}"
    with open(aside, "wb") as out:
        np.save(out, array)
    os.replace(aside, path)


def load(path: str) -> np.ndarray:
    return np.load(path, mmap_mode="r") if os.path.getsize(path) > 128 else np.load(path)


def hash_edges(bits: int) -> np.ndarray:
    """First value of each of 2**bits shards of 64-bit hashes."""
    return np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)


def split_by_shard(keys: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Sorted keys, as (shard, where); shard i begins at edges[i]."""
    cuts = [*np.searchsorted(keys, edges).tolist(), len(keys)]
    for shard, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if a < b:
            yield shard, slice(a, b)


class Sorted:
    """Lookups in a folder's sorted arrays `<name>.<shard>.npy`, and in arrays beside them.

    `offsets` are the places of the shards' first keys in the whole sequence.
    """

    def __init__(self, folder: str, edges: np.ndarray, *beside: str, name: str = "key", offsets: np.ndarray | None = None):
        self.folder, self.edges, self.names, self.offsets = folder, edges, (name, *beside), offsets
        self._open: dict[int, tuple[np.ndarray, ...] | None] = {}

    def __getstate__(self):
        return {**self.__dict__, "_open": {}}

    def shards(self, keys: np.ndarray) -> Iterator[tuple[int, slice]]:
        return split_by_shard(keys, self.edges)

    def open(self, shard: int) -> tuple[np.ndarray, ...] | None:
        """The arrays of a shard, mapped; none if it is empty."""
        if shard not in self._open:
            files = [f"{self.folder}/{name}.{shard}.npy" for name in self.names]
            arrays = tuple(map(load, files)) if os.path.exists(files[0]) else None
            self._open[shard] = arrays if arrays and len(arrays[0]) else None
        return self._open[shard]

    def places(self, keys: np.ndarray) -> Iterator[tuple[int, slice, tuple[np.ndarray, ...], np.ndarray, np.ndarray]]:
        """Per shard of sorted keys: shard, where, its arrays, each key's place in it, and whether it is there."""
        for shard, where in self.shards(keys):
            arrays = self.open(shard)
            if arrays is not None:
                own = keys[where].astype(arrays[0].dtype)
                at = np.searchsorted(arrays[0], own)
                at[at == len(arrays[0])] = 0
                yield shard, where, arrays, at, arrays[0][at] == own

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, ...]:
        """For sorted keys: whether each is there, and the values beside it (0 if not)."""
        there = np.zeros(len(keys), bool)
        values = [np.zeros(len(keys), np.int64) for _ in self.names[1:]]
        for _, where, arrays, at, hit in self.places(keys):
            there[where] = hit
            for value, array in zip(values, arrays[1:], strict=True):
                value[where] = np.where(hit, array[at], 0)
        return (there, *values)

    def find_any(self, keys: np.ndarray) -> tuple[np.ndarray, ...]:
        """As `find`, for keys in any order and with repeats."""
        unique, back = np.unique(keys, return_inverse=True)
        return tuple(x[back] for x in self.find(unique))

    def ids(self, keys: np.ndarray) -> np.ndarray:
        """For sorted keys: the place of each in the whole sequence, -1 if it is not there."""
        out = np.full(len(keys), -1, np.int64)
        for shard, where, _, at, hit in self.places(keys):
            out[where] = np.where(hit, at + int(self.offsets[shard]), -1)
        return out


# --- arrays of single rows: rows that are shuffled refer to them ---------------


class Store:
    """Arrays of 64-bit values in mapped files; an array is (file, start, size).

    A file has a new name each time, and the rows that a committed task returns
    are what refers to it, so files of lost or repeated tasks are never read.
    """

    def __init__(self, folder: str):
        self.folder = folder
        self._open: dict[int, np.ndarray] = {}

    def __getstate__(self):
        return {"folder": self.folder, "_open": {}}

    def path(self, file: int) -> str:
        return f"{self.folder}/values.{file:016x}.npy"

    def get(self, file: int, start: int, size: int) -> np.ndarray:
        if file not in self._open:
            if len(self._open) >= 512:  # open files, not data
                self._open.clear()
            self._open[file] = load(self.path(file))
        return np.asarray(self._open[file][start : start + size])


class Shelf:
    """What one task puts into a store: rows are handed on when the file they refer to is written."""

    def __init__(self, store: Store, schema: pa.Schema):
        self.store, self.schema = store, schema
        self._rows: list[tuple] = []
        self._held: list[np.ndarray] = []
        self._size = self._files = 0

    def add(self, row: tuple, values: np.ndarray) -> None:
        self._rows.append((*row, self._size, len(values)))
        self._held.append(values)
        self._size += len(values)

    def full(self) -> bool:
        return self._size >= _HELD or len(self._rows) >= 1 << 14

    def out(self) -> pa.RecordBatch:
        """The rows so far: their columns, then file, start and size."""
        # No two attempts of any task of a session have one number, and small numbers shuffle well.
        file = (TaskContext.get().taskAttemptId() << 20) + self._files
        self._files += 1
        save(self.store.path(file), np.concatenate([np.zeros(0, np.uint64), *self._held]))
        columns = list(zip(*self._rows, strict=True)) or [()] * (len(self.schema) - 1)
        columns.insert(-2, (file,) * len(self._rows))
        arrays = [pa.array(list(c), f.type) for c, f in zip(columns, self.schema, strict=True)]
        self._rows, self._held, self._size = [], [], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def pointed(**columns: pa.DataType) -> pa.Schema:
    """Schema of a shelf's rows with these columns of their own."""
    place = {"file": pa.int64(), "start": pa.int64(), "size": pa.int32()}
    return pa.schema(list((columns | place).items()))


# --- counted blobs: how tasks hand sorted, counted keys to the shards ---------

BLOBS = "shard int, blob binary"
# Keys a task counts before it hands them on.
_HELD = 1 << 20


# Bytes of a key's difference and of its count.
_PLANES = (8, 4)


def packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, without the zero bits at the end of all of them; bytes of equal weight together.

    Each weight is compressed by itself, as its bytes have their own distribution; one that is zero throughout takes no room.
    """
    steps = np.diff(keys, prepend=np.uint64(0))
    every = int(np.bitwise_or.reduce(steps)) if len(steps) else 0
    zeros = (every & -every).bit_length() - 1 if every else 0
    planes = [
        plane
        for values, size in zip((steps >> np.uint64(zeros), counts.astype(np.uint32)), _PLANES, strict=True)
        for plane in np.ascontiguousarray(values.view(np.uint8).reshape(-1, size).T)
    ]
    compressor = zstandard.ZstdCompressor(level=1)
    blobs = [compressor.compress(plane.tobytes()) if plane.any() else b"" for plane in planes]
    return np.array([len(keys), zeros, *map(len, blobs)], np.uint32).tobytes() + b"".join(blobs)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, zeros, *sizes = np.frombuffer(blob, np.uint32, 2 + sum(_PLANES)).tolist()
    planes = np.zeros((len(sizes), n), np.uint8)
    decompressor = zstandard.ZstdDecompressor()
    at = 4 * (2 + len(sizes))
    for plane, size in zip(planes, sizes, strict=True):
        if size:
            plane[:] = np.frombuffer(decompressor.decompress(blob[at : at + size]), np.uint8)
        at += size
    steps = np.ascontiguousarray(planes[: _PLANES[0]].T).view(np.uint64).reshape(-1) << np.uint64(zeros)
    counts = np.ascontiguousarray(planes[_PLANES[0] :].T).view(np.uint32).reshape(-1)
    return np.cumsum(steps, dtype=np.uint64), counts


def merged(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several blobs, sorted, with the sums of their counts."""
    if not blobs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, counts = (np.concatenate(x) for x in zip(*map(unpacked, blobs), strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def counted_blobs(chunks: list[np.ndarray], edges: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Keys of one task, counted, as one blob per shard."""
    if chunks:
        keys, counts = np.unique(np.concatenate(chunks), return_counts=True)
        for shard, where in split_by_shard(keys, edges):
            yield shard, packed(keys[where], counts[where])


def count_keys(df: DataFrame, keys: Callable[[pa.RecordBatch], Iterable[np.ndarray]], edges: np.ndarray, most: int = _HELD) -> DataFrame:
    """Blobs per shard of the 64-bit keys that `keys(batch)` yields, counted within the task first, about `most` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            rows = list(counted_blobs(held, edges))
            held.clear()
            return pa.RecordBatch.from_pydict(
                {"shard": pa.array([s for s, _ in rows], pa.int32()), "blob": pa.array([b for _, b in rows], pa.binary())}
            )

        size = 0
        for batch in batches:
            for own in keys(batch):
                held.append(own)
                size += len(own)
                if size >= most:
                    yield out()
                    size = 0
        yield out()

    return df.mapInArrow(run, BLOBS)


def write_counts(blobs: DataFrame, folder: str, edges: np.ndarray, least: int = 1) -> Sorted:
    """Merge blobs by shard into `key` and `count`, keeping keys counted `least` times or more."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        keys, counts = merged(rows.column("blob").to_pylist())
        kept = counts >= least
        save(f"{folder}/count.{shard}.npy", counts[kept])
        save(f"{folder}/key.{shard}.npy", keys[kept])
        return pa.table({"n": pa.array([int(kept.sum())], pa.int64())})

    blobs.groupBy("shard").applyInArrow(run, "n long").agg(F.sum("n")).collect()
    return Sorted(folder, edges, "count")
