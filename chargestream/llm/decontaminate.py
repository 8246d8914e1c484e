"""Removal of benchmark text from training documents.

The benchmark's windows of ten normalised words become a hash set that is
broadcast; every task scans the windows of its documents against it and
compares the words of each hit. An item of fewer words is one window of its own
length.

The hash set is broadcast in blocks of at most `block_bytes` of window text
(the size is measured before anything is collected). A benchmark of several
blocks adds one scan step a block to the same pass over the documents, so no
broadcast ever exceeds the bound and no document is shuffled.

Defined cases: null text has no words. An item without words has no window; an
item without an id still marks words, but is listed nowhere. Items with the same
id are one item. Repeated document rows each give a row. Extra columns are
ignored, or kept by `remove`.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import text as T
from .shared import set_aside

WINDOW = 10
BLOCK_BYTES = 16 << 20

_FOLD = bytes(
    ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256)
)
_SPAN = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
_FOUND = "n_words long, spans array<struct<first:long,last:long,start:long,end:long>>, items array<string>"


class Block(NamedTuple):
    """Windows of the benchmark by their length: sorted hashes, and what each stands for."""

    hashes: dict[int, np.ndarray]
    windows: dict[int, list[list[tuple[bytes, list[str]]]]]


def _normal(data: np.ndarray) -> bytes:
    return b" ".join(data.tobytes().translate(_FOLD).split())


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, size, hash, words) of every window of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, "text"):
            ids = T.column(batch, "item_id").cast(pa.string()).to_pylist()
            found = T.words(T.column(batch, "text"), T.ALNUM)
            bounds = found.bounds()
            rows = []
            for at in range(batch.num_rows):
                n = int(found.counts[at])
                size = min(n, window)
                for first in range(bounds[at], bounds[at + 1] - size + 1 if n else bounds[at]):
                    words = _normal(found.data[found.start[first] : found.end[first + size - 1]])
                    rows.append((ids[at], size, words))
            yield pa.RecordBatch.from_pydict(
                {
                    "item": pa.array([r[0] for r in rows], pa.string()),
                    "size": pa.array([r[1] for r in rows], pa.int32()),
                    "words": pa.array([r[2] for r in rows], pa.binary()),
                }
            )

    return benchmark.select("item_id", "text").mapInArrow(run, "item string, size int, words binary").distinct()


def _block(rows: list) -> Block:
    by_size: dict[int, dict[bytes, list[str]]] = {}
    for row in rows:
        items = by_size.setdefault(row["size"], {}).setdefault(bytes(row["words"]), [])
        if row["item"] is not None:
            items.append(row["item"])
    hashes, meaning = {}, {}
    for size, known in by_size.items():
        texts = list(known)
        found = T.words(pa.array(texts, pa.binary()), T.ALNUM)
        grams, _ = T.ngrams(found, size)
        unique, back = np.unique(grams, return_inverse=True)
        slots: list[list] = [[] for _ in unique]
        for at, words in zip(back.tolist(), texts, strict=True):
            slots[at].append((words, known[words]))
        hashes[size], meaning[size] = unique, slots
    return Block(hashes, meaning)


def blocks(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The benchmark's windows in parts of about `block_bytes`."""
    rows = windows(benchmark, window)
    size = rows.agg(F.sum(F.octet_length("words") + 64)).first()[0] or 0
    count = -(-size // block_bytes) or 1
    for part in range(count):
        own = rows if count == 1 else rows.where(F.pmod(F.xxhash64("words"), F.lit(count)) == part)
        yield _block(own.collect())


def _hits(found: T.Words, block: Block) -> Iterator[tuple[int, int, list[str]]]:
    """(first word, size, items) of every verified window."""
    for size, known in block.hashes.items():
        grams, _ = T.ngrams(found, size)
        if not len(grams):
            continue
        # A small table of low bits turns nearly all windows away before the search.
        seen = np.zeros(1 << 20, bool)
        seen[known & np.uint64((1 << 20) - 1)] = True
        maybe = np.flatnonzero(seen[grams & np.uint64((1 << 20) - 1)])
        at = np.searchsorted(known, grams[maybe])
        at[at == len(known)] = 0
        right = known[at] == grams[maybe]
        size_ok = found.row[: len(found.row) - size + 1] == found.row[size - 1 :]
        place = np.flatnonzero(size_ok)[maybe[right]]
        for first, slot in zip(place.tolist(), at[right].tolist(), strict=True):
            words = _normal(found.data[found.start[first] : found.end[first + size - 1]])
            for text, items in block.windows[size][slot]:
                if text == words:
                    yield first, size, items


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of `docs`: the columns `keep`, n_words, hit spans (words and bytes), and the items found, sorted."""
    spark = docs.sparkSession
    wanted = list(dict.fromkeys([*keep, "text"]))
    base = docs.select(*wanted)
    added = StructType.fromDDL(_FOUND)
    state = base.withColumns({f.name: F.lit(None).cast(f.dataType) for f in added})
    schema = StructType([*base.schema.fields, *added.fields])
    for block in blocks(benchmark, window, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in T.slices(batches, "text"):
                found = T.words(T.column(batch, "text"), T.ALNUM)
                size = len(found.hash)
                bounds = found.bounds()
                edge = np.zeros(size + 1, np.int64)
                items = [set(x or ()) for x in T.column(batch, "items").to_pylist()]
                for at, old in enumerate(T.column(batch, "spans").to_pylist()):
                    for span in old or ():
                        edge[bounds[at] + span["first"]] += 1
                        edge[bounds[at] + span["last"]] -= 1
                for first, length, named in _hits(found, shared.value):
                    edge[first] += 1
                    edge[first + length] -= 1
                    items[found.row[first]].update(named)
                hit = np.cumsum(edge[:size]) > 0
                spans: list[list[dict]] = [[] for _ in items]
                marked = np.flatnonzero(hit)
                if len(marked):
                    new = np.concatenate([[True], (np.diff(marked) > 1) | (np.diff(found.row[marked]) > 0)])
                    firsts = marked[new]
                    lasts = marked[np.concatenate([new[1:], [True]])] + 1
                    for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True):
                        row = int(found.row[a])
                        spans[row].append(
                            {
                                "first": a - int(bounds[row]),
                                "last": b - int(bounds[row]),
                                "start": int(found.start[a] - found.offsets[row]),
                                "end": int(found.end[b - 1] - found.offsets[row]),
                            }
                        )
                columns = {c: T.column(batch, c) for c in wanted}
                columns["n_words"] = pa.array(found.counts, pa.int64())
                columns["spans"] = pa.array(spans, pa.list_(_SPAN))
                columns["items"] = pa.array([sorted(x) for x in items], pa.list_(pa.string()))
                yield pa.RecordBatch.from_pydict(columns)

        state = state.mapInArrow(run, schema)
    return state.select(*keep, "n_words", "spans", "items")


def digest(found: DataFrame) -> DataFrame:
    """Counts and a digest of what `find` returns."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return (
        found.withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def remove(docs: DataFrame, benchmark: DataFrame, spans: bool = False, **options) -> DataFrame:
    """`docs` without its contaminated rows; with `spans`, all rows, without the words that were hit."""
    named, back = set_aside(docs)
    found = find(named, benchmark, keep=tuple(named.columns), **options)
    if not spans:
        return back(found.where(F.size("spans") == 0))
    raw = F.col("text").cast("binary")
    edges = F.concat(F.array(F.lit(0).cast("long")), F.col("spans.end"))
    starts = F.concat(F.col("spans.start"), F.array(F.octet_length("text").cast("long")))
    kept = F.transform(
        F.arrays_zip(edges.alias("a"), starts.alias("b")),
        lambda p: F.substring(raw, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")),
    )
    # Adding the pieces up is exact on bytes; a span begins and ends with whole characters.
    cleaned = F.aggregate(kept, F.lit(b""), lambda x, y: F.concat(x, y)).cast("string")
    return back(found.withColumn("text", F.when(F.size("spans") > 0, cleaned).otherwise(F.col("text"))))
