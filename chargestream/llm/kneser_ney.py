"""Interpolated modified Kneser-Ney bigram model, counted in Spark and scored from mapped arrays.

Training, each step one shuffle of counted blobs of sorted values:

1. Tokens to a vocabulary of sorted hashes; a token's id is its place in it.
2. Bigrams as one 64-bit key, context id and token id. Shards are ranges of
   keys. A context that is followed by more than a shard's worth of tokens is cut
   into several ranges, so no word, however common, is one task's. A shard keeps
   keys and counts and, per context, the total and how many tokens follow it
   once, twice, and more often (for the cut contexts these are added up, at most
   a few per shard).
3. Continuation counts: in how many contexts a token was seen.

The shards are files in the shared folder. A scoring task maps them and looks
up the sorted distinct bigrams of a slice of texts, so its memory does not grow
with the model; nothing of it passes through the driver but counts of counts.

    p(w | c) = max(n(c, w) - D(n), 0) / n(c) + (D1 N1 + D2 N2 + D3 N3+) / n(c) * p(w)
    p(w)     = max(a(w) - D'(a), 0) / A + (D1' M1 + D2' M2 + D3' M3+) / A / (V + 1)

with a(w) the continuation count, A their sum, V the distinct tokens (one unknown
token beside them), and an unseen context c giving p(w). A text begins in a
context of its own and ends with one end token.

Defined cases: null and empty texts are one end token. A row without an id
belongs to the training rows of the query. No training rows: every token has probability 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import text as T
from .shared import BLOBS, SHARD_BYTES, Sorted, count_keys, hash_edges, input_bytes, load, merged, new_folder, save

END = np.uint64(0x9E3779B97F4A7C15)

class Model(NamedTuple):
    folder: str
    offsets: np.ndarray  # first token id of each vocabulary shard, and the number of tokens
    edges: np.ndarray  # first bigram key of each bigram shard
    tokens: int  # N
    discounts: tuple[float, float, float]
    low_discounts: tuple[float, float, float]
    low_total: int  # A
    low_rest: float  # mass left to the uniform distribution
    split: dict[int, tuple[int, int, int, int]]  # contexts over several shards: total, N1, N2, N3+

    @property
    def types(self) -> int:
        return int(self.offsets[-1])


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and row of all tokens, and which of them begin a text."""
    found = T.words(T.column(batch, "text"), T.LOWER)
    rows = batch.num_rows
    at = found.bounds()[1:]
    hashes = np.insert(found.hash, at, END)
    row = np.insert(found.row, at, np.arange(rows))
    first = np.zeros(len(row), bool)
    first[np.concatenate([[0], np.cumsum(found.counts + 1)[:-1]])[:rows]] = True
    return hashes, row, first


def _blobs(docs: DataFrame, keys: Callable[[pa.RecordBatch], np.ndarray], edges: np.ndarray) -> DataFrame:
    """Blobs per shard of `keys` of the texts."""

    def sliced(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        return (keys(part) for part in T.slices(iter([batch]), "text"))

    return count_keys(docs.select("text"), sliced, edges)


def _count_of_counts(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts; where the counts cannot give one, half a count less each."""
    out = []
    for k in (1, 2, 3):
        if n[0] and n[k - 1] and n[k] and n[0] + 2 * n[1]:
            d = k - (k + 1) * n[0] / (n[0] + 2 * n[1]) * n[k] / n[k - 1]
        else:
            d = k / 2
        out.append(min(max(d, 0.0), float(k)))
    return tuple(out)


def _discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *d])[np.minimum(counts, 3)], 0.0)


class _Lookup:
    """The arrays of a model, opened by a task when it needs them."""

    def __init__(self, folder: str, offsets: np.ndarray, edges: np.ndarray):
        self.words = Sorted(folder, edges, "count", name="word", offsets=offsets)
        self.folder, self.offsets = folder, offsets
        self._open: dict[str, np.ndarray] = {}

    def array(self, name: str) -> np.ndarray:
        if name not in self._open:
            self._open[name] = load(f"{self.folder}/{name}.npy")
        return self._open[name]

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids (-1: unknown) and counts."""
        unique, back = np.unique(hashes, return_inverse=True)
        return self.words.ids(unique)[back], self.words.find(unique)[1][back]


def train(docs: DataFrame, shards: int | None = None) -> Model:
    """Learn from all rows of `docs` (column text)."""
    spark = docs.sparkSession
    folder = new_folder(spark, "kneser-ney")
    count = shards or max(8, input_bytes(docs) // SHARD_BYTES)
    bits = max(3, (count - 1).bit_length())
    hashed = hash_edges(bits)

    def vocabulary(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        keys, counts = merged(rows.column("blob").to_pylist())
        save(f"{folder}/word.{shard}.npy", keys)
        save(f"{folder}/count.{shard}.npy", counts)
        # A context that fills a shard of bigrams is at least half of its own shard here.
        heavy = np.flatnonzero(counts * 8 >= counts.sum())
        return pa.table(
            {
                "shard": pa.array([shard], pa.int32()),
                "types": pa.array([len(keys)], pa.int64()),
                "tokens": pa.array([int(counts.sum())], pa.int64()),
                "heavy": pa.array([[{"at": int(h), "n": int(counts[h])} for h in heavy]], pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))),
            }
        )

    made = _blobs(docs, lambda batch: _tokens(batch)[0], hashed).groupBy("shard")
    schema = "shard int, types long, tokens long, heavy array<struct<at:long,n:long>>"
    sizes = {row.shard: row for row in made.applyInArrow(vocabulary, schema).collect()}  # a row per shard
    types = [sizes[s].types if s in sizes else 0 for s in range(1 << bits)]
    offsets = np.concatenate([[0], np.cumsum(types)]).astype(np.int64)
    n_types, n_tokens = int(offsets[-1]), sum(row.tokens for row in sizes.values())
    if n_types + 1 >= 1 << 32:
        raise ValueError("more than 2**32 distinct tokens: ids no longer fit a key")
    heavy = [(int(offsets[s]) + h["at"], h["n"]) for s, row in sizes.items() for h in row.heavy]
    edges = _bigram_edges(n_types, n_tokens, 1 << bits, heavy)
    lookup = _Lookup(folder, offsets, hashed)

    def bigrams(batch: pa.RecordBatch) -> np.ndarray:
        return _bigram_keys(*_contexts(batch, lookup, n_types)[:2])

    cut = np.unique((edges[(edges & np.uint64(0xFFFF_FFFF)) != 0] >> np.uint64(32)).astype(np.int64))

    def count_bigrams(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        keys, counts = merged(rows.column("blob").to_pylist())
        save(f"{folder}/bigram.{shard}.npy", keys)
        save(f"{folder}/times.{shard}.npy", counts.astype(np.uint32) if counts.max(initial=0) < 1 << 32 else counts)
        context, first = np.unique(keys >> np.uint64(32), return_index=True)
        stats = np.stack(
            [np.add.reduceat(x, first) for x in (counts, counts == 1, counts == 2, counts >= 3)], axis=1
        ).astype(np.int64)
        split = np.isin(context.astype(np.int64), cut)
        save(f"{folder}/context.{shard}.npy", context[~split] << np.uint64(32))
        save(f"{folder}/follow.{shard}.npy", stats[~split])
        token, times = np.unique(keys & np.uint64(0xFFFF_FFFF), return_counts=True)
        out = [(-1, np.array(_count_of_counts(counts), np.int64).tobytes())]
        out += [(-2, np.array([c, *s], np.int64).tobytes()) for c, s in zip(context[split].tolist(), stats[split].tolist(), strict=True)]
        places = np.searchsorted(token.astype(np.int64), offsets)
        for part in range(len(offsets) - 1):
            where = slice(int(places[part]), int(places[part + 1]))
            if where.stop > where.start:
                out.append((part, token[where].astype(np.uint32).tobytes() + times[where].astype(np.uint32).tobytes()))
        return pa.table({"shard": pa.array([o[0] for o in out], pa.int32()), "blob": pa.array([o[1] for o in out], pa.binary())})

    counted = _blobs(docs, bigrams, edges).groupBy("shard").applyInArrow(count_bigrams, BLOBS)
    counted = stage(counted, "kneser-ney-continuations")
    of_counts, split = [0] * 4, {}
    for row in counted.where("shard < 0").collect():  # a few per shard
        values = np.frombuffer(row.blob, np.int64).tolist()
        if row.shard == -1:
            of_counts = [a + b for a, b in zip(of_counts, values, strict=True)]
        else:
            old = split.get(values[0], (0, 0, 0, 0))
            split[values[0]] = tuple(a + b for a, b in zip(old, values[1:], strict=True))

    def continuations(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        low = int(offsets[shard])
        seen = np.zeros(int(offsets[shard + 1]) - low, np.int64)
        for blob in rows.column("blob").to_pylist():
            n = len(blob) // 8
            seen[np.frombuffer(blob, np.uint32, n).astype(np.int64) - low] += np.frombuffer(blob, np.uint32, n, 4 * n)
        save(f"{folder}/seen.{shard}.npy", seen)
        more = [int((seen == 1).sum()), int((seen == 2).sum()), int((seen >= 3).sum())]
        values = [*_count_of_counts(seen), int(seen.sum()), *more]
        return pa.table({"values": pa.array([values], pa.list_(pa.int64()))})

    low = counted.where("shard >= 0").groupBy("shard").applyInArrow(continuations, "values array<long>")
    total = [sum(x) for x in zip(*(row["values"] for row in low.collect()), strict=True)] or [0] * 8
    low_discounts = _discounts(total[:4])
    rest = sum(d * m for d, m in zip(low_discounts, total[5:], strict=True)) / total[4] if total[4] else 1.0
    return Model(folder, offsets, edges, n_tokens, _discounts(of_counts), low_discounts, total[4], rest, split)


def _bigram_edges(types: int, tokens: int, shards: int, heavy: list[tuple[int, int]]) -> np.ndarray:
    """Where bigram shards begin: even ranges of contexts, a heavy context being ranges of its own."""
    edges = {(types + 1) * s // shards << 32 for s in range(shards)}
    for context, n in heavy:
        pieces = -(-n * shards // max(tokens, 1))
        if pieces > 1:
            edges |= {(context << 32) + types * p // pieces for p in range(pieces)} | {(context + 1) << 32}
    return np.array(sorted(edges), np.uint64)


def _contexts(batch: pa.RecordBatch, lookup: _Lookup, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Context id and token id (-1: unknown) of every token, its row, and its count in training."""
    hashes, row, first = _tokens(batch)
    ids, counts = lookup.ids(hashes)
    context = np.empty_like(ids)
    context[1:] = ids[:-1]
    context[first] = begin
    return context, ids, row, counts


def _bigram_keys(context: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return (context.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64)


def _probabilities(model: Model, lookup: _Lookup, bigrams: Sorted, follow: Sorted, keys: np.ndarray) -> np.ndarray:
    """For distinct sorted bigram keys, both ids known or the token unknown (low half all ones)."""
    token = (keys & np.uint64(0xFFFF_FFFF)).astype(np.int64)
    context = (keys >> np.uint64(32)).astype(np.int64)
    known = token != 0xFFFF_FFFF
    seen = np.zeros(len(keys), np.int64)
    order = np.flatnonzero(known)
    order = order[np.argsort(token[order], kind="stable")]
    cuts = np.searchsorted(token[order], model.offsets)
    for shard in range(len(model.offsets) - 1):
        where = order[cuts[shard] : cuts[shard + 1]]
        if len(where):
            seen[where] = lookup.array(f"seen.{shard}")[token[where] - int(model.offsets[shard])]
    low = np.full(len(keys), model.low_rest / (model.types + 1))
    if model.low_total:
        low += _discounted(seen, model.low_discounts) / model.low_total
    _, times = bigrams.find(keys)
    total, n1, n2, n3 = _follow(model, follow, context)
    d1, d2, d3 = model.discounts
    with np.errstate(divide="ignore", invalid="ignore"):
        high = _discounted(times, model.discounts) / total + (d1 * n1 + d2 * n2 + d3 * n3) / total * low
    return np.where(total > 0, high, low)


def _follow(model: Model, follow: Sorted, context: np.ndarray) -> np.ndarray:
    """(total, N1, N2, N3+) of sorted contexts; zeros for one never seen."""
    unique, back = np.unique(context, return_inverse=True)
    out = np.zeros((4, len(unique)), np.int64)
    for _, where, arrays, at, hit in follow.places(unique.astype(np.uint64) << np.uint64(32)):
        out[:, where] = np.where(hit, np.asarray(arrays[1][at]).T, 0)
    for c, stats in model.split.items():
        at = int(np.searchsorted(unique, c))
        if at < len(unique) and unique[at] == c:
            out[:, at] = stats
    return out[:, back]


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: `keep`, n_tokens, n_known, base_score (add-one unigrams) and score, both log10."""
    from pyspark.sql.types import StructType

    wanted = list(dict.fromkeys([*keep, "text"]))
    fields = [docs.schema[c] for c in keep]
    schema = StructType([*fields, *StructType.fromDDL("n_tokens long, n_known long, base_score double, score double")])
    bits = (len(model.offsets) - 2).bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(model.folder, model.offsets, hash_edges(bits))
        bigrams = Sorted(model.folder, model.edges, "times", name="bigram")
        follow = Sorted(model.folder, model.edges, "follow", name="context")
        for batch in T.slices(batches, "text"):
            rows = batch.num_rows
            if not rows:
                continue
            context, ids, row, counts = _contexts(batch, lookup, model.types)
            # An unknown context was never seen either: give it an id beyond all.
            keys = _bigram_keys(np.where(context < 0, model.types + 1, context), np.where(ids < 0, 0xFFFF_FFFF, ids))
            unique, back = np.unique(keys, return_inverse=True)
            logs = np.log10(_probabilities(model, lookup, bigrams, follow, unique))[back]
            base = np.log10((counts + 1) / (model.tokens + model.types + 1))
            columns = {c: T.column(batch, c) for c in keep}
            columns["n_tokens"] = pa.array(np.bincount(row, minlength=rows), pa.int64())
            columns["n_known"] = pa.array(np.bincount(row[counts > 0], minlength=rows), pa.int64())
            columns["base_score"] = pa.array(np.bincount(row, base, rows))
            columns["score"] = pa.array(np.bincount(row, logs, rows))
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(*wanted).mapInArrow(run, schema)


def perplexity(score: Column, n_tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -score / n_tokens)

