"""Set-similarity self-join of documents on word n-grams, and its connected components.

Rare-first prefix filtering: a document's distinct n-grams are ordered by how
often they occur in the corpus, as counted in a mapped file of about a byte an
n-gram (n-grams that share a byte count as one; any order is right). Two sets of similarity t share an
n-gram among the first n - ceil(t * n) + 1 of either, so only these prefixes
meet. Then, in the task that holds one prefix n-gram,

* length filter: the smaller set has at least t times the size of the larger;
* positional filter: what lies after the two positions must suffice for the overlap;
* suffix filter: every set carries its counts over fixed ranges of the n-gram
  space; the sum of their differences is a lower bound of the symmetric
  difference, and pairs over the allowed one go.

A pair is looked at only at the first prefix n-gram that both share, hence once,
and is verified there on the two full sets.

Bounds at scale. A document's set stays in a mapped file of the shared folder, its prefix
first, and what is shuffled refers to it. Documents with equal sets are one class before anything is
joined, so exact copies cost one row. Prefix n-grams that occur in one class
only are dropped by a lookup before any shuffle. A frequent prefix n-gram is cut
into blocks of classes, and every pair of blocks is a group of its own of at
most 2 * BLOCK classes, whatever the n-gram's frequency. A group hands on a
spanning forest of its verified links, so fewer rows than it has classes, and a
pair that its links already connect is not verified. The first pass looks at each
class's few rarest shared n-grams, within blocks only; its links make components. The second pass takes every shared n-gram whose
classes are not all of one component, and looks at the pairs across components.
Together they connect exactly what all pairs would connect.

Defined cases: null or empty text has no n-gram, n_shingles 0, and links with
nothing. A row with a null id takes part in links, but is never the smallest id
(a component of such rows has a null id). Rows with a repeated id are links of
their own texts. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage, stage_result
from . import text as T
from .components import components
from .shared import (
    SHARD_BYTES,
    Shelf,
    Sorted,
    Store,
    count_keys,
    hash_edges,
    input_bytes,
    merged,
    new_folder,
    pointed,
    shard_bits,
    write_counts,
)

SKETCH_BITS = 20
RANGES = 64
BLOCK = 512
# Buckets of the sketch that a task counts before it hands them on.
_BUCKETS = 1 << 22
# Rarest shared prefix n-grams by which the first pass merges what is obviously alike.
FIRST = 2


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[np.ndarray]:
    """The distinct n-grams of every row."""
    found = T.words(T.column(batch, "text"), T.LOWER)
    grams, rows = T.shingles(found, n)
    bounds = np.searchsorted(rows, np.arange(batch.num_rows + 1))
    for at in range(batch.num_rows):
        yield np.unique(grams[bounds[at] : bounds[at + 1]])


def _fingerprint(grams: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None


class Sketch:
    """How often n-grams occur, by the top bits of their hash: a byte each, in one mapped file."""

    def __init__(self, path: str, bits: int):
        self.path, self.bits = path, bits
        self._counts: np.ndarray | None = None

    def __getstate__(self):
        return {**self.__dict__, "_counts": None}

    def counts(self, grams: np.ndarray) -> np.ndarray:
        if self._counts is None:
            self._counts = np.memmap(self.path, np.uint8, mode="r")
        return self._counts[grams >> np.uint64(64 - self.bits)]


def sketch(docs: DataFrame, n: int, size: int) -> Sketch:
    """Count the n-grams of all documents. The file has about a byte for each n-gram of the corpus."""
    bits = max(SKETCH_BITS, (size // 4).bit_length())
    parts = min(shard_bits(size), bits)
    path = f"{new_folder(docs.sparkSession, 'ngram-sketch')}/counts"
    with open(path, "wb") as out:
        out.truncate(1 << bits)
    top = np.uint64(64 - bits)

    def buckets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for part in T.slices(iter([batch]), "text"):
            yield from ((grams >> top) << top for grams in _sets(part, n))

    def fill(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        # A shard is a stretch of the file that no other task writes; writing it again changes nothing.
        first = key[0].as_py() << (bits - parts)
        keys, counts = merged(rows.column("blob").to_pylist())
        stretch = np.memmap(path, np.uint8, mode="r+", offset=first, shape=(1 << (bits - parts),))
        stretch[(keys >> top).astype(np.int64) - first] = np.minimum(counts, 255)
        stretch.flush()
        return pa.table({"n": pa.array([len(keys)], pa.int64())})

    # The more buckets are counted at a time, the closer they lie and the fewer bits tell them apart.
    blobs = count_keys(docs.select("text"), buckets, hash_edges(parts), most=_BUCKETS)
    blobs.groupBy("shard").applyInArrow(fill, "n long").agg(F.sum("n")).collect()
    return Sketch(path, bits)


def _taken(size: int, threshold: Fraction) -> int:
    """How many of its rarest n-grams a set is found by: any similar set shares one of them."""
    return size - math.ceil(threshold * size) + 1 if size else 0


def _rarest_first(grams: np.ndarray, often: Sketch) -> np.ndarray:
    """A set with its prefix, the rarest n-grams, before all others; ties by hash."""
    return grams[np.argsort(often.counts(grams), kind="stable")]


def profiles(docs: DataFrame, n: int, often: Sketch, store: Store) -> DataFrame:
    """Per document: its class (fingerprint of the set), and where its set is in `store`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelf = Shelf(store, pointed(doc_id=pa.int64(), cls=pa.binary()))
        for batch in T.slices(batches, "text"):
            ids = T.column(batch, "doc_id").cast(pa.int64()).to_pylist()
            for doc, grams in zip(ids, _sets(batch, n), strict=True):
                shelf.add((doc, _fingerprint(grams)), _rarest_first(grams, often) if len(grams) else grams)
            if shelf.full():
                yield shelf.out()
        yield shelf.out()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, cls binary, file long, start long, size int")


_PLACE = ("file", "start", "size")


def _prefixes(batch: pa.RecordBatch, store: Store, threshold: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """The prefixes of all rows one after another, and where each begins."""
    places = zip(*(T.column(batch, c).to_pylist() for c in _PLACE), strict=True)
    tokens = [store.get(file, start, _taken(size, threshold)) for file, start, size in places]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
    return np.concatenate([np.zeros(0, np.uint64), *tokens]), bounds


def across_components(classes: DataFrame, met: Sorted, store: Store, threshold: Fraction) -> DataFrame:
    """The shared prefix n-grams whose classes are of two components or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, bounds = _prefixes(batch, store, threshold)
            there = met.find_any(tokens)[0]
            row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))[there]
            yield pa.RecordBatch.from_pydict(
                {"token": pa.array(tokens[there].view(np.int64)), "component": T.column(batch, "component").take(pa.array(row))}
            )

    rows = classes.select(*_PLACE, "component").mapInArrow(run, "token long, component binary")
    ends = rows.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b"))
    return ends.where("a < b").select("token")


def postings(
    classes: DataFrame, met: Sorted, store: Store, threshold: Fraction, first: int | None = None, only: Sorted | None = None
) -> DataFrame:
    """A row per class and n-gram of its prefix that is in `met`, for each pair of blocks it is in.

    `first`: only so many, the rarest, and no pairs of blocks: a class is in one block each of two
    independent divisions, which connect classes that are all alike in two rows each. `only`: those
    that are in this set as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, bounds = _prefixes(batch, store, threshold)
            there, often = met.find_any(tokens)
            if only is not None:
                there &= only.find_any(tokens)[0]
            cls = T.column(batch, "cls").to_pylist()
            rows: dict[str, list] = {k: [] for k in ("row", "token", "a", "b", "side", "pos")}
            for at in range(batch.num_rows):
                own = slice(bounds[at], bounds[at + 1])
                where = np.flatnonzero(there[own])[:first]
                common = tokens[own][where].view(np.int64).tolist()
                for nth, pos in enumerate(where.tolist()):
                    blocks = -(-int(often[own][pos]) // BLOCK)
                    mine = int.from_bytes(cls[at][:4], "little") % blocks
                    if first is None:
                        places = [(min(mine, other), max(mine, other)) for other in range(blocks)]
                    else:
                        again = blocks + int.from_bytes(cls[at][4:8], "little") % blocks
                        places = [(mine, mine), (again, again)][: min(blocks, 2)]
                    for a, b in places:
                        rows["row"].append(at)
                        rows["token"].append(common[nth])
                        rows["a"].append(a)
                        rows["b"].append(b)
                        rows["side"].append(int(mine > a))
                        rows["pos"].append(pos)
            of = pa.array(rows.pop("row"), pa.int64())
            kept = {c: T.column(batch, c).take(of) for c in ("cls", *_PLACE, "component")}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64() if k == "token" else pa.int32()) for k, v in rows.items()} | kept)

    schema = "token long, a int, b int, side int, pos int, cls binary, file long, start long, size int, component binary"
    return classes.select("cls", *_PLACE, "component").mapInArrow(run, schema)


# Values of sets that are compared with one set at a time.
_AT_ONCE = 1 << 20


def _links(group: pa.Table, threshold: Fraction, store: Store) -> Iterator[tuple[int, int]]:
    """Of one group: verified links that connect what all its verified links would connect."""
    size = group.column("size").to_numpy().astype(np.int64)
    pos = group.column("pos").to_numpy().astype(np.int64)
    side = group.column("side").to_numpy()
    one_block = group.column("a")[0].as_py() == group.column("b")[0].as_py()
    places = list(zip(*(group.column(c).to_pylist() for c in _PLACE), strict=True))
    top = np.uint64(64 - RANGES.bit_length() + 1)
    # Most rows have no partner by size and position; sets are read when one has.
    sets: dict[int, np.ndarray] = {}
    before: dict[int, set[int]] = {}
    ranges = np.zeros((len(size), RANGES), np.int32)

    def read(rows: list[int]) -> None:
        for k in rows:
            if k not in sets:
                sets[k] = store.get(*places[k])
                before[k] = set(sets[k][: pos[k]].tolist())
                ranges[k] = np.bincount(sets[k] >> top, minlength=RANGES)

    # Rows of one label are connected.
    names: dict[bytes, int] = {}
    label = np.array([at if c is None else names.setdefault(c, at) for at, c in enumerate(group.column("component").to_pylist())])
    num, den = threshold.numerator, threshold.denominator
    for at in range(len(size) - 1):
        later = at + 1 + np.flatnonzero(label[at + 1 :] != label[at])
        if not one_block:
            later = later[side[later] != side[at]]
        small, large = np.minimum(size[at], size[later]), np.maximum(size[at], size[later])
        overlap = -(-num * (size[at] + size[later]) // (num + den))
        left = 1 + np.minimum(size[at] - pos[at] - 1, size[later] - pos[later] - 1)  # nothing before it is shared
        fits = (small * den >= large * num) & (left >= overlap)
        later, overlap = later[fits], overlap[fits]
        if not len(later):
            continue
        read([at, *later.tolist()])
        differ = np.abs(ranges[later] - ranges[at]).sum(axis=1)
        fits = differ <= size[at] + size[later] - 2 * overlap
        later, overlap = later[fits], overlap[fits]
        fits = [before[at].isdisjoint(before[k]) for k in later.tolist()]
        later, overlap = later[fits], overlap[fits]
        if not len(later):
            continue
        own = np.sort(sets[at])
        total = np.concatenate([[0], np.cumsum(size[later])])
        begin = 0
        while begin < len(later):
            upto = max(int(np.searchsorted(total, total[begin] + _AT_ONCE, side="right")) - 1, begin + 1)
            # What a part before has connected is left out.
            part = begin + np.flatnonzero(label[later[begin:upto]] != label[at])
            begin = upto
            if not len(part):
                continue
            values = np.concatenate([sets[k] for k in later[part].tolist()])
            found = np.minimum(np.searchsorted(own, values), len(own) - 1)
            both = np.add.reduceat((own[found] == values).astype(np.int64), np.cumsum(size[later[part]]) - size[later[part]])
            for k in later[part][both >= overlap[part]].tolist():
                if label[k] != label[at]:
                    label[label == label[k]] = label[at]
                    yield at, k


def links(posted: DataFrame, threshold: Fraction, store: Store) -> DataFrame:
    """Links (u, v) of similar classes: of each group a spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ("token", "a", "b")):
            if group.num_rows < 2:
                continue
            cls = group.column("cls").to_pylist()
            found = [sorted((cls[at], cls[k])) for at, k in _links(group, threshold, store)]
            if found:
                yield pa.RecordBatch.from_pydict({"u": pa.array([u for u, _ in found], pa.binary()), "v": pa.array([v for _, v in found], pa.binary())})

    keys = ["token", "a", "b"]
    return posted.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "u binary, v binary").distinct()


def groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Runs of equal integer keys in sorted batches; each run is of bounded size by construction."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([T.column(batch, k).to_numpy(zero_copy_only=False) for k in keys], axis=1)
        cuts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1).tolist(), len(values)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = values[a].tolist()
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def join_documents(docs: DataFrame, n: int = 5, threshold: float | Fraction = 0.8) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id (least doc_id reachable by links).

    `docs` needs doc_id (an integer) and text; words are runs of anything but
    ASCII white space, A-Z lower-cased. `threshold` is exact as a fraction.
    """
    return join_rows(docs, n, threshold).drop("cls")


def join_rows(docs: DataFrame, n: int = 5, threshold: float | Fraction = 0.8) -> DataFrame:
    """As `join_documents`, with the fingerprint of each row's n-grams, cls, which tells texts of one id apart."""
    exact = Fraction(str(threshold)) if isinstance(threshold, float) else Fraction(threshold)
    return stage_result(docs.sparkSession, "ngram-joined", lambda: _joined(docs, n, exact))


def _named(doc_id: int, cls: bytes) -> int:
    return xxhash.xxh3_64_intdigest(doc_id.to_bytes(8, "little", signed=True) + cls)


def without_later(docs: DataFrame, joined: DataFrame, n: int) -> DataFrame:
    """Rows of `docs` but those that `join_rows` linked with a smaller doc_id; rows without an id stay.

    Rows of one id are told apart by their n-grams. Which ids are concerned, and which n-grams of
    theirs, is looked up in arrays, so that no text is shuffled.
    """
    goes = joined.where("doc_id <> component_id").select("doc_id", "cls").distinct()

    def ids(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [T.mix(T.column(batch, "doc_id").to_numpy().view(np.uint64))]

    def rows(batch: pa.RecordBatch) -> list[np.ndarray]:
        pairs = zip(*(T.column(batch, c).to_pylist() for c in ("doc_id", "cls")), strict=True)
        return [np.array([_named(*pair) for pair in pairs], np.uint64)]

    # Eight bytes a row that goes.
    edges = hash_edges(shard_bits(input_bytes(docs) // 64))
    goes = stage(goes, "ngram-goes")
    gone_ids = write_counts(count_keys(goes, ids, edges), new_folder(docs.sparkSession, "ngram-gone-ids"), edges)
    gone = write_counts(count_keys(goes, rows, edges), new_folder(docs.sparkSession, "ngram-gone"), edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, "text"):
            named = T.column(batch, "doc_id").cast(pa.int64())
            known = gone_ids.find_any(T.mix(named.fill_null(0).to_numpy().view(np.uint64)))[0]
            there = np.flatnonzero(known & ~np.asarray(named.is_null()))
            stays = np.ones(batch.num_rows, bool)
            if len(there):
                own = batch.take(pa.array(there))
                hashed = [_named(i, _fingerprint(grams) or b"") for i, grams in zip(named.take(pa.array(there)).to_pylist(), _sets(own, n), strict=True)]
                stays[there] = ~gone.find_any(np.array(hashed, np.uint64))[0]
            yield batch.filter(pa.array(stays))

    return docs.mapInArrow(run, docs.schema)


def _joined(docs: DataFrame, n: int, threshold: Fraction) -> DataFrame:
    spark: SparkSession = docs.sparkSession
    docs = docs.select("doc_id", "text")
    size = input_bytes(docs)
    often = sketch(docs, n, size)
    store = Store(new_folder(spark, "ngram-arrays"))
    # Rows that refer to arrays are few bytes for much work, so the number of tasks is set by hand.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // SHARD_BYTES)
    profiled = stage(profiles(docs, n, often, store), "ngram-profiles")
    members = profiled.select("doc_id", "cls", F.col("size").cast("long").alias("n_shingles"))
    place = F.min(F.struct(*_PLACE)).alias("place")  # of any of the class: equal sets, equal order
    classes = stage(profiled.where("size > 0").groupBy("cls").agg(place).select("cls", "place.*"), "ngram-classes")
    edges = hash_edges(shard_bits(size // 4))
    prefixes = count_keys(classes.select(*_PLACE).repartition(tasks), lambda batch: [_prefixes(batch, store, threshold)[0]], edges)
    met = write_counts(prefixes, new_folder(spark, "ngram-prefixes"), edges, least=2)

    alone = classes.withColumn("component", F.lit(None).cast("binary")).repartition(tasks)
    first = stage(links(postings(alone, met, store, threshold, FIRST), threshold, store), "ngram-links")
    merged = stage(components(first), "ngram-merged").withColumnRenamed("node", "cls")
    known = classes.join(merged, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    known = stage(known, "ngram-known").repartition(tasks)
    across = across_components(known, met, store, threshold)
    open_ngrams = count_keys(across, lambda batch: [batch.column(0).to_numpy().view(np.uint64)], edges)
    still = write_counts(open_ngrams, new_folder(spark, "ngram-open"), edges)
    second = links(postings(known, met, store, threshold, only=still), threshold, store)
    whole = stage(components(first.unionAll(second)), "ngram-components").withColumnRenamed("node", "cls")
    grouped = members.join(whole, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    grouped = stage(grouped.select("doc_id", "n_shingles", "cls", "component"), "ngram-grouped")
    least = grouped.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = grouped.join(least, "component", "left")
    least_id = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return named.select("doc_id", "n_shingles", least_id.alias("component_id"), "cls")
