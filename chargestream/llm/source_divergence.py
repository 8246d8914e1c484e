"""How far the sources of a language use its terms alike: an audit over frequent terms.

A language keeps the terms that occur in at least `least` of its documents. They
are found by refining prefixes: the documents are counted that have a term with
a given prefix of 3 bytes, then of 6, and last each complete term. A
prefix in fewer than `least` documents has no frequent term behind it, so terms
with such a prefix are left out of all later levels. What survives a level goes
to the next as a bit map of hashed prefixes, of fixed size whatever the corpus
(no survivor is ever missed; a term that passes by accident is counted in full
and then discarded, as its own documents are fewer still).

Every level is one scan: a task counts the prefixes or terms of a few megabytes of
documents, each document once, and Spark adds the sums up by key, first within the
task. Texts are never shuffled; a source with a third of all rows is as many
partial sums as it has tasks. Within these megabytes, and there only, terms are
told apart by 64-bit hashes.

Every group (language, source) and every language gives each kept term the share
p = 1 + floor(10^9 (count + 1) / (N + V)). Two shares differ by
f = floor((p - q)^2 / q). Part `pair` sums f over all kept terms for each other
source of the language, part `term` ranks the terms that a group uses more than
its language does. A term that one source of a pair lacks has a share there that
only depends on the source. So each source's terms are added up once per distinct
share, as if the other source had none of them, and tasks that go through the terms
add what differs where both have one. No row per term and pair is ever made.
Amounts beyond 64 bits are decimals.

Defined cases: null text, language or source is ''. Rows are documents, repeated
or not. A language without kept terms has pairs of value 0 and no terms. A source
without terms, or the only one of its language, has a group, but no rows if it
has no other source and no terms. Ties rank by the item's UTF-8 bytes. An empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .text import alphabet, column, hashes, mix, slices, words

LEVELS = (3, 6)
LEAST = 3
TOP = 200
SCALE = 10**9
# Bits of the map of surviving prefixes: 8 MiB.
MAP_BITS = 26
# Text that is counted at a time, and pairs of sources that are compared at a time.
_TEXT_BYTES = 4 << 20
_PAIRS = 1 << 19

TERMS = alphabet(bytes(b for b in range(128) if not chr(b).isalpha()), lower=True)
_LOWER = np.array([b + 32 if 65 <= b < 91 else b for b in range(256)], np.uint8)
_WHOLE = "decimal(38,0)"


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])


# --- frequent terms by their prefixes ------------------------------------------------


def _seeds(*names: pa.Array) -> np.ndarray:
    """A 64-bit number per row for the names it has."""
    out = np.zeros(len(names[0]), np.uint64)
    for name in names:
        coded = name.dictionary_encode()
        known = [hash_of(str(v).encode()) for v in coded.dictionary.to_pylist()]
        out = mix(out + np.array(known, np.uint64)[coded.indices.to_numpy()])
    return out


def hash_of(name: bytes) -> int:
    data = np.frombuffer(b"-" + name, np.uint8)
    return int(hashes(data, np.array([0]), np.array([len(data)]), np.arange(1, 257, dtype=np.uint64))[0])


def _prefixes(data: np.ndarray, start: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """A number per term for its first `length` bytes; up to 8, equal for equal ones only, as no byte of a term is 0."""
    if length > 8:
        return hashes(data, start, np.minimum(end, start + length), TERMS.value)
    padded = np.concatenate([_LOWER[data], np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    size = np.minimum(end - start, length).astype(np.uint64)
    return mix(eight[start] & (np.uint64(0xFFFF_FFFF_FFFF_FFFF) >> (np.uint64(64) - np.uint64(8) * size)))


def _order(values: np.ndarray) -> np.ndarray:
    """A stable order of 64-bit hashes: by their upper bits with the place below, as whole numbers sort faster than places do."""
    place = np.arange(len(values), dtype=np.uint64)
    bits = np.uint64(len(values).bit_length())
    order = (np.sort(values >> bits << bits | place) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    ordered = values[order]
    # Different hashes with equal upper bits are rare.
    return np.argsort(values, kind="stable") if (ordered[1:] < ordered[:-1]).any() else order


def _bit(prefix: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Place of a language's prefix in the map."""
    return (mix(prefix ^ lang) >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _survives(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `size` bytes of text, one row at least."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in slices(batches, "text", size):
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def _cut_out(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """data[start:end] of all slices as a binary column."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    inside = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(_LOWER[data[inside]])]
    return pa.Array.from_buffers(pa.binary(), len(size), buffers)


def level_counts(docs: DataFrame, length: int | None, before: int | None, bits: np.ndarray | None) -> DataFrame:
    """Documents and occurrences by prefix of `length` bytes (None: by complete term, and by source), in partial sums.

    Only terms count whose prefix of `before` bytes is in `bits`. A shorter term
    is its own prefix.
    """
    shared = None if bits is None else docs.sparkSession.sparkContext.broadcast(bits)
    by = ("lang", "source") if length is None else ("lang",)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, _TEXT_BYTES):
            found = words(column(batch, "text"), TERMS, hashed=False)
            row, start, end = found.row, found.start, found.end
            lang = _seeds(column(batch, "lang"))
            group = _seeds(*(column(batch, name) for name in by))
            if shared is not None:
                kept = np.flatnonzero(_survives(shared.value, _bit(_prefixes(found.data, start, end, before), lang[row])))
                row, start, end = row[kept], start[kept], end[kept]
            if not len(row):
                continue
            if length is None:
                key = hashes(found.data, start, end, TERMS.value)
            else:
                key = _prefixes(found.data, start, end, length)
                end = np.minimum(end, start + length)
            # Equal terms of a group together, document by document.
            joint = mix(key ^ group[row])
            order = _order(joint)
            joint, of = joint[order], row[order]
            new = np.concatenate([[True], joint[1:] != joint[:-1]])
            first = np.flatnonzero(new)
            new[1:] |= of[1:] != of[:-1]
            at = order[first]
            names = {name: column(batch, name).take(pa.array(row[at])) for name in by}
            yield pa.RecordBatch.from_pydict(
                {
                    **names,
                    "item": _cut_out(found.data, start[at], end[at]),
                    **({} if length is None else {"bit": pa.array(_bit(key[at], lang[row[at]]).astype(np.int32))}),
                    "documents": pa.array(np.add.reduceat(new.astype(np.int64), first)),
                    "occurrences": pa.array(np.diff(np.append(first, len(joint)))),
                }
            )

    schema = ", ".join(f"{name} string" for name in by)
    bit = "" if length is None else "bit int, "
    return docs.mapInArrow(run, f"{schema}, item binary, {bit}documents long, occurrences long")


def survivors(sums: DataFrame, least: int) -> DataFrame:
    """Prefixes in at least `least` documents of their language: lang, item, bit, documents."""
    added = sums.groupBy("lang", "item").agg(F.max("bit").alias("bit"), F.sum("documents").alias("documents"))
    return added.where(F.col("documents") >= least)


def bit_map(kept: DataFrame) -> np.ndarray:
    """The map of surviving prefixes; at most 2**(MAP_BITS - 6) words come to the driver, whatever the corpus."""
    value = F.expr("shiftleft(1L, bit & 63)")
    rows = kept.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(value).alias("value")).toArrow()
    bits = np.zeros(1 << MAP_BITS - 6, np.uint64)
    bits[rows.column("word").to_numpy()] = rows.column("value").to_numpy().view(np.uint64)
    return bits


def frequent(named: DataFrame, least: int = LEAST, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """The kept terms: lang, item, documents, and `uses`, the sources that have it with their occurrences.

    A term's uses are at most as many as its language has sources.
    """
    before, bits = None, None
    for length in levels:
        bits = bit_map(survivors(level_counts(named, length, before, bits), least))
        before = length
    sums = level_counts(named, None, before, bits).groupBy("lang", "source", "item")
    by_source = sums.agg(F.sum("documents").alias("documents"), F.sum("occurrences").alias("occurrences"))
    uses = F.collect_list(F.struct("source", "occurrences")).alias("uses")
    terms = by_source.groupBy("lang", "item").agg(F.sum("documents").alias("documents"), uses)
    return terms.where(F.col("documents") >= least).withColumn("item", F.col("item").cast("string"))


# --- shares and how far they are apart -------------------------------------------------


def _share(count: Column, total: Column, terms: Column) -> Column:
    """p of a term: exact, in whole decimals."""
    over = F.lit(SCALE).cast("decimal(10,0)") * (count.cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)"))
    under = total.cast("decimal(20,0)") + terms.cast("decimal(19,0)")
    return (F.call_function("div", over.cast(_WHOLE), under.cast(_WHOLE)) + 1).cast("long")


def _apart(p: Column, q: Column) -> Column:
    """f of two shares, of which neither exceeds 10^9 + 1."""
    return F.call_function("div", (p - q) * (p - q), q)


def sources_of(named: DataFrame, terms: DataFrame) -> DataFrame:
    """Every occurring group: its number in its language, V and N of the language, its own terms and N, the share of a term it lacks."""
    languages = terms.groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum(F.aggregate("uses", F.lit(0).cast(_WHOLE), lambda n, use: (n + use["occurrences"]).cast(_WHOLE))).alias("lang_n")
    )
    used = terms.select("lang", F.explode("uses").alias("use"))
    own = used.groupBy("lang", F.col("use.source").alias("source")).agg(
        F.count(F.lit(1)).alias("own_terms"), F.sum("use.occurrences").alias("n")
    )
    groups = named.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(languages, "lang", "left")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    filled = groups.withColumns({name: F.coalesce(name, F.lit(0)) for name in ("own_terms", "n", "v", "lang_n")})
    lacking = F.when(F.col("v") > 0, _share(F.lit(0), F.col("n"), F.col("v"))).otherwise(F.lit(1).cast("long"))
    return filled.withColumns({"number": number, "lacking": lacking})


def shares(terms: DataFrame, sources: DataFrame) -> DataFrame:
    """Per kept term: `q`, its language's share, and per source that has it its number, name, share and share of a term it lacks."""
    used = terms.select("lang", "item", F.explode("uses").alias("use"))
    used = used.select("lang", "item", F.col("use.source").alias("source"), F.col("use.occurrences").alias("occurrences"))
    joined = used.join(sources, ["lang", "source"])
    p = _share(F.col("occurrences"), F.col("n"), F.col("v")).alias("p")
    one = F.struct("number", p, "lacking", "source")
    grouped = joined.groupBy("lang", "item").agg(
        F.collect_list(one).alias("uses"), F.sum("occurrences").alias("total"), F.first("lang_n").alias("lang_n"), F.first("v").alias("v")
    )
    return grouped.select("lang", "item", _share(F.col("total"), F.col("lang_n"), F.col("v")).alias("q"), "uses")


def _both(lang: np.ndarray, uses: np.ndarray, number: np.ndarray, p: np.ndarray, lacking: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Sums over terms by language and two sources that both have it: what the pair's f adds to that of terms it lacks.

    `uses` says how many of the other arrays' entries each term has. Sums come as
    high and low parts of 32 bits, and how many terms there were.
    """
    begin = np.repeat(np.cumsum(uses) - uses, uses)
    size = np.repeat(uses, uses)
    lang = np.repeat(lang, uses)
    upto = np.cumsum(size)
    at = 0
    while at < len(size):
        # Entries whose pairs fit; an entry has at most as many as its language has sources.
        to = max(at + 1, int(np.searchsorted(upto, upto[at] - size[at] + _PAIRS, side="right")))
        own = size[at:to]
        a = np.repeat(np.arange(at, to), own)
        b = np.repeat(begin[at:to] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        apart = a != b
        a, b = a[apart], b[apart]
        f = [(x - y) * (x - y) // y for x, y in ((p[a], p[b]), (p[a], lacking[b]), (lacking[a], p[b]), (lacking[a], lacking[b]))]
        cells = np.lexsort((number[b], number[a], lang[a]))
        a, b = a[cells], b[cells]
        if len(cells):
            names = np.stack([lang[a], number[a], number[b]])
            first = np.flatnonzero(np.concatenate([[True], (names[:, 1:] != names[:, :-1]).any(0)]))
            parts = [x[cells] for x in f]
            high = sum(np.add.reduceat(x >> 32, first) * sign for x, sign in zip(parts, (1, -1, -1, 1), strict=True))
            low = sum(np.add.reduceat(x & 0xFFFFFFFF, first) * sign for x, sign in zip(parts, (1, -1, -1, 1), strict=True))
            count = np.diff(np.append(first, len(cells)))
            yield (*names[:, first], high, low, count)
        at = to


def pair_sums(used: DataFrame) -> DataFrame:
    """What terms add that both sources of a pair have: lang, number, other, high, low, both; partial sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = column(batch, "lang").dictionary_encode()
            column_uses = column(batch, "uses")
            count = column_uses.value_lengths().to_numpy().astype(np.int64)
            entries = column_uses.flatten()
            number, p, lacking = (entries.field(name).to_numpy().astype(np.int64) for name in ("number", "p", "lacking"))
            for lang, a, b, high, low, both in _both(langs.indices.to_numpy().astype(np.int64), count, number, p, lacking):
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": langs.dictionary.take(pa.array(lang)),
                        "number": pa.array(a.astype(np.int32)),
                        "other": pa.array(b.astype(np.int32)),
                        "high": pa.array(high),
                        "low": pa.array(low),
                        "both": pa.array(both),
                    }
                )

    narrow = used.select("lang", F.transform("uses", lambda use: F.struct(use["number"].alias("number"), use["p"].alias("p"), use["lacking"].alias("lacking"))).alias("uses"))
    return narrow.mapInArrow(run, "lang string, number int, other int, high long, low long, both long")


def _pairs(used: DataFrame, sources: DataFrame) -> DataFrame:
    """Value of every ordered pair of sources of a language."""
    cell = ["lang", "number", "other"]
    exact = lambda name: F.sum(F.col(name).cast("decimal(20,0)")).cast(_WHOLE)
    met = pair_sums(used).groupBy(*cell).agg(exact("high").alias("high"), exact("low").alias("low"), F.sum("both").alias("both"))
    shift = F.lit(1 << 32).cast("decimal(10,0)")
    met = met.select(*cell, (F.col("high").cast("decimal(27,0)") * shift + F.col("low")).cast(_WHOLE).alias("met"), "both")
    # A source's terms by their share, each against the sources that lack it.
    known = used.select("lang", F.explode("uses").alias("use")).groupBy("lang", F.col("use.number").alias("has"), F.col("use.p").alias("p"))
    known = known.agg(F.count(F.lit(1)).alias("terms"))
    lacks = sources.select("lang", F.col("number").alias("lacks"), "lacking")
    facing = known.join(lacks, "lang").where("has <> lacks")
    times = F.col("terms").cast("decimal(19,0)")

    def summed(value: Column) -> Column:
        return F.sum((times * value.cast("decimal(19,0)")).cast(_WHOLE)).cast(_WHOLE)

    one_sided = facing.groupBy("lang", "has", "lacks").agg(
        summed(_apart(F.col("p"), F.col("lacking"))).alias("forth"), summed(_apart(F.col("lacking"), F.col("p"))).alias("back")
    )
    forth = one_sided.select("lang", F.col("has").alias("number"), F.col("lacks").alias("other"), F.col("forth").alias("one_sided"))
    back = one_sided.select("lang", F.col("lacks").alias("number"), F.col("has").alias("other"), F.col("back").alias("one_sided"))
    sides = forth.unionAll(back).groupBy(*cell).agg(F.sum("one_sided").cast(_WHOLE).alias("one_sided"))
    named = sources.select("lang", "number", "source", "v", "own_terms", "lacking")
    others = sources.select("lang", *[F.col(c).alias(f"other_{c}") for c in ("number", "source", "own_terms", "lacking")])
    pairs = named.join(others, "lang").where("number <> other_number").withColumnRenamed("other_number", "other")
    neither = (F.col("v") - F.col("own_terms") - F.col("other_own_terms")).cast("decimal(19,0)")
    ground = (neither * _apart(F.col("lacking"), F.col("other_lacking")).cast("decimal(19,0)")).cast(_WHOLE)
    zero = F.lit(0).cast(_WHOLE)
    joined = pairs.join(sides, cell, "left").join(met, cell, "left")
    value = ground + F.coalesce("one_sided", zero) + F.coalesce("met", zero)
    value = F.when(F.col("v") > 0, value).otherwise(zero).cast("long")
    return joined.select("lang", "source", F.lit("pair").alias("part"), F.col("other_source").alias("item"), value.alias("value"))


def _overused(used: DataFrame) -> DataFrame:
    """Terms that a group uses more than its language does."""
    one = used.select("lang", "item", "q", F.explode("uses").alias("use")).where(F.col("use.p") > F.col("q"))
    return one.select(
        "lang", F.col("use.source").alias("source"), F.lit("term").alias("part"), "item", _apart(F.col("use.p"), F.col("q")).alias("value")
    )


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, least: int = LEAST, levels: tuple[int, ...] = LEVELS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank; see the module's head."""
    named = _named(docs)
    terms = stage(frequent(named, least, levels), "divergence-terms")
    sources = stage(sources_of(named, terms), "divergence-sources")
    used = stage(shares(terms, sources), "divergence-shares")
    return _ranked(_pairs(used, sources)).unionByName(_ranked(_overused(used)).where(F.col("rank") <= top))
