"""Quality rules of a document, the main one being repetition found by a suffix array.

Word suffixes of every text are sorted by prefix doubling (many texts at once,
each ranked within itself; only suffixes still tied are sorted again). The ranks
of every doubling give the longest common prefix of neighbours. A suffix lies in
LCP intervals up to the larger of its two neighbouring values, so the union of
all repeated spans is the union of [p, p + that value) over the suffixes p; only
values of `min_repeat` words or more count. A text is kept while the covered
share of its words and its longest repeat stay within limits.

Work is bounded by the slice of texts a task has in hand; a single very long
text is a slice of its own, at about 60 bytes a word. No shuffle at all.

Defined cases: null or empty text has no words: all counts 0, base_failed true.
Repeated rows, null ids and extra columns do not matter; a row gives a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T

MIN_WORDS = 50
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


class Limits(NamedTuple):
    """`min_repeat`: words from which a repeat counts; the shares are of a text's words."""

    min_repeat: int = 10
    covered: float = 0.35
    longest: float = 0.25
    longest_words: int = 60


def _rank(keys: np.ndarray) -> np.ndarray:
    _, rank = np.unique(keys, return_inverse=True)
    return rank.astype(np.int64)


def suffix_ranks(tokens: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
    """Ranks of the first 1, 2, 4, ... words of every suffix, until all are told apart.

    Suffixes of different rows never share a rank. The last list orders all
    suffixes, row by row.
    """
    size = len(tokens)
    word = _rank(tokens)
    first = _rank(row.astype(np.int64) * (int(word.max(initial=0)) + 1) + word)
    levels = [first]
    step = 1
    ends = np.searchsorted(row, row, side="right")  # where each position's row ends
    while True:
        now = levels[-1]
        tied = np.flatnonzero(np.bincount(now, minlength=size)[now] > 1)
        if not len(tied):
            return levels
        ahead = tied + step
        inside = ahead < ends[tied]
        if not inside.any():
            return levels
        second = np.where(inside, now[np.minimum(ahead, size - 1)] + 1, 0)
        order = np.lexsort((second, now[tied]))
        a, b = now[tied][order], second[order]
        new = np.empty(len(order), bool)
        new[:1] = True
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        # Ranks leave a gap for every suffix, so a tie is told apart within its own gap.
        place = np.arange(len(order))
        group = np.maximum.accumulate(np.where(np.concatenate([[True], a[1:] != a[:-1]]), place, 0))
        own = np.maximum.accumulate(np.where(new, place, 0)) - group
        spread = _gapped(now) if step == 1 else now
        after = spread.copy()
        after[tied[order]] = spread[tied[order]] + own
        if step == 1:
            levels[0] = spread
        levels.append(after)
        step *= 2


def _gapped(rank: np.ndarray) -> np.ndarray:
    """Each rank becomes the number of suffixes of smaller rank."""
    counts = np.bincount(rank)
    return (np.cumsum(counts) - counts)[rank]


def repeat_lengths(tokens: np.ndarray, row: np.ndarray) -> np.ndarray:
    """At every position the words of the longest run starting there that starts elsewhere in its row too."""
    size = len(tokens)
    if size < 2:
        return np.zeros(size, np.int64)
    levels = suffix_ranks(tokens, row)
    order = np.argsort(levels[-1], kind="stable")
    x, y = order[:-1], order[1:]
    same = np.zeros(size - 1, np.int64)
    ends = np.searchsorted(row, np.arange(row[-1] + 1), side="right")[row]
    for level in range(len(levels) - 1, -1, -1):
        step = 1 << level
        while True:  # the top level may match more than once
            p, q = x + same, y + same
            fits = (p + step <= ends[x]) & (q + step <= ends[y])
            p, q = np.minimum(p, size - 1), np.minimum(q, size - 1)
            more = fits & (row[x] == row[y]) & (levels[level][p] == levels[level][q])
            if not more.any():
                break
            same[more] += step
            if level < len(levels) - 1:
                break
    best = np.zeros(size, np.int64)
    np.maximum.at(best, x, same)
    np.maximum.at(best, y, same)
    return best


def covered(start: np.ndarray, length: np.ndarray, size: int) -> np.ndarray:
    """Which of `size` positions lie in a span."""
    edge = np.bincount(start, minlength=size + 1) - np.bincount(np.minimum(start + length, size), minlength=size + 1)
    return np.cumsum(edge[:size]) > 0


def _dup_lines(batch: pa.RecordBatch, found: T.Words) -> np.ndarray:
    """Per row the lines that hold a word and equal an earlier line of the row."""
    lines = T.words(T.column(batch, "text"), T.LINES)
    words_before = np.searchsorted(found.start, lines.end) - np.searchsorted(found.start, lines.start)
    full = words_before > 0
    key = T.mix(lines.hash[full] + T.mix(lines.row[full].astype(np.uint64)))
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[first] = False
    return np.bincount(lines.row[full][again], minlength=batch.num_rows)


def measure(batch: pa.RecordBatch, limits: Limits) -> dict[str, np.ndarray]:
    rows = batch.num_rows
    found = T.words(T.column(batch, "text"), T.PLAIN)
    per_row = lambda at, weights=None: np.bincount(at, weights, rows).astype(np.int64)
    # Code points are the bytes that continue no other one.
    points = np.concatenate([[0], np.cumsum((found.data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[found.data])])
    grams, _ = T.ngrams(found, 3)
    size = len(found.hash)
    at = np.flatnonzero(found.row[: max(size - 2, 0)] == found.row[2:]) if size > 2 else np.zeros(0, np.int64)
    key = T.mix(grams + T.mix(found.row[at].astype(np.uint64)))
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    twice = at[times[back] > 1] if len(at) else at
    repeated = covered(twice, np.full(len(twice), 3), size) if len(twice) else np.zeros(size, bool)
    n = found.counts
    # The suffix array. A repeat of min_repeat words repeats its 3-word windows,
    # so only texts with enough repeated words need one.
    suspect = per_row(found.row[repeated]) >= limits.min_repeat
    chosen = suspect[found.row] if size else np.zeros(0, bool)
    length = np.zeros(size, np.int64)
    if chosen.any():
        length[chosen] = repeat_lengths(found.hash[chosen], found.row[chosen])
    long = np.flatnonzero(length >= limits.min_repeat)
    inside = covered(long, length[long], size) if len(long) else np.zeros(size, bool)
    longest = np.zeros(rows, np.int64)
    np.maximum.at(longest, found.row[long], length[long])
    return {
        "n_words": n.astype(np.int64),
        "word_chars": per_row(found.row, points[found.end] - points[found.start]) if size else np.zeros(rows, np.int64),
        "n_symbols": symbols[found.offsets[1:]] - symbols[found.offsets[:-1]],
        "n_dup_lines": _dup_lines(batch, found).astype(np.int64),
        "n_repeat_words": per_row(found.row[repeated]),
        "covered_words": per_row(found.row[inside]),
        "longest_repeat": longest,
    }


COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_words long, longest_repeat long"


def apply_rules(docs: DataFrame, limits: Limits = Limits(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row the columns `keep`, the measures, base_failed and kept."""
    fields = [docs.select(c).schema[0] for c in keep]
    from pyspark.sql.types import StructType

    schema = StructType([*fields, *StructType.fromDDL(COLUMNS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, "text"):
            found = {k: pa.array(v, pa.int64()) for k, v in measure(batch, limits).items()}
            yield pa.RecordBatch.from_pydict({c: T.column(batch, c) for c in keep} | found)

    columns = list(dict.fromkeys([*keep, "text"]))
    measured = docs.select(*columns).mapInArrow(run, schema)
    n = F.col("n_words")
    base = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * n)
    too_much = F.col("covered_words") > limits.covered * n
    too_long = (F.col("longest_repeat") > limits.longest_words) & (F.col("longest_repeat") > limits.longest * n)
    return measured.withColumn("base_failed", base).withColumn("kept", ~base & ~too_much & ~too_long)
