from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from chargestream.llm import text as T

TEXTS = ["", None, "  ", "A b\tc\x0bd\x0c e\r\nf", "é É x y", "one", "a\x00b \x1cq", "ß" * 40 + " z", "Mixed CASE mixed case"]


def _python(text, lower):
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string(), pa.binary()])
def test_words_are_those_of_bytes_split(kind):
    column = pa.array([t if t is None or kind != pa.binary() else t.encode() for t in TEXTS], kind)
    found = T.words(column.slice(1), T.LOWER)
    want = [_python(t, True) for t in TEXTS[1:]]
    assert found.counts.tolist() == [len(w) for w in want]
    flat = [(r, w) for r, ws in enumerate(want) for w in ws]
    assert found.row.tolist() == [r for r, _ in flat]
    by_hash = {}
    for h, (_, w) in zip(found.hash.tolist(), flat, strict=True):
        assert by_hash.setdefault(h, w) == w
    assert len(by_hash) == len({w for _, w in flat})
    for s, e, (_, w) in zip(found.start, found.end, flat, strict=True):
        assert found.data[s:e].tobytes().lower() == w


def test_rows_part_words():
    found = T.words(pa.array(["ab", "cd", "", "abcd"]), T.PLAIN)
    assert found.counts.tolist() == [1, 1, 0, 1] and len(set(found.hash.tolist())) == 3


def test_hash_does_not_depend_on_the_place(monkeypatch):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["alpha", "be", "gamma" * 30]) for _ in range(50)) for _ in range(20)]
    whole = T.words(pa.array(texts), T.PLAIN).hash
    monkeypatch.setattr(T, "SLICE_BYTES", 64)
    assert np.array_equal(T.words(pa.array(texts), T.PLAIN).hash, whole)


def test_shingles_of_short_rows():
    found = T.words(pa.array(["a b", "a b", "a b c", "", "a b c d", "b a"]), T.LOWER)
    grams, rows = T.shingles(found, 3)
    assert rows.tolist() == [0, 1, 2, 4, 4, 5]
    assert grams[0] == grams[1] and grams[2] == grams[3] and len(set(grams.tolist())) == 4


def test_slices_hold_every_row():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (5, 0, 3_000_000, 2, 900_000, 300_000)] + [None]})
    assert [b.num_rows for b in T.slices(iter([batch]), "text")] == [2, 1, 2, 2]
    assert sum(b.num_rows for b in T.slices(iter([batch]), "text")) == batch.num_rows
