from __future__ import annotations

import random

import numpy as np
import pytest

from chargestream.llm import ngram_join, shared
from chargestream.llm.components import components

from .conftest import edited, prose, words


def brute(rows, n, num, den):
    """doc_id -> (size, least id reachable)."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and den * len(a & sets[j]) >= num * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    return sorted(
        (str(doc), len(sets[i]), str(min((d for d in groups[find(i)] if d is not None), default=None))) for i, (doc, _) in enumerate(rows)
    )


def got(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


@pytest.mark.parametrize(("n", "num", "den", "block"), [(3, 9, 10, 512), (5, 8, 10, 4)])
def test_equals_brute_force(documents, monkeypatch, n, num, den, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rnd = random.Random(n)
    texts = []
    for _ in range(12):
        base = prose(rnd, rnd.randint(1, 200))
        texts += [base, list(base)] + [edited(rnd, base, rnd.randint(0, 6)) for _ in range(rnd.randint(0, 9))]
    centre = prose(rnd, 160)
    texts += [edited(rnd, centre, rnd.randint(1, 3)) for _ in range(40)]
    line = prose(rnd, 12)
    texts += [prose(rnd, 30) + line for _ in range(30)]
    texts += [["one"], ["one", "two"], ["two", "one"], ["one"], [], []]
    rnd.shuffle(texts)
    rows = [(7 * i - 100, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(None, rows[3][1]), (None, "only here alone"), (5000, None), rows[4], (5001, rows[5][1].upper())]
    assert got(ngram_join.join_documents(documents(*rows, more=", component_id string"), n, num / den)) == brute(rows, n, num, den)


def test_empty_table(documents, llm):
    empty = documents((1, "x")).where("doc_id < 0")
    assert got(ngram_join.join_documents(empty, 3, 0.9)) == []
    assert got(ngram_join.join_documents(documents((1, None), (2, "")), 3, 0.9)) == [("1", 0, "1"), ("2", 0, "2")]


def test_components_of_a_long_path_and_a_hub(llm):
    path = [(i, i + 1) for i in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(3000, 3000)]
    found = dict(map(tuple, components(llm.createDataFrame(path, "u long, v long")).collect()))
    assert found == {**{i: 0 for i in range(201)}, **{1000 + k: 1000 for k in range(300)}}


def test_rows_of_a_large_group_of_near_copies_grow_with_it(documents, monkeypatch):
    """No table has the pairs of a group, nor its blocks' pairs: a few rows a document."""
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    made = {}
    real = ngram_join.stage

    def counted(df, name):
        table = real(df, name)
        made[name] = max(made.get(name, 0), table.count())
        return table

    monkeypatch.setattr(ngram_join, "stage", counted)
    rnd = random.Random(4)
    centre = prose(rnd, 200, 10**6)
    rows = [(i, " ".join(edited(rnd, centre, 1))) for i in range(150)]
    found = ngram_join.join_documents(documents(*rows), 3, 0.9).collect()
    assert {r.component_id for r in found} == {0} and len(found) == len(rows)
    assert max(made.values()) <= 4 * len(rows), made


def test_counted_keys_take_little_more_than_their_entropy():
    """Buckets of n cells that k keys of one chunk meet: about log2(n / k) + 1.44 bits each."""
    for bits, size in ((25, 1 << 20), (26, 1 << 20), (26, 1 << 22)):
        top = np.uint64(64 - bits)
        keys = np.unique(np.random.default_rng(bits).integers(0, 1 << 64, size, np.uint64) >> top << top)
        counts = np.ones(len(keys), np.int64)
        counts[::1000] = 70_000
        blobs = [shared.packed(keys[where], counts[where]) for _, where in shared.split_by_shard(keys, shared.hash_edges(7))]
        assert [x.tolist() for x in shared.merged(blobs)] == [keys.tolist(), counts.tolist()]
        assert 8 * sum(map(len, blobs)) / len(keys) < 1.1 * (np.log2((1 << bits) / len(keys)) + 1.44)
    for keys in ([], [0], [0, 1], [2**64 - 1], [5, 1 << 63]):
        assert shared.unpacked(shared.packed(np.array(keys, np.uint64), np.ones(len(keys), np.int64)))[0].tolist() == keys


def test_a_task_counts_as_many_keys_at_a_time_as_asked(documents):
    """As the sketch does, whose buckets lie the closer the more of them are counted at a time."""
    keys = np.arange(3000, dtype=np.uint64) << np.uint64(50)
    blobs = shared.count_keys(documents((1, "x")).coalesce(1), lambda batch: [keys, keys], shared.hash_edges(0), most=6000).collect()
    assert [x.tolist() for x in shared.unpacked(blobs[0].blob)] == [keys.tolist(), [2] * 3000]
    assert sum(len(shared.unpacked(r.blob)[0]) for r in blobs) == 3000
