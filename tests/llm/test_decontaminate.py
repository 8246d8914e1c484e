from __future__ import annotations

import hashlib
import random
import re

import pytest

from chargestream.llm import decontaminate as D

from .conftest import prose

ITEM = "item_id long, text string, answer string"


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items):
    out = []
    for doc, text in docs:
        w = terms(text)
        hit, names = set(), set()
        for item, words in items:
            t = terms(words)
            k = min(len(t), 10)
            own = {tuple(t[i : i + k]) for i in range(len(t) - k + 1)} if t else set()
            for i in range(len(w) - k + 1 if t else 0):
                if tuple(w[i : i + k]) in own:
                    hit |= set(range(i, i + k))
                    names |= set() if item is None else {str(item)}
        joined = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(names), joined, bool(hit)))
    return sorted(out, key=str)


@pytest.fixture
def tables(documents, llm):
    rnd = random.Random(6)
    items = [(i, " ".join(prose(rnd, n))) for i, n in enumerate((25, 10, 11, 9, 4, 1, 30, 0))]
    items += [(100, items[0][1]), (None, " ".join(prose(rnd, 15))), (7, None), (6, "Straße, ÉTÉ 42! " * 5)]
    clean = [" ".join(prose(rnd, 60, 10**6)) for _ in range(8)]
    docs = [(i, c) for i, c in enumerate(clean)]
    for i, (_, t) in enumerate(items):
        if t:
            docs.append((50 + i, f"{clean[i % 8]} {t.upper() if t.isascii() else t}; {clean[(i + 1) % 8]}"))
            docs.append((80 + i, f"{clean[i % 8]}, {' '.join(t.split()[2:13])}"))
    docs += [(200, None), (201, ""), (None, items[0][1]), docs[9], (202, items[1][1] + " " + items[1][1])]
    benchmark = llm.createDataFrame([(*x, "a") for x in items], ITEM)
    return docs, items, documents(*docs, more=", items string"), benchmark


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 1500])
def test_equals_brute_force(tables, block_bytes):
    docs, items, table, benchmark = tables
    found = D.digest(D.find(table, benchmark, block_bytes=block_bytes))
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted((tuple(r) for r in found.select(*names).collect()), key=str) == brute(docs, items)


def test_removal(tables):
    docs, items, table, benchmark = tables
    hit = {str(r[0]) for r in brute(docs, items) if r[5]}
    table = table.selectExpr("*", "1 as n_words", "2 as spans", "'x' as `odd name`")
    kept = D.remove(table, benchmark)
    assert kept.columns == table.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(((str(i), t) for i, t in docs if str(i) not in hit), key=str)
    cut = D.remove(table, benchmark, spans=True).collect()
    assert len(cut) == len(docs)
    whole = {str(i): t for i, t in docs}
    for r in cut:
        if str(r.doc_id) not in hit:
            assert r.text == whole[str(r.doc_id)]
    text = next(r.text for r in cut if r.doc_id == 51)
    assert terms(text) == [w for w in terms(whole["51"]) if w not in terms(items[1][1])] or len(terms(text)) == 120


def test_empty_tables(documents, llm):
    none = llm.createDataFrame([], ITEM)
    found = D.digest(D.find(documents((1, "a b")), none)).first()
    assert (found.n_words, found.n_hit, found.contaminated) == (2, 0, False)
    assert D.find(documents((1, "a")).where("false"), none).collect() == []
