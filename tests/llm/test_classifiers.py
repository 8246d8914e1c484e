"""Held-out accuracy on generated labels and on the test tables; defined cases."""

from __future__ import annotations

import random
import re
from zlib import crc32

import numpy as np
import pytest

from chargestream.llm import compression_classifier as C
from chargestream.llm import labelled, toxicity
from chargestream.llm.queries import QUERIES

from .conftest import prose

SF = "/root/testdata/sf0.1"


def held_out(doc):
    return crc32(str(doc).encode()) % 5 == 0


def test_sample_is_bounded_and_leaves_held_out_ids_alone(documents, llm):
    docs = documents(*[(i, f"text {i}") for i in range(400)], (None, "x"))
    labels = llm.createDataFrame([(i, i % 4 // 3, None) for i in range(400)] + [(None, 1, None), (8, 1, None), (2000, 1, None)], "doc_id long, quality int, toxic int")
    rows = labelled.sample(docs, labels, "quality", 60, "test").collect()
    assert 59 <= len(rows) <= 60 and sum(r.label for r in rows) in (29, 30)  # one place may go to the label without a document
    assert not any(held_out(r.doc_id) or r.doc_id == 8 for r in rows) and all(r.label == r.doc_id % 4 // 3 for r in rows)
    assert labelled.sample(docs, labels, "toxic", 60, "test").collect() == []
    everything = labelled.sample(docs, labels, "quality", 10_000, "test").count()
    assert everything == sum(not held_out(i) and i != 8 for i in range(400))


def accuracy(spark, query, label, cut):
    found = {r.doc_id: r for r in QUERIES[query](spark, SF).collect()}
    marks = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.held_out == held_out(d) and 0 <= r.score <= 1 and r.predicted == (r.score >= cut) for d, r in found.items())
    own = [(found[d].predicted, y) for d, y in marks.items() if held_out(d)]
    right = [[p for p, y in own if y == k] for k in (0, 1)]
    return sum(p == 0 for p in right[0]) / len(right[0]), sum(right[1]) / len(right[1])


def test_quality_on_held_out_documents(llm):
    bad, good = accuracy(llm, "op7_compression_classifier", "quality", 0.3)
    assert bad > 0.9 and good > 0.95


def test_toxicity_on_held_out_documents(llm):
    clean, toxic = accuracy(llm, "op10_toxicity_trees", "toxic", 0.5)
    assert clean > 0.98 and toxic > 0.85


@pytest.fixture
def small(documents, llm):
    rnd = random.Random(7)
    rows, marks = [], []
    for i in range(400):
        toxic = i % 5 == 0
        text = prose(rnd, 60)
        for _ in range(4 * toxic):
            text.insert(rnd.randrange(60), rnd.choice(("you vile fool", "FOOLISH!!", "v1le")))
        rows.append((i, " ".join(text)))
        marks.append((i, int(not toxic), int(toxic)))
    rows += [(1000, None), (1001, ""), (None, rows[0][1]), rows[3]]
    return documents(*rows, more=", score string"), llm.createDataFrame(marks, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("module", [C, toxicity])
def test_defined_cases(small, documents, module):
    docs, marks = small
    model = module.fit(docs, marks)
    scored = module.classify(docs, model).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    empty = {r.score for r in scored if r.doc_id in (1000, 1001)}
    assert len(empty) == 1
    assert module.classify(docs.where("false"), model).collect() == []
    nothing = module.fit(docs, marks.where("false"))
    assert {r.score for r in module.classify(docs, nothing).collect()} == {0.5}
    one_kind = module.fit(docs, marks.where("toxic = 0"))
    assert len({round(r.score, 9) for r in module.classify(docs, one_kind).collect()}) == 1


def test_lexicon_and_features(small):
    docs, marks = small
    found = toxicity.learn_lexicon(labelled.sample(docs, marks, "toxic", 1000, "test"))
    assert {"vile", "fool"} <= set(found.words) and len(found.words) <= toxicity.TERMS
    assert max(found.words, key=found.words.get) in {"vile", "fool", "foolish", "v1le"}
    measured = dict(zip(toxicity.FEATURES, toxicity.measure("You are a V1LE fool!! soooo b@d", found), strict=True))
    assert measured["word_hits"] >= 2 and measured["near_you"] > 0
    assert measured["exclamations"] > 0 and measured["stretched"] > 0 and measured["masked"] > 0 and measured["capital_words"] > 0
    assert toxicity.measure("", found) == [0.0] * len(toxicity.FEATURES)


def token_by_token(text, lexicon):
    """The features of a text, each taken from the text itself."""
    tokens = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not tokens:
        return [0.0] * len(toxicity.FEATURES)
    bare = [re.sub(r"^\W+|\W+$", "", t.lower()) for t in tokens]
    looks = [re.sub(r"^\W+|\W+$", "", t.lower().translate(str.maketrans("013457@$!|", "oieastasil"))) for t in tokens]
    n, weights, plain = len(tokens), [], 0
    for word, look in zip(bare, looks, strict=True):
        found = lexicon.words.get(word)
        if found is None and not word.isalpha() and look in lexicon.words:
            found, plain = lexicon.words[look], plain + 1
        weights.append(found)
    stems = [max((lexicon.stems.get(w[:k], 0.0) for k in (4, 5, 6, 7)), default=0.0) for w in bare]
    hits, you = [i for i, w in enumerate(weights) if w is not None], [i for i, w in enumerate(bare) if w in toxicity._YOU]
    near = sum(any(abs(i - j) <= 6 for j in you) for i in hits)
    total = 0.0
    for w in weights:
        total += w or 0.0
    stem_total = 0.0
    for w in stems:
        stem_total += w
    letters = sum(c.isalpha() for c in text) or 1
    return [
        float(np.log1p(n)), len(hits), len(hits) / n, total / n, sum(s > 0 for s in stems) / n, stem_total / n, plain, near / n, len(you) / n,
        sum(c.isupper() for c in text) / letters, sum(len(w) > 1 and t.isupper() for w, t in zip(bare, tokens, strict=True)) / n,
        text.count("!") / n, text.count("?") / n, sum(c in ".,;:'\"()-" for c in text) / n, sum(c in "#*$%&|<>@" for c in text) / n,
        sum(bool(re.search(r"[^\W\d_][0-9@$*#!|]+[^\W\d_]", t)) for t in tokens) / n, sum(bool(re.search(r"(\w)\1\1", w)) for w in bare) / n,
    ]


@pytest.mark.parametrize("known", [400_000, 3])
def test_features_against_the_text_itself(monkeypatch, known):
    monkeypatch.setattr(toxicity, "_KNOWN", known)
    rnd = random.Random(5)
    lexicon = toxicity.Lexicon({"vile": 1.7, "fool": 2.3, "böse": 0.1}, {"scum": 1.1, "scumb": 2.7, "idiot": 0.3})
    pieces = ["you", "Du", "V1LE", "vile", "fool!!", "b@d", "sooo", "scumbag", "Idioten", "böse.", "#*$", "ABC", "a", "7", "—", "É", "ok?", "\x1c", "İ"]
    measured = toxicity.Measure(lexicon)
    for _ in range(300):
        text = "".join(rnd.choice(pieces) + rnd.choice([" ", "\n", "", "\t "]) for _ in range(rnd.randrange(40)))
        assert measured(text) == token_by_token(text, lexicon)
