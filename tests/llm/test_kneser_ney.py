from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from chargestream.llm import kneser_ney as K

from .conftest import words


def brute(train, texts):
    """(n_tokens, n_known, N, base, score) by dictionaries."""
    lines = [[*words(t), "</s>"] for t in train]
    uni = Counter(w for line in lines for w in line)
    bi = Counter((a, b) for line in lines for a, b in zip([None, *line[:-1]], line, strict=True))
    seen = Counter(b for _, b in bi)
    n, v = sum(uni.values()), len(uni)
    d2 = (0.0, *K._discounts([sum(c == k for c in bi.values()) for k in (1, 2, 3, 4)]))
    d1 = (0.0, *K._discounts([sum(c == k for c in seen.values()) for k in (1, 2, 3, 4)]))
    total = sum(seen.values())
    rest = sum(d1[min(c, 3)] for c in seen.values()) / total if total else 1.0
    follow, mass = Counter(), Counter()
    for (a, _), c in bi.items():
        follow[a] += c
        mass[a] += d2[min(c, 3)]

    def p1(w):
        c = seen[w]
        return (max(c - d1[min(c, 3)], 0) / total if total else 0) + rest / (v + 1)

    def p2(a, w):
        if not follow[a]:
            return p1(w)
        c = bi[a, w]
        return max(c - d2[min(c, 3)], 0) / follow[a] + mass[a] / follow[a] * p1(w)

    out = []
    for t in texts:
        line = [*words(t), "</s>"]
        base = sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in line)
        score = sum(math.log10(p2(a, w)) for a, w in zip([None, *line[:-1]], line, strict=True))
        out.append((len(line), sum(uni[w] > 0 for w in line), n, base, score))
    return out, lambda a: sum(p2(a, w) for w in uni) + p2(a, "never seen")


@pytest.mark.parametrize("shards", [8, 64])
def test_scores_equal_a_dictionary_model(documents, shards):
    rnd = random.Random(5)
    vocabulary = [f"t{int(rnd.paretovariate(0.7))}" for _ in range(3000)]
    texts = [" ".join(rnd.choices(vocabulary, k=rnd.randint(1, 60))) for _ in range(120)]
    texts += [None, "", "the " * 400, "Unknown-word t1 t1 another", texts[0]]
    train, test = texts[:100] + texts[120:123], texts
    rows = list(enumerate(test))
    model = K.train(documents(*enumerate(train)), shards)
    found = {r.doc_id: r for r in K.score(documents(*rows, more=", score string"), model).collect()}
    want, total = brute(train, test)
    for at, (tokens, known, n, base, score) in enumerate(want):
        row = found[at]
        assert (row.n_tokens, row.n_known, model.tokens) == (tokens, known, n)
        assert row.base_score == pytest.approx(base) and row.score == pytest.approx(score)
    for context in (None, "t1", "t2", "never"):
        assert total(context) == pytest.approx(1.0)
    assert shards == 8 or model.split  # a frequent context was cut into several shards


def test_nothing_to_learn_from(documents):
    model = K.train(documents((1, "x")).where("false"))
    assert model.tokens == 0 and model.types == 0
    row = K.score(documents((1, "a b")), model).first()
    assert (row.n_tokens, row.n_known, row.base_score, row.score) == (3, 0, 0.0, 0.0)
    assert K.score(documents((1, "x")).where("false"), model).collect() == []
