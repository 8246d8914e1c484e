from __future__ import annotations

import random
from fractions import Fraction

import pytest

from chargestream.llm import mixing as M


def fill(budget, children):
    """Water-filling by exact fractions: children are (weight, supply)."""
    given, left, open_ones = [0] * len(children), Fraction(budget), [i for i, (w, _) in enumerate(children) if w]
    while open_ones:
        rate = left / sum(children[i][0] for i in open_ones)
        full = [i for i in open_ones if children[i][1] <= rate * children[i][0]]
        if not full:
            for i in open_ones:
                given[i] = int(rate * children[i][0])
            break
        for i in full:
            given[i] = children[i][1]
            left -= children[i][1]
            open_ones.remove(i)
    return given


@pytest.mark.parametrize("seed", range(4))
def test_shares_equal_water_filling(llm, seed):
    rnd = random.Random(seed)
    rows, want = [], {}
    for family in range(25):
        children = [(rnd.choice((0, 1, 1, 2, 7)), rnd.choice((0, 3, 50, 1000, 10**6))) for _ in range(rnd.randint(1, 7))]
        budget = rnd.choice((0, 10, 777, 10**5, 10**8))
        for i, given in enumerate(fill(budget, children)):
            rows.append((family, f"c{i}", *children[i], budget))
            want[family, f"c{i}"] = given
    table = llm.createDataFrame(rows, "p int, c string, weight long, supply long, budget long")
    table = table.selectExpr("p", "c", *[f"cast({k} as decimal(38,0)) as {k}" for k in ("weight", "supply", "budget")])
    assert {(r.p, r.c): int(r.given) for r in M.shares(table, ["p"], "c").collect()} == want


def test_shortage_goes_to_siblings_first(llm):
    leaves = [("web", "en", "a", 100), ("web", "en", "b", 10_000), ("web", "de", "c", 10_000), ("news", "en", "d", 10_000)]
    table = llm.createDataFrame(leaves, "__domain string, __lang string, __source string, tokens long")
    mix = M.Mix({}, {}, {}, share=(1, 5), max_epochs=1)
    given = {r["__source"]: int(r.given) for r in M.budgets(table, mix).collect()}
    total = sum(x[3] for x in leaves) // 5
    assert given["d"] == total // 2 and given["c"] == total // 4 and given["a"] == 100 and given["b"] == total // 4 - 100


MORE = ", epochs string"


def test_chosen_rows(documents, llm):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        source = "src0" if i % 3 == 0 else f"src{rnd.randrange(9)}"
        rows.append((i, "w " * rnd.randint(1, 40), rnd.choice(("en", "de", None)), source if i % 50 else None, 0, "x"))
    rows += [(9000, None, "en", "src1", 0, "x"), (9001, "", "en", "src1", 0, "x"), (None, "w w", "en", "src1", 0, "x"), rows[5]]
    table = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, epochs string")
    mix = M.Mix({"web": 3}, {"en": 2}, {}, share=(2, 3), max_epochs=2)
    found = M.choose(table, mix)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "domain", "n_tokens", "epochs"]
    chosen = found.collect()
    assert all(r.epochs in (1, 2) and r.n_tokens == len(r.text.split()) for r in chosen)
    total = sum(len((t or "").split()) for _, t, *_ in rows)
    taken = sum(r.n_tokens * r.epochs for r in chosen)
    assert 0.9 * total * 2 / 3 < taken <= total * 2 / 3
    supply, given, leaf = {}, {}, {}
    for r in rows:
        if r[1]:
            key = (r[3], r[2])
            supply[key] = supply.get(key, 0) + len(r[1].split())
    for r in chosen:
        leaf.setdefault((r.source, r.lang), []).append(r)
    for key, own in leaf.items():
        assert sum(r.n_tokens * r.epochs for r in own) <= 2 * supply[key]
    again = {(r.doc_id, r.epochs) for r in M.choose(table, mix).collect()}
    assert again == {(r.doc_id, r.epochs) for r in chosen}
    assert {(r.doc_id, r.epochs) for r in M.choose(table, mix._replace(seed=4)).collect()} != again
    assert not {9000, 9001} & {r.doc_id for r in chosen}


def test_all_of_everything_and_empty(documents):
    table = documents(*[(i, "a b c") for i in range(20)])
    assert {r.epochs for r in M.choose(table, M.DEFAULT._replace(share=(5, 1))).collect()} == {3}
    assert M.choose(table.where("false")).collect() == []
