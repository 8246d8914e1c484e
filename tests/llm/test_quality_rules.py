from __future__ import annotations

import random
import re

import pyarrow as pa

from chargestream.llm import quality_rules as Q
from chargestream.llm import text as T

from .conftest import prose


def longest_repeats(ws):
    best = [0] * len(ws)
    for i in range(len(ws)):
        for j in range(len(ws)):
            k = 0
            while i != j and max(i, j) + k < len(ws) and ws[i + k] == ws[j + k]:
                k += 1
            best[i] = max(best[i], k)
    return best


def test_repeat_lengths_equal_brute_force():
    rnd = random.Random(4)
    for letters in ("a", "ab", "abcdef"):
        for _ in range(15):
            rows = [[rnd.choice(letters) for _ in range(rnd.randint(0, 30))] * rnd.choice((1, 1, 2, 3)) for _ in range(rnd.randint(1, 4))]
            found = T.words(pa.array([" ".join(r) for r in rows]), T.PLAIN)
            assert Q.repeat_lengths(found.hash, found.row).tolist() == [x for r in rows for x in longest_repeats(r)]


def measures(text, limits):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    tri = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    repeated = {k for i, g in enumerate(tri) if tri.count(g) > 1 for k in range(i, i + 3)}
    lines, dup = [], 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.append(line)
    best = longest_repeats(ws)
    inside = {k for i, n in enumerate(best) if n >= limits.min_repeat for k in range(i, i + n)}
    longest = max((n for n in best if n >= limits.min_repeat), default=0)
    base = len(ws) < 50 or 100 * len(repeated) > 50 * len(ws)
    bad = len(inside) > limits.covered * len(ws) or (longest > limits.longest_words and longest > limits.longest * len(ws))
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated), len(inside), longest, base, not base and not bad)


def test_rows_equal_brute_force(documents):
    rnd = random.Random(5)
    limits = Q.Limits(min_repeat=6, covered=0.2, longest=0.1, longest_words=12)
    block = " ".join(prose(rnd, 30))
    texts = [None, "", " \n ", "é" * 3, "word " * 80, "a\nb\na\n\n b\nb\r\na"]
    texts += [" ".join(prose(rnd, 90)) + f" <b> {block} | # " + "\n" + block * (k % 2) for k in range(6)]
    texts += ["\n".join(" ".join(prose(rnd, 7, 40)) for _ in range(12)) for _ in range(6)]
    rows = list(enumerate(texts)) + [(None, texts[7]), (3, texts[3])]
    found = Q.apply_rules(documents(*rows, more=", kept string"), limits).collect()
    want = [(i, *measures(t, limits)) for i, t in rows]
    assert sorted((tuple(r) for r in found), key=str) == sorted(want, key=str)


def test_clean_prose_stays_and_loops_go(documents):
    rnd = random.Random(6)
    clean = " ".join(prose(rnd, 400))
    loop = " ".join(prose(rnd, 120) + prose(rnd, 70) * 2)
    found = {r.doc_id: (r.base_failed, r.kept) for r in Q.apply_rules(documents((1, clean), (2, loop))).collect()}
    assert found == {1: (False, True), 2: (True, False)} or found == {1: (False, True), 2: (False, False)}


def test_empty_table(documents):
    assert Q.apply_rules(documents((1, "x")).where("false")).collect() == []
