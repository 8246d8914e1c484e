"""The audit against plain dictionaries: frequent terms, exact shares, pairs and ranks."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from chargestream.llm import source_divergence as D


def terms_of(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(rows, least=3, top=200):
    """The audit of (text, lang, source) rows."""
    docs = [(terms_of(t), lang or "", source or "") for t, lang, source in rows]
    out = set()
    for lang in {d[1] for d in docs}:
        own = [d for d in docs if d[1] == lang]
        spread = Counter(t for ts, *_ in own for t in set(ts))
        kept = {t for t, n in spread.items() if n >= least}
        sums = defaultdict(Counter)
        for ts, _, source in own:
            sums[source].update(t for t in ts if t in kept)
        whole = sum(sums.values(), Counter())

        def share(count, of, v=len(kept)):
            return 1 + D.SCALE * (count + 1) // (sum(of.values()) + v)

        for source, counts in sums.items():
            pairs = [(sum((share(counts[t], counts) - q) ** 2 // q for t in kept for q in [share(o[t], o)]), name) for name, o in sums.items() if name != source]
            used = [((p - q) ** 2 // q, t) for t in counts for p, q in [(share(counts[t], counts), share(whole[t], whole))] if counts[t] and p > q]
            for part, found in (("pair", pairs), ("term", used)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, source, part, item, value, at) for at, (value, item) in enumerate(ranked, 1) if part == "pair" or at <= top}
    return out


def table(llm, rows):
    return llm.createDataFrame(rows, "text string, lang string, source string")


def found(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def sample(rnd, n):
    vocabulary = ["".join(rnd.choices("abcÉéß日", k=rnd.randrange(1, 12))) for _ in range(120)]
    weights = [1 / (at + 1) for at in range(120)]
    rows = []
    for _ in range(n):
        text = " ".join(rnd.choices(vocabulary, weights, k=rnd.randrange(30)))
        rows.append((text.upper() if rnd.random() < 0.2 else text, rnd.choice(["en", "en", "de", None]), rnd.choice(["hot"] * 5 + ["a", "b", "ß", None])))
    rows += [(None, "en", "mute"), ("", "fr", "x"), ("1 2 - 3", "fr", "y"), ("lonely", "it", "only"), ("lonely", "it", "only"), ("lonely!", "it", "only")]
    return rows + rows[:7]


@pytest.mark.parametrize("seed", range(2))
def test_audit_against_brute_force(llm, seed):
    rows = sample(random.Random(seed), 250)
    df = table(llm, rows).repartition(5)
    clash = df.select("*", *[F.lit(1).alias(c) for c in ("item", "uses", "q", "number", "n", "v", "bit", "documents", "value")])
    assert found(D.audit(clash)) == brute(rows)


@pytest.mark.parametrize(("levels", "bits"), [((), 26), ((1,), 26), ((1, 2, 3, 4, 5, 9), 26), ((3, 6), 7)])
def test_levels_and_the_size_of_the_map_change_nothing(llm, monkeypatch, levels, bits):
    # With 128 bits nearly every prefix passes by accident; the counts decide.
    monkeypatch.setattr(D, "MAP_BITS", bits)
    rows = sample(random.Random(9), 120)
    got = {(r.lang, r.item): (r.documents, sum(u.occurrences for u in r.uses)) for r in D.frequent(D._named(table(llm, rows)), 3, levels).collect()}
    spread, times = Counter(), Counter()
    for text, lang, _ in rows:
        own = Counter(terms_of(text))
        spread.update((lang or "", t) for t in own)
        times.update({(lang or "", t): n for t, n in own.items()})
    assert got == {k: (n, times[k]) for k, n in spread.items() if n >= 3}


def test_prefixes_are_counted_by_document_and_cut_off_later(llm):
    rows = [("abcd abce abcf", "en", "x"), ("abcd zz", "en", "y"), ("ABCG zz zz", "en", "x"), ("qrst", "en", "x")]
    named = D._named(table(llm, rows).coalesce(1))
    first = D.survivors(D.level_counts(named, 3, None, None), 3)
    assert [(bytes(r.item), r.documents) for r in first.collect()] == [(b"abc", 3)]
    bits = D.bit_map(first)
    assert int(np.bitwise_count(bits).sum()) == 1
    second = D.level_counts(named, 4, 3, bits)
    assert sorted((bytes(r.item), r.documents, r.occurrences) for r in second.collect()) == [(b"abcd", 2, 2), (b"abce", 1, 1), (b"abcf", 1, 1), (b"abcg", 1, 1)]


def test_pairs_in_small_pieces_and_beyond_64_bits(llm, monkeypatch):
    rnd = random.Random(5)
    uses = [rnd.randrange(0, 6) for _ in range(40)]
    lang = np.array([at % 2 for at in range(40)])
    number = np.array([n for k in uses for n in rnd.sample(range(8), k)])
    p = np.array([rnd.choice([1, 2, 10**9, rnd.randrange(1, 10**9)]) for _ in number])
    lacking = np.array([rnd.choice([1, 7]) for _ in number])
    want, at = defaultdict(lambda: [0, 0]), 0
    for k, of in zip(uses, lang.tolist(), strict=True):
        for a in range(at, at + k):
            for b in set(range(at, at + k)) - {a}:
                f = lambda x, y: int(x - y) ** 2 // int(y)
                cell = want[of, int(number[a]), int(number[b])]
                cell[0] += f(p[a], p[b]) - f(p[a], lacking[b]) - f(lacking[a], p[b]) + f(lacking[a], lacking[b])
                cell[1] += 1
        at += k
    for most in (1, 7, 1 << 19):
        monkeypatch.setattr(D, "_PAIRS", most)
        got = defaultdict(lambda: [0, 0])
        for piece in D._both(lang, np.array(uses), number, p, lacking):
            for of, a, b, high, low, both in zip(*(x.tolist() for x in piece), strict=True):
                got[of, a, b][0] += (high << 32) + low
                got[of, a, b][1] += both
        assert got == want
    assert max(v for v, _ in want.values()) > 10**17


def test_shares_are_exact_for_counts_beyond_64_bits(llm):
    row = llm.range(1).select(D._share(F.lit(10**13), F.lit(7 * 10**13).cast("decimal(38,0)"), F.lit(10**9)).alias("p")).first()
    assert row.p == 1 + 10**9 * (10**13 + 1) // (7 * 10**13 + 10**9)


def test_empty_table_and_a_very_long_text(llm):
    assert D.audit(table(llm, [("a", "b", "c")]).limit(0)).count() == 0
    rows = [("alpha beta " * 1_000_000, "en", "x"), ("alpha " * 3, "en", "y"), ("alpha beta gamma", "en", "y"), ("beta", "en", "z")]
    assert found(D.audit(table(llm, rows))) == brute(rows)


def test_no_row_per_term_and_pair_and_no_cross_join(llm):
    named = D._named(table(llm, sample(random.Random(1), 30)))
    terms = D.frequent(named)
    sources = D.sources_of(named, terms)
    plan = D._pairs(D.shares(terms, sources), sources)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Cartesian|NestedLoop", plan)


def test_hashes_with_equal_upper_bits_keep_their_order():
    """Sorting by upper bits alone would part the rows of one hash, and count a document twice."""
    values = np.array([5, 4, 5, 6, 4, 5, 1 << 60, 3], np.uint64)
    assert D._order(values).tolist() == np.argsort(values, kind="stable").tolist()
    spread = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64).repeat(3)
    assert D._order(spread).tolist() == np.argsort(spread, kind="stable").tolist()


def test_prefixes_are_told_apart_by_their_bytes():
    text = "Ab ab abc ABCDEFGH abcdefghi éé a".encode()
    ends = [2, 5, 9, 18, 28, 33, 35]
    starts = [0, 3, 6, 10, 19, 29, 34]
    got = D._prefixes(np.frombuffer(text, np.uint8), np.array(starts), np.array(ends), 3).tolist()
    wanted = [text[a : min(b, a + 3)].lower() for a, b in zip(starts, ends, strict=True)]
    assert [got.index(v) for v in got] == [wanted.index(v) for v in wanted]
