"""Cheapest repairs against an exhaustive search and a plain walk over whole conversations."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import time
import zlib

import pytest

from chargestream.llm import conversation_repair as R

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
FULL = {"u": "user", "a": "assistant"}
INITIAL = {"": 0, "s": 1, "u": 2, "a": 3}


def cheapest(rows):
    """(cost, edits, lines) by a uniform-cost search ordered by cost, then edits; rows are (role, text, must_go, extra)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, path, at, last, lines = heapq.heappop(heap)
        if at == len(rows) and last in ("", "a"):
            return cost, path, lines
        if (at, last) in done:
            continue
        done.add((at, last))
        then = NEXT[last]
        heapq.heappush(heap, (cost + 3, path + "I", at, then, (*lines, f"{FULL[then]}:")))
        if at < len(rows):
            role, text, must_go, extra = rows[at]
            heapq.heappush(heap, (cost + 4, path + "D", at + 1, last, lines))
            if not must_go:
                if role[:1] == then or role[:1] == "s" and last == "":
                    heapq.heappush(heap, (cost + extra, path + "K", at + 1, role[:1], (*lines, f"{role}:{text}")))
                heapq.heappush(heap, (cost + 3 + extra, path + "R", at + 1, then, (*lines, f"{FULL[then]}:{text}")))


def brute(turns, harmed=True):
    """The operator's rows by conversation, from (conv_id, turn, role, text)."""
    out = {}
    for conv in {t[0] for t in turns}:
        rows = []
        for _, turn, role, text in (t for t in turns if t[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if harmed else 9
            if draw == 0:
                continue
            text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
            rows += [(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        numbers = [r[0] for r in rows if r[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        seen, given, count = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for _, role, text in rows:
            marks = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            given.append((role, text, fault in ("blank", "duplicate"), 3 if fault == "truncated" else 0))
        pairs = zip(given, given[1:], strict=False)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)
        cost, path, lines = cheapest(given)
        out[conv] = (gaps, *count.values(), illegal, cost, path, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def spark_rows(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[n] for n in names) for r in rows}


def turns_table(llm, rows):
    return llm.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def random_rows(rnd, n):
    return bytes(rnd.choice([0, 1, 2, 2, 2, 3, 3, 3]) | rnd.choice([0, 0, 0, 0, 4, 8]) for _ in range(n))


def as_given(rows):
    roles = {0: "tool", 1: "system", 2: "user", 3: "assistant"}
    return [(roles[r & 3], "", bool(r & 4), 3 if r & 8 else 0) for r in rows]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 9, 20, 45])
def test_search_against_exhaustive_search(n):
    rnd = random.Random(n)
    rounds = 0
    for _ in range(150):
        rows = random_rows(rnd, n)
        cost, path, took = R.search(rows)
        assert (cost, path) == cheapest(as_given(rows))[:2]
        # Without any knowledge of the rest, the bound has to rise step by step to the same answer.
        if n <= 9:
            assert R.search(rows, [0] * (4 * n + 4))[:2] == (cost, path)
        rounds = max(rounds, took)
    assert n < 9 or rounds > 1


def test_bounds_never_exceed_the_cost():
    rnd = random.Random(8)
    for _ in range(100):
        rows = random_rows(rnd, 12)
        exact = R.lower_bounds(rows, 1)
        assert exact[0] == R.search(rows)[0]
        assert all(a <= b for a, b in zip(R.lower_bounds(rows, 32, 2), exact, strict=True))


def test_a_long_conversation_takes_few_rounds():
    rnd = random.Random(4)
    rows = bytes((2 + at % 2 if rnd.random() < 0.9 else rnd.randrange(4)) | rnd.choice([0] * 9 + [4, 8]) for at in range(20_000))
    began = time.process_time()
    cost, path, rounds = R.search(rows)
    assert cost == R.lower_bounds(rows, 1)[0] and rounds < 200
    assert sum(c != "I" for c in path) == len(rows)
    assert time.process_time() - began < 60


def sample(rnd, conversations):
    texts = ["Yes.", "No!", "broken off", "", " \t", None, "Why?  ", "a. b", "Ok.\n", "é…"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "usher"]
    rows = []
    for conv in range(conversations):
        for turn in range(rnd.randrange(1, 14)):
            at = None if rnd.random() < 0.03 else turn * rnd.choice([1, 1, 1, 2]) - 2
            rows.append((conv, at, roles[turn % 2] if rnd.random() < 0.8 else rnd.choice(roles), rnd.choice(texts)))
            if rnd.random() < 0.1:
                rows.append(rows[-1])
    rows += [(None, 1, "user", "Who?"), (None, 2, "assistant", "Me."), (None, None, "user", None), (-7, None, None, None)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("harmed", [True, False])
def test_repair_against_brute_force(llm, harmed):
    rows = sample(random.Random(6), 150)
    df = turns_table(llm, rows).repartition(4)
    got = spark_rows(R.repair(df) if harmed else R.repair(df, None))
    assert got == brute(rows, harmed)


def test_conversations_without_rows_after_damage(llm):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = spark_rows(R.repair(turns_table(llm, [(gone, 0, "user", "Hi.")])))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_hot_conversation_long_text_clashing_columns_and_empty_table(llm):
    rows = [(1, at, ("user", "assistant")[at % 2], f"line {at}.") for at in range(3000)] + [(2, 0, "user", "word " * 2_000_000)]
    rows += [(3, 5, "user", "again.")] * 700
    df = turns_table(llm, rows)
    clash = df.selectExpr("*", "1 as cost", "'x' as audit", "2 as digest", "3 as edit", "4 as at", "true as is_text")
    assert spark_rows(R.repair(clash)) == brute(rows)
    assert R.repair(df.limit(0)).count() == 0


def test_the_search_gets_no_texts(llm):
    rows = R.with_digest(R.damage(turns_table(llm, [(1, 0, "user", "Hi.")])))
    assert not {"text", "copy"} & set(R._features(rows).columns)
    plan = R.edits(rows.drop("digest"))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(conv_id.*\n *\+- Project \[conv_id#\w+, turn#\w+, role#\w+, unhex", plan)
