"""Repair of conversations by the cheapest edits, found by iterative deepening A*.

A repaired conversation has a system turn at most at its head and then pairs of
user and assistant. Edits are Keep, Rerole (to user or assistant), Delete
(required for blank and repeated rows) and Insert (an empty user or assistant
turn). Kept or reroled rows whose text breaks off cost extra.

The search walks depth first through (rows done, who spoke last), edits in ASCII
order, within a cost bound; if it fails, the bound rises to the least cost that
was cut off. A table keeps for every state that failed the least that its end is
known to cost, so no state is entered again with a budget that failed. The first
accepting path is the answer: the cheapest, and of these the ASCII-least. States
start with the cheapest repairs of up to 32 stretches of rows, each over all ways
to enter and leave it; these add up to a lower bound. So the number of rounds
hardly grows with a conversation, and its search grows with its rows.

Texts are never gathered per conversation. The rows' features (who speaks, blank,
breaks off, hash of the text) are dealt by conversation without texts; a task
goes through them in order, holds those of one conversation and what its search
needs (some hundred bytes per row), and returns edits row by row. These are then
merged, again in order, with the texts, whose hash is taken as they pass: one
exchange of texts, one of them in memory at a time.

Defined cases: null role or text is one space, null conv_id is a conversation of
its own, null turn comes first; in the text the damage is drawn by a null is one
space, too. Rows of one turn go by role, then by the SHA-256 of their text; equal rows
are repeats. A role that starts with neither s, u nor a can only be reroled or
deleted. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .text import column

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3

_WHITE = r"\x20\x09-\x0D"
# Who spoke last: nobody, system, user, assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_TO_END = {_START: 0, _SYSTEM: 2 * INSERT, _USER: INSERT, _ASSISTANT: 0}
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}

# What the search needs to know of a row, as one byte.
_INITIALS = {"s": 1, "u": 2, "a": 3}
_MUST_GO, _BREAKS_OFF = 4, 8


def _moves(row: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """Edits at a row in ASCII order: name, cost, next state, rows done."""
    yield "D", DELETE, state, 1
    then = _NEXT[state]
    yield "I", INSERT, then, 0
    if not row & _MUST_GO:
        extra = TRUNCATED if row & _BREAKS_OFF else 0
        initial = row & 3
        if initial == _SYSTEM and state == _START:
            yield "K", KEEP + extra, _SYSTEM, 1
        elif initial == then:
            yield "K", KEEP + extra, then, 1
        yield "R", REROLE + extra, then, 1


_MOVES = [[list(_moves(row, state)) for state in range(4)] for row in range(16)]
_AT_END = [[("I", INSERT, _NEXT[state], 0)] for state in range(4)]


def lower_bounds(rows: bytes, stretches: int = 32, least: int = 4) -> list[int]:
    """For 4 * (rows done) + state: what the rest costs at least.

    Exact to the end of the row's stretch; each stretch behind it counts with
    its cheapest way in and out.
    """
    n = len(rows)
    length = max(least, -(-n // stretches))
    out = [0] * (4 * n) + [_TO_END[s] for s in range(4)]
    after = out[4 * n :]
    for at in range(n - 1, -1, -1):
        if (at + 1) % length == 0 and at + 1 < n:
            after = [min(after)] * 4
        moves = _MOVES[rows[at]]
        now = [min(cost + after[then] for _, cost, then, done in moves[s] if done) for s in range(4)]
        for _ in range(2):  # as many inserts as can pay off before one row
            now = [min(now[s], INSERT + now[_NEXT[s]]) for s in range(4)]
        out[4 * at : 4 * at + 4] = after = now
    return out


def search(rows: bytes, bounds: list[int] | None = None) -> tuple[int, str, int]:
    """Least cost, ASCII-least edits of that cost, and the number of rounds."""
    n = len(rows)
    known = lower_bounds(rows) if bounds is None else bounds  # raised where a state fails
    bound, rounds = known[0], 0
    path: list[str] = []
    while True:
        rounds += 1
        # Open states: place, budget left, edits yet to try, least cost seen from here.
        opened = [[0, bound, iter(_MOVES[rows[0]][0] if n else _AT_END[0]), 1 << 60]]
        path.clear()
        while opened:
            top = opened[-1]
            place, left = top[0], top[1]
            if place >= 4 * n and place - 4 * n in (_START, _ASSISTANT):
                return bound - left, "".join(path), rounds
            for name, cost, then, done in top[2]:
                to = 4 * (place // 4 + done) + then
                need = cost + known[to]
                if need > left:
                    top[3] = min(top[3], need)
                    continue
                at = place // 4 + done
                path.append(name)
                opened.append([to, left - cost, iter(_MOVES[rows[at]][then] if at < n else _AT_END[then]), 1 << 60])
                break
            else:
                opened.pop()
                known[place] = max(known[place], top[3])
                if opened:
                    path.pop()
                    above = opened[-1]
                    above[3] = min(above[3], above[1] - left + known[place])
        bound = known[0]


# --- damage -------------------------------------------------------------------------


def _plain(turns: DataFrame) -> DataFrame:
    """The four columns; null texts and roles as one space."""
    space = F.lit(" ")
    return turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))


def damage(turns: DataFrame) -> DataFrame:
    """Damage drawn from conversation and turn: rows dropped, emptied, without end marks, repeated, or given to the user."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = _plain(turns).withColumn("__draw", F.crc32(name.cast("binary")) % 20)
    draw = F.col("__draw")
    text = F.when(draw == 1, F.lit("")).when(draw == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    damaged = rows.where(draw != 0).withColumns({"text": text, "role": F.when(draw == 4, F.lit("user")).otherwise(F.col("role"))})
    times = F.when(draw == 3, F.lit(2)).otherwise(F.lit(1))
    return damaged.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), times))).drop("__draw", "__copy")


# --- rows in order ---------------------------------------------------------------------

_ORDER = ("turn", "role", "digest")


def _is_blank(text: Column) -> Column:
    return ~text.rlike(f"[^{_WHITE}]")


def _breaks_off(text: Column) -> Column:
    """The last character that is no white space is no end mark."""
    return ~text.rlike(rf"[.!?][{_WHITE}]*\z")


def _ordered(*extra: str) -> list[Column]:
    """Conversation by conversation, in the order of their rows."""
    keys = ("conv_id", *_ORDER, *extra)
    return [F.col(name).asc_nulls_first() for name in keys]


def _features(rows: DataFrame) -> DataFrame:
    """Per row, without its text: what the search and the counts need."""
    text = F.col("text")
    initial = F.substring("role", 1, 1)
    code = F.lit(0)
    for letter, value in _INITIALS.items():
        code = F.when(initial == letter, value).otherwise(code)
    flags = {"initial": code.cast("byte"), "blank": _is_blank(text), "breaks_off": _breaks_off(text)}
    return rows.withColumns(flags).select("conv_id", *_ORDER, *flags)


_EDITS = "conv_id long, turn long, role string, digest binary, at long, edit string, fault string, illegal int, cost int"
_SPOKEN = {1: "s", 2: "u", 3: "a"}


def _edit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of whole conversations in order; the same rows with what becomes of them.

    `at` is the row's place, `edit` the edits up to and including its own; the
    last row has the inserts behind it as well. `cost` is the conversation's, on its last row.
    """
    held: list[pa.RecordBatch] = []
    current: object = None

    def solved() -> Iterator[pa.RecordBatch]:
        rows, faults, illegal = bytearray(), [], []
        last, seen = None, set()
        for part in held:
            roles, digests = column(part, "role").to_pylist(), column(part, "digest").to_pylist()
            marks = (column(part, name).to_pylist() for name in ("initial", "blank", "breaks_off"))
            for role, digest, initial, blank, breaks_off in zip(roles, digests, *marks, strict=True):
                name = hashlib.blake2b(role.encode() + b"\0" + digest, digest_size=16).digest()
                repeated = name in seen
                seen.add(name)
                fault = "blank" if blank else "duplicate" if repeated else "truncated" if breaks_off else None
                faults.append(fault)
                rows.append(initial | (_MUST_GO if blank or repeated else 0) | (_BREAKS_OFF if fault == "truncated" else 0))
                pair = f"{_SPOKEN.get(last, '-')}{_SPOKEN.get(initial, '-')}"
                illegal.append(int(last is not None and pair not in ("su", "ua", "au")))
                last = initial
        seen.clear()
        cost, path, _ = search(bytes(rows))
        edits, begin = [], 0
        for at, name in enumerate(path):
            if name != "I":
                edits.append(path[begin : at + 1])
                begin = at + 1
        edits[-1] += path[begin:]
        costs = [None] * (len(rows) - 1) + [cost]
        at = 0
        for part in held:
            to = at + part.num_rows
            keys = [column(part, name) for name in ("conv_id", *_ORDER)]
            new = [
                pa.array(range(at, to), pa.int64()),
                pa.array(edits[at:to], pa.string()),
                pa.array(faults[at:to], pa.string()),
                pa.array(illegal[at:to], pa.int32()),
                pa.array(costs[at:to], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays([*keys, *new], names=["conv_id", *_ORDER, "at", "edit", "fault", "illegal", "cost"])
            at = to

    for batch in batches:
        ids = column(batch, "conv_id").to_pylist()
        at = 0
        while at < len(ids):
            if held and ids[at] != current:
                yield from solved()
                held.clear()
            current, to = ids[at], at
            while to < len(ids) and ids[to] == current:
                to += 1
            held.append(batch.slice(at, to - at))
            at = to
    if held:
        yield from solved()


def edits(rows: DataFrame) -> DataFrame:
    """What becomes of each row (conv_id, turn, role, text): the order's columns, edit, fault, illegal, cost."""
    dealt = _features(with_digest(rows)).repartition("conv_id").sortWithinPartitions(*_ordered())
    return dealt.mapInArrow(_edit_rows, _EDITS)


def with_digest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


_RESULT = "conv_id long, cost long, blank long, duplicate long, truncated long, illegal long, audit string, repaired_sha256 string"


class _Open:
    """One conversation while its rows pass."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.audit: list[str] = []
        self.count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.hash = hashlib.sha256()
        self.state, self.begun = _START, False

    def say(self, role: str, text: str) -> None:
        if self.begun:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode())
        self.begun = True

    def add(self, role: str, text: str, edit: str) -> None:
        self.audit.append(edit)
        for name in edit:
            if name == "D":
                continue
            if name == "K" and role[:1] == "s":
                self.state = _SYSTEM
            else:
                self.state = _NEXT[self.state]
            if name == "K":
                self.say(role, text)
            else:
                self.say(_NAMES[self.state], text if name == "R" else "")

    def row(self) -> tuple:
        counts = [self.count[k] for k in ("cost", "blank", "duplicate", "truncated", "illegal")]
        return (self.conv_id, *counts, "".join(self.audit), self.hash.hexdigest())


def _merge(hand_on: Callable[[_Open], tuple]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [part.split()[0] for part in _RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one: _Open | None = None
        # What becomes of equal rows comes before them: edits, and how many rows in turn have them.
        pending: deque[list] = deque()
        for batch in batches:
            done = []
            cells = (column(batch, c).to_pylist() for c in ("conv_id", "edit", "fault", "illegal", "cost", "role", "text"))
            for conv_id, edit, fault, illegal, cost, role, text in zip(*cells, strict=True):
                if one is None or conv_id != one.conv_id:
                    if one is not None:
                        done.append(hand_on(one))
                    one = _Open(conv_id)
                if edit is not None:
                    if pending and pending[-1][0] == edit:
                        pending[-1][1] += 1
                    else:
                        pending.append([edit, 1])
                    if fault:
                        one.count[fault] += 1
                    one.count["illegal"] += illegal
                    one.count["cost"] += cost or 0
                else:
                    one.add(role, text, pending[0][0])
                    pending[0][1] -= 1
                    if not pending[0][1]:
                        pending.popleft()
            if done:
                yield pa.RecordBatch.from_pydict({n: list(c) for n, c in zip(names, zip(*done, strict=True), strict=True)}, _schema())
        if one is not None:
            yield pa.RecordBatch.from_pydict({n: [c] for n, c in zip(names, hand_on(one), strict=True)}, _schema())

    return run


def _schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (part.split() for part in _RESULT.split(", "))])


def repaired(rows: DataFrame) -> DataFrame:
    """Per conversation of `rows` (conv_id, turn, role, text): counts, cost, audit, hash of the repaired text."""
    texts = with_digest(rows)
    found = stage(edits(rows), "conversation-edits")
    both = found.withColumn("text", F.lit(None).cast("string")).withColumn("is_text", F.lit(False)).unionByName(
        texts.withColumn("is_text", F.lit(True)), allowMissingColumns=True
    )
    merged = both.repartition("conv_id").sortWithinPartitions(*_ordered("is_text", "at"))
    return merged.mapInArrow(_merge(_Open.row), _RESULT)


def repair(turns: DataFrame, harm: Callable[[DataFrame], DataFrame] | None = damage) -> DataFrame:
    """Per conversation of `turns`: gaps, the faults found, and its cheapest repair, after `harm` (None: as it is)."""
    rows = harm(turns) if harm else _plain(turns)
    rows = rows.withColumns({"turn": F.col("turn").cast("long"), "conv_id": F.col("conv_id").cast("long")})
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = rows.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).alias("gaps"))
    found = repaired(rows)
    return _complete(turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct(), gaps, found)


def _complete(conversations: DataFrame, gaps: DataFrame, found: DataFrame) -> DataFrame:
    """All three by conversation; null is a conversation, so one aggregate serves as the join."""
    parts = conversations.unionByName(gaps, allowMissingColumns=True).unionByName(found, allowMissingColumns=True)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    one = parts.groupBy("conv_id").agg(*[F.max(name).alias(name) for name in (*counts, "audit", "repaired_sha256")])
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return one.select(
        "conv_id",
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", empty).alias("repaired_sha256"),
    )
