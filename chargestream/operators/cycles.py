"""Flush cycles as a worker cuts them: on size, or when the last flush is long enough ago.

A worker looks at its buffer every `poll` seconds. It flushes what is there if
that is `cap` messages or more, or if its last flush started `interval` seconds
ago or earlier. So where a flush falls depends on all flushes before it. It is
found in parallel all the same, because a worker's state after a poll is one
number: how many polls ago it flushed last, as far as that matters.

1. Messages are counted per key and poll (partial sums; the rows themselves stay
   where they are). From here on a key has a row per poll that saw messages,
   however many these were.
2. A key's polls are cut into buckets of `_BUCKET` rows. Each bucket is played
   for every state a worker may enter it in, all at once; states soon fall
   together. What comes out is the bucket's map from entry to exit.
3. The maps of a key are applied one after the other (a narrow row per bucket),
   which says in which state each bucket is really entered.
4. Each bucket is played once more from that state. It sees the polls of an
   interval before and behind it, so every flush it has part in is complete.

The messages then learn their flush by a join on key and poll. Their place in it
is that of their poll plus their rank within the poll, which needs no further
exchange.

Polls are aligned to the epoch; a message counts for the poll that ends its
tick. A key's worker starts one poll before its first message. Rows without a
key or a time belong to no flush. What is left at the end is flushed when its
interval is over. An interval of more than `_BUCKET` polls is looked at `_BUCKET` times.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..session import stage
from .ordering import with_position

# Rows of one bucket, and the most polls an interval may have.
_BUCKET = 4096

INTERVAL, COUNT = "interval", "count"


def _micros(seconds: Column | float) -> Column:
    given = seconds if isinstance(seconds, Column) else F.lit(float(seconds))
    return F.greatest(F.round(F.least(given * 1_000_000, F.lit(9e15))).cast("bigint"), F.lit(1))


def with_tick(df: DataFrame, interval: Column | float, poll: Column | float) -> DataFrame:
    """Add the poll's length, the polls of an interval, and the row's poll."""
    length = F.greatest(_micros(poll), F.ceil(F.col("__interval") / _BUCKET))
    rows = df.withColumn("__interval", _micros(interval)).withColumn("__poll", length)
    steps = F.ceil(F.col("__interval") / F.col("__poll")).cast("int")
    micros = F.unix_micros(F.col("captured_ts").cast("timestamp"))
    return rows.withColumns({"__steps": steps, "__tick": F.floor(micros / F.col("__poll"))}).drop("__interval")


def _with_neighbours(ticks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each poll in its bucket, and in the next and the one before if it is within an interval of their edge."""
    placed = with_position(ticks, keys, "__at", order=F.col("__tick"))
    bucket = F.expr(f"__at div {_BUCKET}")
    inside = F.col("__at") % _BUCKET
    after = F.when((inside < F.col("__steps")) & (bucket > 0), F.struct((bucket - 1).alias("bucket"), F.lit(1).alias("side")))
    before = F.when(inside >= _BUCKET - F.col("__steps"), F.struct((bucket + 1).alias("bucket"), F.lit(-1).alias("side")))
    own = F.struct(bucket.alias("bucket"), F.lit(0).alias("side"))
    spread = placed.withColumn("__in", F.explode(F.array_compact(F.array(before, own, after))))
    return spread.select(*keys, F.col("__in.bucket").alias("__bucket"), F.col("__in.side").alias("__side"), "__tick", "__n", "__steps")


class _Bucket:
    """A bucket's polls in order: their numbers, messages before each, and which are its own."""

    def __init__(self, rows: pa.Table):
        tick = rows.column("__tick").to_numpy()
        order = np.argsort(tick)
        self.tick = tick[order]
        self.upto = np.concatenate([[0], np.cumsum(rows.column("__n").to_numpy()[order])])
        side = rows.column("__side").to_numpy()[order]
        self.first, self.end = int(np.searchsorted(side, 0)), int(np.searchsorted(side, 0, side="right"))
        self.steps = int(rows.column("__steps")[0].as_py())

    def exits(self, cap: int) -> np.ndarray:
        """For 1 to `steps` polls since the last flush at the first own poll: how many at the last one, 0 if it flushes."""
        age = np.arange(1, self.steps + 1)
        back = np.arange(self.steps)
        for at in range(self.first, self.end):
            now = self.tick[at]
            if at > self.first:
                age = next_age(age, int(now - self.tick[at - 1]), self.steps)
            waiting = self.upto[at + 1] - self.upto[np.searchsorted(self.tick, now - age, side="right")]
            age = np.where((age >= self.steps) | (waiting >= cap), 0, age)
            if len(age) > 1:
                age, same = np.unique(age, return_inverse=True)
                back = same[back]
        return age[back]

    def flushes(self, last: int, cap: int) -> list[tuple[int, int, str, int]]:
        """Own polls with the poll they are flushed at, why, and the messages of that flush in earlier polls."""
        out: list[tuple[int, int, str, int]] = []
        ticks, upto = self.tick.tolist(), self.upto.tolist()
        begin = int(np.searchsorted(self.tick, last, side="right"))  # first poll that is not flushed yet
        at = self.first

        def flush(at_tick: int, to: int, why: str) -> None:
            nonlocal begin, last
            own = range(max(begin, self.first), min(to, self.end))
            out.extend((ticks[i], at_tick, why, upto[i] - upto[begin]) for i in own)
            begin, last = to, at_tick

        while begin < self.end:
            if at == len(ticks):
                flush(last + self.steps, at, INTERVAL)
                break
            now = ticks[at]
            if begin < at and now > last + self.steps:
                flush(last + self.steps, at, INTERVAL)
            elif upto[at + 1] - upto[begin] >= cap:
                flush(now, at + 1, COUNT)
                at += 1
            elif now - last >= self.steps:
                flush(now, at + 1, INTERVAL)
                at += 1
            else:
                at += 1
        return out


def next_age(age: np.ndarray, gap: int, steps: int) -> np.ndarray:
    """Polls since the last flush at the next poll with messages, `gap` polls on.

    0 means that the last one flushed. Others have messages waiting, which are
    flushed in between if their interval ends there.
    """
    later = np.where((age > 0) & (age + gap > steps), age + gap - steps, age + gap)
    return np.minimum(later, steps)


def _entries(maps: DataFrame, keys: list[str]) -> DataFrame:
    """When the last flush before each bucket was: `__last`, a poll."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("__bucket")
        last = []
        before = None
        for first, end, exits in zip(*(rows.column(c).to_pylist() for c in ("__first", "__end", "__exits")), strict=True):
            steps = len(exits)
            age = 1 if before is None else int(next_age(np.array([before[1]]), first - before[0], steps)[0])
            last.append(first - age)
            before = (end, exits[age - 1])
        return rows.select([*keys, "__bucket"]).append_column("__last", pa.array(last, pa.int64()))

    fields = ", ".join(f"`{name}` {maps.schema[name].dataType.simpleString()}" for name in keys)
    return maps.groupBy(*keys).applyInArrow(run, f"{fields}, __bucket long, __last long")


def _grouped(df: DataFrame, keys: list[str], run, added: str) -> DataFrame:
    fields = ", ".join(f"`{name}` {df.schema[name].dataType.simpleString()}" for name in keys)
    return df.groupBy(*keys, "__bucket").applyInArrow(run, f"{fields}, {added}")


def flush_polls(ticks: DataFrame, keys: Sequence[str], cap: int) -> DataFrame:
    """Per key and poll with messages (`__tick`, `__n`, `__steps`): `__flush`, the poll it is flushed at, `trigger`, and
    `__before`, the messages of that flush in earlier polls."""
    keys = list(keys)
    polls = stage(_with_neighbours(ticks, keys), "flush-polls")

    def exits(rows: pa.Table) -> pa.Table:
        own = _Bucket(rows)
        columns = {name: rows.column(name)[:1] for name in [*keys, "__bucket"]}
        found = {"__first": [int(own.tick[own.first])], "__end": [int(own.tick[own.end - 1])]}
        return pa.table({**columns, **found, "__exits": pa.array([own.exits(cap).tolist()], pa.list_(pa.int32()))})

    # A bucket that only has neighbours' polls does not exist.
    real = polls.where("__side = 0").groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__rows")).drop("__rows")
    inside = polls.join(real, [*keys, "__bucket"], "left_semi")
    maps = _grouped(inside, keys, exits, "__bucket long, __first long, __end long, __exits array<int>")
    entered = stage(_entries(stage(maps, "flush-maps"), keys), "flush-entries")

    def flushes(rows: pa.Table) -> pa.Table:
        found = _Bucket(rows).flushes(rows.column("__last")[0].as_py(), cap)
        tick, flush, why, before = zip(*found, strict=True)
        columns = {name: pa.array([rows.column(name)[0].as_py()] * len(found), rows.schema.field(name).type) for name in keys}
        own = {"__tick": pa.array(tick, pa.int64()), "__flush": pa.array(flush, pa.int64())}
        return pa.table({**columns, **own, "trigger": pa.array(why), "__before": pa.array(before, pa.int64())})

    played = polls.join(entered, [*keys, "__bucket"])
    return _grouped(played, keys, flushes, "__tick long, __flush long, trigger string, __before long")


def with_exact_cycle(
    df: DataFrame,
    interval: Column | float = C.DEFAULT_FLUSH_INTERVAL,
    poll: Column | float = C.POLL_INTERVAL,
    cap: int = C.BATCH_CAP,
    keys: Sequence[str] = ("client_id",),
) -> DataFrame:
    """Add `cycle`, when the flush of a message started, `trigger` (`count` or `interval`) and its `chunk` of `cap` messages.

    `interval` and `poll` may be columns, which have one value per key.
    """
    keys = list(keys)
    timed = with_tick(df, interval, poll)
    complete = _complete(keys)
    counted = timed.where(complete).groupBy(*keys, "__tick").agg(F.count(F.lit(1)).alias("__n"), F.max("__steps").alias("__steps"))
    polls = stage(flush_polls(counted, keys, cap), "flush-cycles")
    found = timed.where(complete).join(polls, [*keys, "__tick"])
    rank = F.row_number().over(Window.partitionBy(*keys, "__tick").orderBy("seq")) - 1
    added = {
        "cycle": F.timestamp_micros((F.col("__flush") + 1) * F.col("__poll")),
        "__rank": rank,
    }
    placed = found.withColumns(added).withColumn("chunk", F.expr(f"(__before + __rank) div {int(cap)}"))
    names = [*df.columns, "cycle", "trigger", "chunk"]
    return placed.select(*names).unionByName(df.where(~_complete(keys)), allowMissingColumns=True)


def _complete(keys: Sequence[str]) -> Column:
    known = F.col("captured_ts").isNotNull()
    for name in keys:
        known = known & F.col(name).isNotNull()
    return known
