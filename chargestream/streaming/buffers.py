"""Flushes of a stream on size or interval, per client, from any source.

A client's messages wait in state until its worker would flush them (see
`operators.cycles`): when `cap` messages wait, or when its last flush is
`interval` old, seen at polls. A timer is set for the next poll that can matter,
so a client costs nothing while nothing happens, and its interval, which may
differ from others', is kept with its state. With the clock of the messages the
flushes are those of the table operator, however the messages were dealt to
micro-batches; with the machine's clock a message counts when it arrives.

State is what waits, as one blob per micro-batch and client, in RocksDB and so
on disk; it holds less than `cap` messages of a client plus those of polls that
are not over. One client's messages of one micro-batch are one group, as a worker
is one thread; the source's rate limit bounds them.

With the clock of the messages the watermark is the time. A message that comes
later than `delay` allows is dropped by Spark, which counts it in the query's
progress (`numRowsDroppedByWatermark`); with the machine's clock none is.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import LongType, StringType, StructType, TimestampType

from .. import constants as C
from ..operators.cycles import COUNT, INTERVAL, with_tick

ARRIVAL, CAPTURE = "arrival", "capture"
_NONE = -(1 << 62)


def play(ticks: np.ndarray, counts: np.ndarray, waiting: int, last: int, steps: int, cap: int, upto: int) -> tuple[list[tuple[int, str, int]], int, int]:
    """Flushes of a worker in which `waiting` messages wait, from the polls `ticks` on and until the poll `upto`.

    Gives (poll, trigger, messages) of each, what waits then, and the last flush.
    """
    out: list[tuple[int, str, int]] = []
    for tick, n in zip(ticks.tolist(), counts.tolist(), strict=True):
        if waiting and tick > last + steps:
            out.append((last + steps, INTERVAL, waiting))
            last, waiting = last + steps, 0
        waiting += n
        if waiting >= cap or tick - last >= steps:
            out.append((tick, COUNT if waiting >= cap else INTERVAL, waiting))
            last, waiting = tick, 0
    if waiting and last + steps <= upto:
        out.append((last + steps, INTERVAL, waiting))
        last, waiting = last + steps, 0
    return out, waiting, last


class _Buffer(StatefulProcessor):
    """One client's worker. State: what waits, the last flush, the last poll that was looked at, the timer, poll and interval."""

    def __init__(self, given: list[str], columns: list[str], cap: int, arrival: bool):
        self.given, self.columns, self.cap, self.arrival = given, columns, cap, arrival

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.worker = handle.getValueState("worker", "last long, seen long, timer long, poll long, steps long")
        self.blobs = handle.getListState("blobs", "blob binary")

    def _now(self, values: TimerValues) -> int:
        """Microseconds."""
        return 1000 * (values.getCurrentProcessingTimeInMs() if self.arrival else values.getCurrentWatermarkInMs())

    def _set_timer(self, old: int, tick: int, poll: int) -> int:
        """A timer for the end of a poll; the old one goes."""
        new = -(-(tick + 1) * poll // 1000) + 1  # the first millisecond after it
        if new != old:
            if old != _NONE:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(new)
        return new

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        last, seen, timer, poll, steps = self.worker.get() or (_NONE, _NONE, _NONE, 0, 0)
        first = None
        for part in rows:
            part.columns = self.given  # names that are no identifiers come changed
            poll, steps = int(part["__poll"].iloc[-1]), int(part["__steps"].iloc[-1])
            if self.arrival:
                part = part.assign(__tick=self._now(timerValues) // poll)
            # A message of a poll that is over counts at the next one.
            part["__tick"] = part["__tick"].clip(lower=seen + 1)
            earliest = int(part["__tick"].min())
            first = earliest if first is None else min(first, earliest)
            self.blobs.appendValue((pickle.dumps(part.drop(columns=["__poll", "__steps"]), 5),))
        if last == _NONE:
            last = first - 1
        due = -(-(first + 1) * poll // 1000) + 1
        if timer == _NONE or due < timer:
            timer = self._set_timer(timer, first, poll)
        self.worker.update((last, seen, timer, poll, steps))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, seen, _, poll, steps = self.worker.get()
        over = self._now(timerValues) // poll - 1  # the last poll that is over
        held = pd.concat([pickle.loads(blob) for (blob,) in self.blobs.get()], ignore_index=True)
        held = held.sort_values(["__tick", "seq"], kind="stable", ignore_index=True)
        ticks = held["__tick"].to_numpy()
        begin, end = np.searchsorted(ticks, [seen, over], side="right").tolist()
        polls, counts = np.unique(ticks[begin:end], return_counts=True)
        flushes, waiting, last = play(polls, counts, begin, last, steps, self.cap, over)
        seen = max(seen, over)
        gone = end - waiting
        timer = _NONE
        if gone < len(held):
            self.blobs.put([(pickle.dumps(held.iloc[gone:], 5),)])
            after = [int(ticks[end])] if end < len(held) else []
            timer = self._set_timer(_NONE, min(after + [last + steps] * bool(waiting)), poll)
        else:
            self.blobs.clear()
        self.worker.update((last, seen, timer, poll, steps))
        if not gone:
            return iter(())
        out = held.iloc[:gone][self.columns].copy()
        sizes = [n for *_, n in flushes]
        out["cycle"] = pd.to_datetime(np.repeat([(tick + 1) * poll for tick, *_ in flushes], sizes), unit="us")
        out["trigger"] = np.repeat([why for _, why, _ in flushes], sizes)
        out["chunk"] = np.concatenate([np.arange(n) for n in sizes]) // self.cap
        return iter([out])


def buffered(
    captures: DataFrame,
    interval: Column | float = C.DEFAULT_FLUSH_INTERVAL,
    poll: Column | float = C.POLL_INTERVAL,
    cap: int = C.BATCH_CAP,
    keys: tuple[str, ...] = ("client_id",),
    clock: str = ARRIVAL,
    delay: str = "0 seconds",
) -> DataFrame:
    """Messages of a stream as their clients' workers flush them, with `cycle`, `trigger` and `chunk`.

    `interval` may be a column, such as that of a client's configuration; the
    value that a client's latest message carries holds. Every message needs
    `captured_ts` (see `stamp_received`).
    """
    schema = StructType([*captures.schema.fields]).add("cycle", TimestampType()).add("trigger", StringType()).add("chunk", LongType())
    arrival = clock == ARRIVAL
    timed = with_tick(captures if arrival else captures.withWatermark("captured_ts", delay), interval, poll)
    worker = _Buffer(timed.columns, captures.columns, cap, arrival)
    mode = "ProcessingTime" if arrival else "EventTime"
    return timed.groupBy(*keys).transformWithStateInPandas(worker, schema, "Append", mode)
