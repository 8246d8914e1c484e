"""Delivery outcomes of a stream of attempts.

Attempts of a batch arrive one by one, in any order. State per batch is the
answer to each attempt up to the limit; batches whose ids are neighbours keep it
together. A batch is settled, and sent out once,
when all attempts up to a decisive one are known, or all that are allowed;
attempts that come later change nothing. A batch without a new attempt for
`forget` seconds is forgotten, settled or not, so that state does not grow with
time; its later attempts alone never settle it again, as the first is missing.
With `forget` the machine's clock runs the stream, which then does not end by
itself: to drain what is there (`availableNow`), pass None.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

from .. import constants as C
from ..operators.delivery import judged

FORGET = 86_400.0

# Ids that are neighbours, 2**10 at most, have one state, which is read and written once per micro-batch: each call of the
# state store costs far more than what a batch holds. A checkpoint is bound to this number.
_NEIGHBOURS = 10

_UNKNOWN = -1
_SETTLED = "batch_id long, protocol string, n_messages long, attempts int, final_status int, decided boolean"
# One element per batch; `seen` is when its last attempt came.
_HELD = "batch_id array<long>, protocol array<string>, n_messages array<long>, settled array<boolean>, {}, seen array<long>".format(
    ", ".join(f"s{attempt} array<int>" for attempt in range(C.MAX_ATTEMPTS))
)


def settle(statuses: list[int]) -> tuple[int, int, bool] | None:
    """Attempts made, the last status and whether it decided; None while more may come."""
    for attempt, status in enumerate(statuses):
        if status == _UNKNOWN:
            return None
        if status == C.ACCEPTED_STATUS or status in C.PERMANENT_STATUSES:
            return attempt + 1, status, True
    return len(statuses), statuses[-1], False


class _Attempts(StatefulProcessor):
    def __init__(self, forget: float | None):
        self.forget = forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl = None if self.forget is None else int(self.forget * 1000)
        self.batches = handle.getValueState("batches", _HELD, ttl)

    def _known(self, now: int) -> dict[int, tuple]:
        """State of the neighbours by batch, but for those to be forgotten: a neighbour's attempts do not keep them."""
        held = self.batches.get()
        if held is None:
            return {}
        rows = {batch: state for batch, *state in zip(*held, strict=True)}
        return rows if self.forget is None else {batch: state for batch, state in rows.items() if now < state[-1] + int(self.forget * 1000)}

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        now = 0 if self.forget is None else timerValues.getCurrentProcessingTimeInMs()
        known = self._known(now)
        new = (None, None, False, *[_UNKNOWN] * C.MAX_ATTEMPTS, now)
        arrived: dict[int, list] = {}
        for part in rows:
            cells = (part[name].tolist() for name in ("batch_id", "protocol", "n_messages", "attempt", "status"))
            for batch, of, n, attempt, status in zip(*cells, strict=True):
                if batch not in arrived:
                    arrived[batch] = list(known.get(batch, new))
                state = arrived[batch]
                state[0] = max(filter(None, (state[0], of)), default=None)
                state[1] = int(n) if state[1] is None else max(state[1], int(n))
                if attempt < C.MAX_ATTEMPTS and state[3 + int(attempt)] == _UNKNOWN:
                    state[3 + int(attempt)] = int(status)
        out = []
        for batch, state in arrived.items():
            protocol, n_messages, settled, *statuses, _ = state
            found = None if settled else settle(statuses)
            known[batch] = (protocol, n_messages, settled or found is not None, *statuses, now)
            if found is not None:
                out.append((batch, protocol, n_messages, *found))
        self.batches.update(tuple(map(list, zip(*((batch, *state) for batch, state in known.items()), strict=True))))
        if out:
            names = [part.split()[0] for part in _SETTLED.split(", ")]
            yield pd.DataFrame(out, columns=names)


def delivery_outcomes(attempts: DataFrame, forget: float | None = FORGET) -> DataFrame:
    """Settled batches with their outcome and reason, each once; batches that are still under way are not sent out."""
    known = attempts.where("batch_id is not null and attempt is not null")
    rows = known.select(
        "batch_id", "protocol", F.coalesce("n_messages", F.lit(0)).alias("n_messages"), "attempt", F.coalesce("status", F.lit(0)).alias("status")
    )
    clock = "None" if forget is None else "ProcessingTime"
    near = rows.withColumn("near", F.shiftright("batch_id", _NEIGHBOURS))
    return judged(near.groupBy("near").transformWithStateInPandas(_Attempts(forget), _SETTLED, "Append", clock))
