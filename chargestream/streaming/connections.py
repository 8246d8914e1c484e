"""Connection ids on a stream.

State per charger, in RocksDB: where its connects of the last `keep` sequence
numbers are, and how many there were before. So every event gets the connection
of its own place, also when it comes late. A connect that comes late renumbers
those after it: `revised_ordinals` sends the events it moves once more, under a
higher revision, and `settled` takes the latest. It keeps the places of a
charger's last events for that, too, and needs keys, `seq` and event type only.

`assign_connections` numbers whole rows once, as they come. For its ids to be
those of a table, connects must not come after frames of a later place; frames
may come in any order. An event from before the kept places gets the number of
connects that had left them.

A charger's events of one micro-batch are one group, which the source's rate
limit bounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import IntegerType, LongType, StructType

from .. import constants as C
from ..functions import non_blank
from ..operators.sessions import with_connection_id

# How far behind its charger's latest event, in sequence numbers, an event may come.
KEEP = 1 << 20

_KEYS = ("client_id", "charger_id")
_LEAST = -(1 << 63)


class _Charger(StatefulProcessor):
    def __init__(self, columns: list[str], keep: int, revise: bool):
        self.columns, self.keep, self.revise = columns, keep, revise

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "before long, revision int, connects binary, events binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        before, revision, *kept = self.known.get() or (0, -1, b"", b"")
        old_connects, old_events = (np.frombuffer(places, np.int64) for places in kept)
        parts = [part.set_axis(self.columns, axis=1) for part in rows]  # names that are no identifiers come changed
        places = np.concatenate([part["seq"].to_numpy(np.int64) for part in parts])
        is_connect = np.concatenate([(part["event_type"] == C.CONNECT).to_numpy() for part in parts])
        connects = np.sort(np.concatenate([old_connects, places[is_connect]]))

        def ordinal(at: np.ndarray, among: np.ndarray = connects) -> np.ndarray:
            return before + np.searchsorted(among, at, side="right")

        out = []
        revision += 1
        if self.revise:
            moved = old_events[ordinal(old_events) != ordinal(old_events, old_connects)]
            sent = np.concatenate([places, moved])
            out.append(pd.DataFrame({**dict(zip(_KEYS, key, strict=True)), "seq": sent, "ordinal": ordinal(sent), "revision": np.int32(revision)}))
        else:
            out += [part.assign(ordinal=ordinal(part["seq"].to_numpy(np.int64))) for part in parts]

        events = np.concatenate([old_events, places]) if self.revise else np.array([max([*old_events, *places.tolist()])])
        least = max(int(events.max()) - self.keep, _LEAST)
        gone = int(np.searchsorted(connects, least))
        state = (before + gone, revision, connects[gone:].tobytes(), events[events >= least].astype(np.int64).tobytes())
        self.known.update(state)
        return iter(out)


def _numbered(events: DataFrame, schema: StructType, keep: int, revise: bool) -> DataFrame:
    worker = _Charger(events.columns, keep, revise)
    return events.groupBy(*_KEYS).transformWithStateInPandas(worker, schema, "Append", "None")


def with_connection_ordinal(events: DataFrame, keep: int = KEEP) -> DataFrame:
    """Add `ordinal`: how many connects the charger has had up to this event."""
    schema = StructType([*events.schema.fields]).add("ordinal", LongType())
    return _numbered(events, schema, keep, revise=False)


def revised_ordinals(events: DataFrame, keep: int = KEEP) -> DataFrame:
    """client_id, charger_id, seq and `ordinal` of every event, sent again under a higher `revision` when it changes."""
    narrow = events.select(*_KEYS, "seq", "event_type")
    schema = StructType([narrow.schema[name] for name in (*_KEYS, "seq")]).add("ordinal", LongType()).add("revision", IntegerType())
    return _numbered(narrow, schema, keep, revise=True)


def settled(revised: DataFrame) -> DataFrame:
    """The latest ordinal of every event, of what `revised_ordinals` has sent."""
    return revised.groupBy(*_KEYS, "seq").agg(F.max_by("ordinal", "revision").alias("ordinal"))


def assign_connections(events: DataFrame, keep: int = KEEP) -> DataFrame:
    """Give every event of a stream the id of its connection.

    Events without a charger are rejected by admission whatever their id. They
    get none, so that they do not pile up in one state group.
    """
    has_charger = non_blank(F.col("charger_id"))
    known = with_connection_ordinal(events.where(has_charger), keep).transform(with_connection_id)
    unknown = events.where(~has_charger).withColumn("connection_id", F.lit(None).cast("string"))
    return known.drop("ordinal").unionByName(unknown)
