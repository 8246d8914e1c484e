"""A stream of captures, flushed micro-batch by micro-batch.

Spark runs one micro-batch at a time, which is the single-flight rule, and each
one is a flush: it empties the buffers, so buffers need no state between
flushes. A flush that is run again replaces its own folders.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import ExitStack, contextmanager, suppress

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StringType, StructField, StructType

from .. import constants as C
from .. import schemas
from ..plans.flush import batches, flush
from ..sources.sinks import write_envelopes, write_records, write_rejected
from . import manifest


@contextmanager
def _kept(df: DataFrame) -> Iterator[DataFrame]:
    """A part of a micro-batch that several writes read; what is lost is computed again."""
    kept = df.persist()
    kept.count()
    try:
        yield kept
    finally:
        kept.unpersist()


class FlushFailed(RuntimeError):
    """A micro-batch that could not be written; it runs again when the stream is started again."""


def flush_into(
    path: str,
    prepare: Callable[[DataFrame], DataFrame],
    protocol: str,
    capacity: Column | int | None = None,
    keys: Sequence[str] = ("client_id",),
    envelopes: bool = False,
) -> Callable[[DataFrame, int], None]:
    """The function that handles one micro-batch.

    It writes `records/`, `rejected/` and, on request, `envelopes/`, each with
    one folder per flush, and then commits the flush to the manifest. Nothing is
    pushed out unless a `capacity` is given.
    """

    def run(captures: DataFrame, flush_id: int) -> None:
        try:
            write(captures, flush_id)
        except Exception as error:
            # Spark searches the text of what went wrong, and cannot take a very long one.
            raise FlushFailed(f"flush {flush_id}: {type(error).__name__}: {str(error)[:2000]}") from None

    def write(captures: DataFrame, flush_id: int) -> None:
        with ExitStack() as held:
            def hold(part: DataFrame) -> DataFrame:
                return held.enter_context(_kept(part))

            flushed = flush(hold(prepare(captures)), protocol, capacity, keys, hold)
            write_records(flushed.records, f"{path}/records/flush={flush_id}")
            write_rejected(flushed.rejected, f"{path}/rejected/flush={flush_id}")
            if envelopes:
                bodies = batches(flushed.records, protocol, keys)
                write_envelopes(bodies, f"{path}/envelopes/flush={flush_id}")
            kinds = (manifest.RECORDS, manifest.REJECTED, *([manifest.ENVELOPES] if envelopes else []))
            manifest.commit(captures.sparkSession, path, manifest.Entry(flush_id, flush_id, False, kinds))

    return run


def start_flushing(
    captures: DataFrame,
    path: str,
    prepare: Callable[[DataFrame], DataFrame],
    protocol: str,
    interval: float | None = C.DEFAULT_FLUSH_INTERVAL,
    **options,
) -> StreamingQuery:
    """Start the stream. It flushes every `interval` seconds; None drains what is there and ends."""
    writer = captures.writeStream.foreachBatch(flush_into(path, prepare, protocol, **options))
    writer = writer.option("checkpointLocation", f"{path}/_progress")
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval} seconds").start()


def force_flush(query: StreamingQuery) -> None:
    """Flush what has arrived by now."""
    query.processAllAvailable()


class Closed:
    """How a stream ended: true if nothing was left. `behind` has what each source still held, where it says so."""

    def __init__(self, drained: bool, behind: dict[str, dict[str, str]]):
        self.drained, self.behind = drained, behind

    def __bool__(self) -> bool:
        return self.drained


class _Latest(StreamingQueryListener):
    """The latest progress of one query: what its sources have been read to, and what they have."""

    def __init__(self, query: StreamingQuery):
        self.run, self.sources = query.runId, {}

    def onQueryStarted(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        if str(event.progress.runId) == str(self.run):
            for source in event.progress.sources:
                metrics = {name: str(value) for name, value in (source.metrics or {}).items()}
                self.sources[source.description] = {"read": source.endOffset, "available": source.latestOffset or "", **metrics}


def close(query: StreamingQuery, deadline: float = C.DEFAULT_DRAIN_TIMEOUT) -> Closed:
    """Flush what is left and stop, `deadline` seconds later at the latest. A second call does nothing.

    Unlike `force_flush` this ends while a source keeps filling; what is left is
    flushed when the stream starts again, and `unread` lists it until then.
    """
    if not query.isActive:
        return Closed(True, {})
    drained = threading.Event()
    latest = _Latest(query)
    spark = SparkSession.active()
    spark.streams.addListener(latest)

    def drain() -> None:
        with suppress(Exception):  # the query may end while this waits
            query.processAllAvailable()
            drained.set()

    threading.Thread(target=drain, daemon=True).start()
    done = drained.wait(deadline)
    query.stop()
    spark.streams.removeListener(latest)
    return Closed(done, latest.sources)


def unread(spark: SparkSession, path: str, source: str) -> list[str]:
    """Files of the folder `source` that no committed flush of the stream at `path` has read.

    Spark's file source logs which files went into which micro-batch; the
    manifest says which of these were flushed.
    """
    flushed = {n for one in manifest.entries(spark, path) for n in range(one.first, one.last + 1)}
    log = f"{path}/_progress/sources/0"
    files = manifest.filesystem(spark, source)
    place = spark._jvm.org.apache.hadoop.fs.Path
    seen: set[str] = set()
    if files.exists(place(log)):
        lines = spark.read.text(log).where(F.col("value").startswith("{"))
        named = lines.select(F.from_json("value", "path string, batchId long").alias("one")).select("one.*").collect()
        seen = {row.path for row in named if row.batchId in flushed}
    there = [status.getPath() for status in files.listStatus(place(source)) if status.isFile()]
    return sorted(str(one) for one in there if not one.getName().startswith(("_", ".")) and one.toUri().toString() not in seen)


_RECORDS = {C.OCPI: schemas.OCPI_RECORD, C.OCPP: schemas.OCPP_RECORD}


def read_flushed(spark: SparkSession, path: str, what: str = "records", protocol: str | None = None) -> DataFrame:
    """Everything that committed flushes have written so far, put together by `manifest.compact` or not.

    Rejected messages, and records of a named protocol, have a known schema, so
    there may be none of them yet.
    """
    schema = None
    keys = StructType().add("client_id", "string").add("seq", "long")
    places = StructType().add("flush", "long").add("protocol", "string")
    if what == "rejected":
        schema = StructType([*keys, StructField("drop_reason", StringType()), *places])
    elif what == "records" and protocol is not None:
        schema = StructType([*keys, *_RECORDS[protocol], *places])
    return manifest.read(spark, path, what, schema)
