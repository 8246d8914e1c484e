"""Stateful buffers of a stream against the table operator, and with the machine's clock."""

from __future__ import annotations

import random
import time
from datetime import UTC, datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from chargestream import constants as C
from chargestream.operators import cycles as Y
from chargestream.plans.flush import prepare_ocpp
from chargestream.streaming import buffers as B
from chargestream.streaming import flush as sf

from .test_cycles import traffic, worker

START = datetime(2026, 3, 1, tzinfo=UTC)


def table(spark, rows):
    made = [(c, s, START + timedelta(seconds=t), b"\x00%d" % s, {"k": str(s)}) for c, s, t in rows]
    return spark.createDataFrame(made, "client_id string, seq long, captured_ts timestamp, `pay load` binary, _map map<string,string>")


def append(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def arriving(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def drain(stream, path):
    writer = stream.writeStream.option("checkpointLocation", f"{path}/progress").trigger(availableNow=True)
    writer.format("parquet").start(f"{path}/out").awaitTermination()
    return stream.sparkSession.read.parquet(f"{path}/out")


def places(df, *more):
    return {(r.client_id, r.seq): (r.cycle, r.trigger, r.chunk, *(r[m] for m in more)) for r in df.collect()}


def test_play_is_the_worker():
    rnd = random.Random(1)
    for _ in range(200):
        polls, steps, cap = traffic(rnd, rnd.randrange(1, 60)), rnd.randrange(1, 9), rnd.randrange(1, 9)
        ticks, counts = np.unique(polls, return_counts=True)
        flushes, waiting, _ = B.play(ticks, counts, 0, int(ticks[0]) - 1, steps, cap, 10**9)
        want = worker(list(enumerate(polls)) and [(t, s) for s, t in enumerate(polls)], steps, cap)
        assert [p for p, _, n in flushes for _ in range(n)] == [want[s][0] for s in range(len(polls))] and waiting == 0


def test_flushes_do_not_depend_on_micro_batches(spark, tmp_path):
    rnd = random.Random(7)
    rows = [(c, 1000 * k + s, t * 2.0 + 0.3) for k, c in enumerate(("hot", "slow", "ü")) for s, t in enumerate(traffic(rnd, (150, 20, 40)[k]))]
    rows.sort(key=lambda r: r[2])
    # The last one moves the clock past everything.
    rows.append(("clock", 9999, rows[-1][2] + 1000))
    df = table(spark, rows)
    cut = sorted(rnd.sample(range(len(rows)), 3))
    for a, b in zip([0, *cut], [*cut, len(rows)], strict=True):
        part = rows[a:b]
        rnd.shuffle(part)
        append(table(spark, part), f"{tmp_path}/in")
    got = drain(B.buffered(arriving(spark, f"{tmp_path}/in", df.schema), 10.0, 2.0, 7, clock=B.CAPTURE), str(tmp_path))
    want = df.transform(Y.with_exact_cycle, 10.0, 2.0, 7).where("client_id <> 'clock'")
    assert places(got, "pay load", "_map") == places(want, "pay load", "_map")


def test_a_restarted_stream_keeps_what_waits_and_each_interval(spark, tmp_path):
    interval = F.when(F.col("client_id") == "calm", F.lit(60.0)).otherwise(F.lit(4.0))
    first = [("calm", 1, 0.5), ("quick", 2, 0.5), ("quick", 3, 3.5)]
    second = [("calm", 4, 20.5), ("quick", 5, 20.5), ("clock", 6, 300.0)]
    for part in (first, second):
        append(table(spark, part), f"{tmp_path}/in")
        stream = B.buffered(arriving(spark, f"{tmp_path}/in", table(spark, part).schema), interval, 1.0, 100, clock=B.CAPTURE)
        got = drain(stream, str(tmp_path))
    found = {r.seq: ((r.cycle - START.replace(tzinfo=None)).total_seconds(), r.trigger) for r in got.collect()}
    assert found == {1: (60.0, "interval"), 4: (60.0, "interval"), 2: (4.0, "interval"), 3: (4.0, "interval"), 5: (21.0, "interval")}


def test_the_machines_clock_flushes_on_size_at_once_and_on_interval_later(spark, tmp_path):
    df = table(spark, [("full", s, 0.0) for s in range(5)] + [("few", 10 + s, 0.0) for s in range(2)])
    append(df, f"{tmp_path}/in")
    stream = B.buffered(arriving(spark, f"{tmp_path}/in", df.schema), 20.0, 0.2, 5)
    began = time.time()
    query = stream.writeStream.option("checkpointLocation", f"{tmp_path}/progress").format("memory").queryName("clocked")
    query = query.trigger(processingTime="200 milliseconds").start()
    seen = {}
    while len(seen) < 7 and time.time() - began < 90:
        for row in spark.table("clocked").collect():
            seen.setdefault(row.seq, (row.trigger, time.time()))
        time.sleep(0.2)
    query.stop()
    assert [seen[s][0] for s in range(5)] == [Y.COUNT] * 5 and [seen[s][0] for s in (10, 11)] == [Y.INTERVAL] * 2
    assert seen[10][1] - seen[0][1] > 5 and {r.cycle for r in spark.table("clocked").where("client_id = 'few'").collect()}.__len__() == 1


def test_buffers_feed_the_flushing_job(spark, ocpp, tmp_path):
    events = ocpp(*[{"payload": b"[1]", "direction": "TO_CP", "captured_ts": START + timedelta(seconds=s)} for s in range(12)])
    clock = ocpp({"seq": 99, "client_id": "clock", "captured_ts": START + timedelta(seconds=900), "payload": b"", "direction": "TO_CP"})
    append(events, f"{tmp_path}/in")
    append(clock, f"{tmp_path}/in")
    stream = B.buffered(arriving(spark, f"{tmp_path}/in", events.schema), 5.0, 1.0, 4, clock=B.CAPTURE)
    options = {"interval": None, "keys": ("client_id", "cycle"), "envelopes": True}
    sf.start_flushing(stream, f"{tmp_path}/out", prepare_ocpp, C.OCPP, **options).awaitTermination()
    bodies = spark.read.parquet(f"{tmp_path}/out/envelopes").orderBy("first_seq").collect()
    assert [(r.first_seq, r.n_messages) for r in bodies] == [(0, 4), (4, 4), (8, 4)]
