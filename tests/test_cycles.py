"""Exact flush cycles against a worker that really looks at its buffer poll by poll."""

from __future__ import annotations

import random
from datetime import UTC, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from chargestream.operators import cycles as Y
from chargestream.session import stage

START = datetime(2026, 3, 1, tzinfo=UTC)
POLL = 2.0


def worker(messages, steps, cap):
    """(poll, why) by message of one client; messages are (poll, seq), sorted."""
    out, buffer = {}, []
    waiting = sorted(messages)
    if not waiting:
        return out
    now = waiting[0][0]
    last = now - 1
    while waiting or buffer:
        while waiting and waiting[0][0] <= now:
            buffer.append(waiting.pop(0))
        if buffer and (len(buffer) >= cap or now - last >= steps):
            why = "count" if len(buffer) >= cap else "interval"
            out |= {seq: (now, why, at // cap) for at, (_, seq) in enumerate(buffer)}
            buffer, last = [], now
        now += 1
    return out


def events(spark, rows):
    made = [(client, seq, None if tick is None else START + timedelta(seconds=tick * POLL + jitter)) for client, seq, tick, jitter in rows]
    return spark.createDataFrame(made, "client_id string, seq long, captured_ts timestamp")


def traffic(rnd, n):
    """Polls of n messages: bursts, steady times and pauses."""
    at, out = rnd.randrange(50), []
    for _ in range(n):
        at += rnd.choice([0, 0, 0, 0, 1, 1, 2, 3, 7, 40]) if rnd.random() < 0.9 else 0
        out.append(at)
    return out


def got(df):
    base = int(START.timestamp() / POLL)
    rows = df.withColumn("p", F.expr(f"cast(unix_micros(cycle) / {POLL * 1e6} as long) - 1 - {base}")).collect()
    return {(r.client_id, r.seq): (r.p, r.trigger, r.chunk) for r in rows}


@pytest.mark.parametrize(("bucket", "steps", "cap"), [(4096, 5, 7), (16, 5, 7), (16, 16, 30), (8, 1, 3), (8, 8, 10**6), (32, 6, 1)])
def test_cycles_against_a_worker(spark, monkeypatch, bucket, steps, cap):
    monkeypatch.setattr(Y, "_BUCKET", bucket)
    rnd = random.Random(bucket + steps)
    rows, want, seq = [], {}, 0
    for client, n in (("hot", 700), ("slow", 60), ("once", 1), ("ü", 90)):
        polls = traffic(rnd, n)
        own = [(tick, seq + at) for at, tick in enumerate(polls)]
        seq += n
        want |= {(client, s): v for s, v in worker(own, steps, cap).items()}
        rows += [(client, s, tick, rnd.random() * POLL * 0.99) for tick, s in own]
    rnd.shuffle(rows)
    df = events(spark, rows).repartition(5)
    assert got(df.transform(Y.with_exact_cycle, steps * POLL, POLL, cap)) == want


def test_every_way_into_a_bucket():
    rnd = random.Random(2)
    for _ in range(60):
        steps, cap = rnd.randrange(1, 9), rnd.randrange(1, 9)
        tick = np.cumsum([rnd.randrange(1, 5) for _ in range(30)])
        n = np.array([rnd.randrange(1, 4) for _ in range(30)])
        first, end = 10, 24
        bucket = Y._Bucket.__new__(Y._Bucket)
        bucket.tick, bucket.upto, bucket.first, bucket.end, bucket.steps = tick, np.concatenate([[0], np.cumsum(n)]), first, end, steps
        exits = bucket.exits(cap)
        for age in range(1, steps + 1):
            last = int(tick[first]) - age
            flushed = {f for _, f, *_ in bucket.flushes(last, cap)}
            before = max([f for f in flushed if f <= tick[end - 1]], default=last)
            assert exits[age - 1] == int(tick[end - 1]) - before


def test_rows_without_client_or_time_belong_to_no_flush(spark):
    df = events(spark, [("a", 1, 3, 0.1), (None, 2, 3, 0.1), ("a", 3, None, 0.0)])
    rows = {r.seq: (r.trigger, r.chunk) for r in df.transform(Y.with_exact_cycle, 10.0, POLL, 5).collect()}
    assert rows == {1: ("interval", 0), 2: (None, None), 3: (None, None)}
    assert df.limit(0).transform(Y.with_exact_cycle).count() == 0


def test_each_client_has_its_own_interval(spark):
    df = events(spark, [(c, 10 * k + n, tick, 0.5) for k, c in enumerate(("quick", "calm")) for n, tick in enumerate((0, 1, 4, 5, 30))])
    interval = F.when(F.col("client_id") == "quick", F.lit(POLL)).otherwise(F.lit(10 * POLL))
    found = {}
    for (client, _), value in sorted(got(df.transform(Y.with_exact_cycle, interval, POLL, 100)).items()):
        found.setdefault(client, []).append(value[0])
    assert found == {"quick": [0, 1, 4, 5, 30], "calm": [9, 9, 9, 9, 30]}


def test_a_very_long_interval_is_looked_at_less_often(spark):
    df = events(spark, [("a", n, n * 1000, 0.5) for n in range(40)])
    rows = df.transform(Y.with_exact_cycle, 86_400.0, 0.2, 10).groupBy("cycle", "trigger").count().collect()
    assert sorted((r.trigger, r["count"]) for r in rows) == [("count", 10)] * 4


@pytest.fixture
def sorting(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for name, value in conf.items():
        spark.conf.set(name, value)
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_hot_client_is_many_tasks_and_its_rows_move_once(sorting):
    df = stage(events(sorting, [("hot", n, n // 3, 0.5) for n in range(60)]).withColumn("payload", F.repeat(F.lit("x"), 50)), "wide")
    plan = df.transform(Y.with_exact_cycle, 5.0, POLL, 5)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    wide = [line for at, line in enumerate(lines) if "Exchange hashpartitioning" in line and "payload" in " ".join(lines[at + 1 : at + 4])]
    assert len(wide) == 1 and "client_id" in wide[0] and "__tick" in wide[0]
    windows = [line for line in lines if "Window [" in line]
    assert windows and all("__tick" in line for line in windows)
