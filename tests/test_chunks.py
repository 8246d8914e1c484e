"""Batches bound by number and bytes, against a plain loop; how whole rows find theirs."""

from __future__ import annotations

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from chargestream import constants as C
from chargestream.operators import batching as B
from chargestream.operators import chunks as K
from chargestream.operators import records as R
from chargestream.plans.flush import batches
from chargestream.session import stage


def greedy(sizes, most, max_bytes):
    out, n, used, chunk = [], 0, 0, -1
    for size in sizes:
        if not out or n == most or used + size > max_bytes:
            chunk, n, used = chunk + 1, 0, 0
        n, used = n + 1, used + size
        out.append(chunk)
    return out


def rows(spark, given):
    return spark.createDataFrame(given, "client_id string, seq long, __bytes long")


@pytest.mark.parametrize(("bucket", "most", "limit"), [(1 << 14, 1000, 500), (16, 16, 60), (16, 5, 1000), (8, 3, 1), (32, 20, 150)])
def test_cuts_against_a_loop(spark, monkeypatch, bucket, most, limit):
    monkeypatch.setattr(K, "_ROWS", bucket)
    rnd = random.Random(bucket + most)
    given, want = [], {}
    for client, n in (("hot", 600), ("small", 7), (None, 33), ("one", 1)):
        seqs = sorted(rnd.sample(range(10**6), n))
        sizes = [rnd.choice([1, 2, 10, 30, 2 * limit]) for _ in seqs]
        given += [(client, seq, size) for seq, size in zip(seqs, sizes, strict=True)]
        want |= {(client, seq): chunk for seq, chunk in zip(seqs, greedy(sizes, most, limit), strict=True)}
    rnd.shuffle(given)
    got = {(r.client_id, r.seq): r.chunk for r in K.bytes_chunks(rows(spark, given).repartition(4), ["client_id"], most, limit).collect()}
    assert got == want


def test_a_batch_has_a_size(spark):
    with pytest.raises(ValueError):
        K.bytes_chunks(rows(spark, []), ["client_id"], 0, 10)


@pytest.fixture(params=["10m", "-1"])
def side(request, spark):
    """Side tables that are broadcast, and ones that are not."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def sample(ocpi, n):
    rnd = random.Random(n)
    given = [{"client_id": rnd.choice(["hot", "hot", "hot", "é"]), "seq": at * 97, "url": f"/{'x' * rnd.randrange(200)}"} for at in range(n)]
    return stage(ocpi(*given).transform(R.ocpi_records), "records")


@pytest.mark.parametrize("limit", [None, 4000])
def test_bodies_keep_both_bounds_and_lose_nothing(ocpi, side, limit):
    records = sample(ocpi, 700)
    bodies = batches(records, C.OCPI, size=40, max_bytes=limit).orderBy("client_id", "chunk").collect()
    urls = {}
    for body in bodies:
        sent = json.loads(body.body)["messages"]
        assert len(sent) == body.n_messages <= 40 and body.body_bytes == len(body.body)
        assert limit is None or body.body_bytes <= limit
        urls.setdefault(body.client_id, []).extend(m["url"] for m in sent)
    want = {}
    for row in records.orderBy("seq").collect():
        want.setdefault(row.client_id, []).append(row.url)
    assert urls == want
    assert [b.chunk for b in bodies if b.client_id == "hot"] == list(range(sum(b.client_id == "hot" for b in bodies)))
    if limit is not None:  # no batch could have taken the first record of the next
        sizes = {r.url: r.n for r in records.select("url", F.octet_length(B._record(R.OCPI_FIELDS)).alias("n")).collect()}
        for one, other in zip(bodies, bodies[1:], strict=False):
            if one.client_id == other.client_id and one.n_messages < 40:
                assert one.body_bytes + 1 + sizes[json.loads(other.body)["messages"][0]["url"]] > limit


def test_a_batch_over_many_ranges_is_put_together(ocpi, side):
    records = stage(ocpi(*[{"seq": at << 15, "url": f"/{at}"} for at in range(50)]).transform(R.ocpi_records), "records")
    (first, second) = batches(records, C.OCPI, size=30).orderBy("chunk").collect()
    assert [m["url"] for m in json.loads(first.body)["messages"]] == [f"/{at}" for at in range(30)]
    assert (second.n_messages, second.first_seq, second.last_seq) == (20, 30 << 15, 49 << 15)


def test_whole_records_move_once(ocpi, side, spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plan = batches(sample(ocpi, 20), C.OCPI)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    assert "Window" not in plan and "SortMergeJoin" not in plan
    if side == "10m":
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("BroadcastHashJoin") == 1
    else:
        # Both kinds of batches read one exchange of records; only border batches have another.
        wide = [at for at, line in enumerate(lines) if "Exchange hashpartitioning" in line and "__range" in line and "__record" in "".join(lines[at + 1 : at + 4])]
        assert len(wide) + plan.count("ReusedExchange") >= 2 and plan.count("ShuffledHashJoin") == 2
        assert re.search(r"Exchange hashpartitioning\(protocol", plan)
