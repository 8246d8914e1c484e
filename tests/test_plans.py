"""What the physical plans promise: few wide shuffles, pruned scans, no cross joins."""

from __future__ import annotations

import re

import pytest

from chargestream import constants as C
from chargestream.operators import admission as A
from chargestream.operators import batching as B
from chargestream.operators import records as R
from chargestream.operators import sessions as S
from chargestream.plans.flush import batches, flush, prepare_ocpi
from chargestream.session import stage


@pytest.fixture
def static_plan(spark):
    """The physical plan as planned, without AQE's changes at run time."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def wide_shuffles(plan: str, column: str) -> int:
    """Shuffles whose input carries the given column (as data, not as null)."""
    lines = plan.splitlines()
    below = [lines[at + 1 :] for at, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    return sum(bool(re.search(rf"\b{column}#\d+", " ".join(rest[:3]))) for rest in below)


def test_numbering_shuffles_wide_rows_once(ocpi, static_plan):
    records = stage(ocpi({}).transform(R.ocpi_records), "plan")
    plan = static_plan(records.transform(B.with_chunk))
    assert wide_shuffles(plan, "request_body") == 1
    assert "ReadSchema: struct<client_id:string,seq:bigint>" in plan


def test_batches_shuffle_wide_rows_once(ocpi, static_plan):
    records = stage(ocpi({}).transform(R.ocpi_records), "plan")
    plan = static_plan(batches(records, C.OCPI))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("request_body") and "Sort" not in plan
    assert "BroadcastHashJoin" in plan


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_counting_connects_neither_sorts_nor_windows_payloads(ocpp, static_plan, limit, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    plan = static_plan(stage(ocpp({}).drop("connection_id"), "plan").transform(S.assign_connections))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = re.findall(r"FileScan parquet \[(.*?)\]", plan)
    assert sum("payload" in scan for scan in scans) == 1 and len(scans) == 2
    assert "Window" not in plan and "Sort" not in plan
    assert wide_shuffles(plan, "payload") == (0 if limit == "10m" else 1)
    assert ("ShuffledHashJoin" in plan) == (limit == "-1")


def test_admission_and_records_need_no_shuffle(ocpi, static_plan):
    captures = stage(ocpi({}), "plan")
    plan = static_plan(flush(prepare_ocpi(captures), C.OCPI).records)
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1


def test_drop_counts_are_partial(ocpi, static_plan):
    from chargestream.operators.delivery import dropped_messages

    lost = A.rejected(stage(ocpi({}), "plan").transform(A.admit_ocpi), C.OCPI)
    plan = static_plan(dropped_messages(lost))
    assert "partial_count" in plan and plan.count("Exchange") == 1
    assert "request_headers" not in plan and "url" not in plan
