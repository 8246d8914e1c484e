"""Outcomes of batches."""

from __future__ import annotations

import pytest

from chargestream import constants as C
from chargestream import schemas
from chargestream.operators import admission as A
from chargestream.operators import delivery as D

from .conftest import rows_of


def attempts(spark, batches):
    rows = [
        {"batch_id": batch, "protocol": "ocpi", "n_messages": 10, "attempt": at, "status": status}
        for batch, statuses in batches.items()
        for at, status in enumerate(statuses)
    ]
    return rows_of(spark, schemas.DELIVERY_ATTEMPT, rows).repartition(3)


CASES = {
    1: ([200], "accepted", 1, None),
    2: ([503, None, 200], "accepted", 3, None),
    3: ([400], "permanent", 1, "permanent rejection: HTTP 400"),
    4: ([401], "permanent", 1, "permanent rejection: HTTP 401"),
    5: ([500, 413, 200], "permanent", 2, "permanent rejection: HTTP 413"),
    6: ([500] * 5, "exhausted", 5, "retries exhausted (last HTTP 500)"),
    7: ([500, 500, 500, 500, None], "exhausted", 5, "retries exhausted (network error / timeout)"),
    8: ([None, None, None, None, 204], "exhausted", 5, "retries exhausted (last HTTP 204)"),
    9: ([500, None], "in_flight", 2, None),
    10: ([500] * 5 + [200], "exhausted", 5, "retries exhausted (last HTTP 500)"),
    11: ([404, 429, 301, 0, 502], "exhausted", 5, "retries exhausted (last HTTP 502)"),
    12: ([500, 500, 500, 500, 200], "accepted", 5, None),
}


@pytest.fixture
def outcomes(spark):
    return D.delivery_outcomes(attempts(spark, {batch: case[0] for batch, case in CASES.items()}))


def test_outcomes(outcomes):
    got = {row.batch_id: (row.outcome, row.attempts, row.reason) for row in outcomes.collect()}
    assert got == {batch: case[1:] for batch, case in CASES.items()}


def test_drop_accounting_of_batches(outcomes):
    rows = {row.reason: (row.n_batches, row.n_messages) for row in D.dropped_batches(outcomes).collect()}
    assert rows["retries exhausted (last HTTP 500)"] == (2, 20)
    assert sum(n for n, _ in rows.values()) == sum(case[3] is not None for case in CASES.values())


def test_drop_accounting_of_messages(ocpi):
    df = ocpi({}, {"platform_id": ""}, {"platform_id": " "}, {"request_body": b"x" * 9})
    lost = A.rejected(df.transform(A.admit_ocpi, 8), C.OCPI)
    assert {row.drop_reason: row.n_messages for row in D.dropped_messages(lost).collect()} == {
        C.INVALID_IDENTITY: 2,
        C.REQUEST_BODY_OVERSIZE: 1,
    }
