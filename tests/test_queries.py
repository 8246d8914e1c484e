"""Every registered query against its SQL, on the smallest test tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from chargestream.plans.oracles import ORACLES
from chargestream.plans.queries import QUERIES

from .compare import duck, oracle_rows, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return duck(SF)


def test_every_query_has_sql():
    assert list(QUERIES) and set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, tables, name):
    df = QUERIES[name](spark, SF)
    assert spark_rows(df) == oracle_rows(tables, ORACLES[name])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
