"""Every query of the subpackage on the smallest tables, against its SQL where it has some."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import queries
from chargestream.llm import mixing
from chargestream.llm.queries import ORACLES, QUERIES

from ..compare import duck, oracle_rows, spark_rows

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(queries())


@pytest.mark.parametrize("name", sorted(set(ORACLES)))
def test_query_equals_its_sql(llm, name):
    assert spark_rows(QUERIES[name](llm, SF)) == oracle_rows(duck(SF), ORACLES[name])


@pytest.mark.parametrize(("name", "of"), [("op3", "pages"), ("op4", "documents"), ("op5", "documents")])
def test_a_row_per_row(llm, name, of):
    run = next(q for k, q in QUERIES.items() if k.startswith(name + "_"))
    assert run(llm, SF).count() == llm.read.parquet(f"{SF}/{of}.parquet").count()


def test_mixing_runs_no_python(llm):
    plan = QUERIES["op9_hierarchical_mixing"](llm, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    leaves = llm.createDataFrame([("web", "en", "a", 9)], "__domain string, __lang string, __source string, tokens long")
    plan = mixing.budgets(leaves, mixing.DEFAULT)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Cartesian|NestedLoop", plan)
