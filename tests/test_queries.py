"""Every registered query against its SQL twin at the smallest scale."""

import pytest

import __spark_entry__ as contract
import compare
from conftest import SMALL
from tidegate.plans import oracle
from tidegate.plans.queries import QUERIES

SQL = oracle.oracle_sql()
# Jobs that write tables and end in a read of them: their last plan is that read.
JOBS = {"incident_job", "replay_due", "replay_published_once", "compacted_clean", "ledger_purged"}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


def test_every_query_has_its_twin():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf_dir, duck, name):
    assert compare.rows_of(QUERIES[name](spark, sf_dir)) == compare.sql_rows(duck, SQL[name])


def test_flagship(spark):
    assert contract.entry(spark).count() == 442


def test_plans_hold_no_python_and_no_cartesian_product(spark, sf_dir):
    for name, build in QUERIES.items():
        if name.startswith("stream_") or name in JOBS:
            continue
        plan = build(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        for word in ("EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"):
            assert word not in plan, (name, word)
