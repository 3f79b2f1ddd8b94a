"""Every registered query against its SQL, on the smallest driver tables, and its plans."""

import pytest

import __spark_entry__ as entry_point
import checks.queries as queries
import orderflow.operators.reports as reports
import orderflow.operators.rules as rules
import orderflow.plans.outcall as outcall
import orderflow.plans.receive as receive
import orderflow.plans.reports as rebuild
from checks.compare import differences, duck
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.plans import plan

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


@pytest.fixture
def staged_plans(monkeypatch):
    """Plans of everything a query writes or checkpoints on its way."""
    seen: list[str] = []

    def spy(write):
        def wrapped(df, *args):
            seen.append(plan(df))
            return write(df, *args)
        return wrapped

    for module in (queries, rules, outcall, receive, rebuild):
        monkeypatch.setattr(module, "stage", spy(module.stage))
    monkeypatch.setattr(reports, "checkpointed", spy(reports.checkpointed))
    return seen


def test_contract():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, staged_plans, name):
    df = QUERIES[name](spark, SMALL)
    for text in [*staged_plans, plan(df)]:
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas",
                     "PythonUDF"):
            assert node not in text
        # the counts of finished tables are the only single-partition step
        assert "SinglePartition" not in text or name == "dimension_refresh"
    assert differences(df, connection, ORACLES[name]) == []
