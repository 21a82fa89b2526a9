"""Every query against its SQL, on the smallest driver tables."""

import pytest
from compare import connect, differences

from __spark_entry__ import entry
from starfold.checks.oracles import ORACLES
from starfold.checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_names():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in ("CartesianProduct", "NestedLoop", "EvalPython") if node in plan]
    assert differences(df, con, ORACLES[name]) is None


def test_entry(spark):
    assert entry(spark).count() == 10
