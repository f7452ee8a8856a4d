"""Every query against its SQL oracle, on the smallest tables."""

import pytest
from oracle import compare, database

import __spark_entry__ as driver
import workload

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(SF)


@pytest.mark.parametrize("name", list(workload.queries()))
def test_query_gives_what_its_oracle_gives(spark, connection, name):
    df = driver.queries()[name](spark, SF)
    assert compare(df, connection, driver.oracle_sql()[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("EvalPython", "InPandas", "Cartesian", "NestedLoop", "ExistingRDD"))


def test_every_query_has_an_oracle():
    assert set(workload.queries()) == set(workload.oracles())


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0
