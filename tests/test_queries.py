"""Core queries against SQL, on whole tables."""

import pytest
from compare import assert_same, connect

from memoloom.plans import oracles
from memoloom.plans import queries as core

NO_SQL = sorted(set(core.QUERIES) - set(oracles.SQL))


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_equals_sql(spark, data, name):
    assert_same(core.queries()[name](spark, data), connect(data), oracles.SQL[name])


@pytest.mark.parametrize("name", NO_SQL)
def test_runs(spark, data, name):
    core.queries()[name](spark, data).collect()


def test_entry(spark, data):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
