"""Every query against its SQL on the smallest tables; those without SQL run."""

import pytest

from gridfold.plans.catalog import ORACLES, QUERIES

SLOW = {"svm_classes"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(name, same):
    same(QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_runs(name, spark, sf):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
