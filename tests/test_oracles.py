"""Every registered query against its SQL in DuckDB."""

import pytest
from compare import connect, difference

import __spark_entry__ as driver
from cityweave.plans.oracles import ORACLES
from cityweave.plans.queries import REGISTRY


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, small, duck, name):
    assert difference(REGISTRY[name](spark, small), duck, ORACLES[name]) is None


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert {r.distance_group for r in rows} == {"0-10km", "10-20km", ">20km"}
    assert sum(r.n_nearby for r in rows) > 0
