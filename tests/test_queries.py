"""Every registered query against its SQL twin, on the whole small tables."""

import __spark_entry__ as registry
import oracle
import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.duck(SF_DIR)


def test_every_query_has_a_twin():
    assert registry._QUERIES.keys() <= registry.oracle_sql().keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", list(registry._QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = registry.queries()[name](spark, SF_DIR)
    assert oracle.difference(frame, duck, registry.oracle_sql()[name]) is None


def test_entry(spark):
    frame = registry.entry(spark)
    assert "momentum_rank" in frame.columns
    assert frame.count() > 0
