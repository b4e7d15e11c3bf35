import pytest

import __spark_entry__ as entry_points
from verification.compare import compare, open_tables
from verification.oracles import ORACLES
from verification.registry import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql(spark, tables, name):
    assert compare(spark, tables, SF_DIR, name) == []


def test_every_query_has_sql():
    assert set(ORACLES) == set(REGISTRY)
    assert set(REGISTRY) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["topic", "value"] and result.count() > 0
