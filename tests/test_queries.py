import pytest

from sparkrekey.plans.oracles import ORACLES
from sparkrekey.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, same, name):
    same(QUERIES[name](spark, SF), ORACLES[name], SF)


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
