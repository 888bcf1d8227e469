import pytest

import __spark_entry__ as entry_point
from tests.oracle import same
from verbarium.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, name):
    same(entry_point.queries()[name](spark, SF), entry_point.oracle_sql()[name], SF)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
