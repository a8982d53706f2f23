import pytest

from symgraph.plans import registry
from twins import BARRED, assert_equal, connection

PAIRED_ROWS = {"call_stats"}  # joins two tables of one row each


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, data, name):
    assert_equal(spark, connection(data), data, registry.queries()[name], registry.oracle_sql()[name], "BatchEvalPython" if name in PAIRED_ROWS else BARRED)


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) == set(registry.queries())
