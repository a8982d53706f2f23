import pytest

from symgraph.llm import queries
from twins import assert_equal, connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, data, name):
    assert_equal(spark, connection(data), data, queries.QUERIES[name], queries.ORACLE[name], "BatchEvalPython|CartesianProduct")
