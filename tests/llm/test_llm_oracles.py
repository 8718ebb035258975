import pytest

from oracle_harness import compare, duck
from starloom.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    ok, message = compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLE[name])
    assert ok, message
