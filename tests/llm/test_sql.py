import pytest
from oracle import compare, connected

from reportloom.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    compare(queries.queries()[name](spark, SF), connected(SF), queries.oracle_sql()[name])
