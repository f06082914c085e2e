import pytest
from oracle import compare, connected

from reportloom.plans import catalog

SF = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connected(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, con, name):
    compare(catalog.queries()[name](spark, SF), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQL)))
def test_query_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns[:3] == ["agency", "agency_doc", "reporting_year"]
    assert set(catalog.queries()) <= set(__spark_entry__.queries())
