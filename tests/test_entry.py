import pytest

import __spark_entry__ as entry
from given_tables.compare import compare, duck

SF = "/root/testdata/sf0.001"
CHECKED = [n for n in entry.queries() if n not in entry.TEXT_QUERIES]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    """But the text operators' queries, some of which SQL can't express."""
    assert set(entry.queries()) - set(entry.TEXT_QUERIES) == set(entry.oracle_sql()) - set(entry.TEXT_ORACLES)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF) is None
