import pytest

import __spark_entry__
from tagreef import checks
from compare import connect, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"
QUERIES = checks.QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_entry(spark):
    found = __spark_entry__.entry(spark)
    assert found.columns == ["path", "binary"]
    assert found.count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    names, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_names, expected = duck_rows(con, __spark_entry__.oracle_sql()[name])
    assert names == expected_names
    assert rows == expected
