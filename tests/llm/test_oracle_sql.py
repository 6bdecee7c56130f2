import pytest
from brute import SF_DIR
from compare import connect, duck_rows, spark_rows

from tagreef.llm.registry import ORACLE, QUERIES


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    names, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    assert (names, rows) == duck_rows(connect(SF_DIR), ORACLE[name])
