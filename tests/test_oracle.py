"""Every query against its SQL on the smallest data set."""

import __spark_entry__ as catalogue
import pytest
from compare import oracle, oracle_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", list(catalogue.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    statement = catalogue.oracle_sql()[name].replace(catalogue.ORACLE_DIR, FOLDER)
    got = spark_rows(catalogue.queries()[name](spark, FOLDER))
    assert got == oracle_rows(connection, statement)


def test_entry_gives_rows(spark):
    assert catalogue.entry(spark).count() == 200
