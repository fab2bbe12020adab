import pytest

import __spark_entry__ as contract
from tools.check import difference, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle(SF)


# The queries of the llm subpackage, if it is there, have their tests beside its others.
NAMES = [name for name in contract.queries() if name not in contract._llm_queries()]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, connection, name):
    df = contract.queries()[name](spark, SF)
    rows = [tuple(row) for row in df.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert name == "sample_exact" and rows
    else:
        assert difference(rows, df.columns, sql, connection) is None


def test_entry(spark):
    row = contract.entry(spark).first()
    assert row.records_scanned == 6_000 and row.match_count > 2_000


def test_sql_belongs_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
