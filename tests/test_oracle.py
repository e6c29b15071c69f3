"""Every query with an SQL twin gives the same rows, to the last bit, at sf0.01."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = df.collect()
    assert rows
    assert compare(df.schema, rows, con.sql(ORACLES[name])) == ""


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(ORACLES)))
def test_query_without_twin_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 1 and rows[0].verdict
