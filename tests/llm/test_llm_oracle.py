"""Queries of the package that have an SQL twin."""

import pytest
from oracle import compare, connect

from seriesmill.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows and compare(df.schema, rows, connect(SF).sql(queries.ORACLES[name])) == ""
