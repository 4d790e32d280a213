"""Queries of the training-data operators that have SQL give the SQL's rows."""

import pytest

from kinoframe.llm import queries

from ..compare import check


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, name):
    check(spark, queries.QUERIES[name], queries.ORACLE_SQL[name])
