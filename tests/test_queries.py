"""Every query of the library that has SQL gives the SQL's rows; the others run to their end."""

import pytest

from kinoframe import plans

from .compare import SF_DIR, check


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_against_sql(spark, name):
    check(spark, plans.QUERIES[name], plans.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE_SQL)))
def test_runs(spark, name):
    assert plans.QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
