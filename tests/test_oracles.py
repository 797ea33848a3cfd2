"""Each query with SQL gives the SQL's rows."""

import pytest

import __spark_entry__ as entry
from cutweave.plans import catalog
from oracle import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_rows_are_those_of_the_sql(spark, name):
    assert compare(spark, name, SF) is None


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_queries_without_sql_run(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_flagship_query(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
