"""Every gridded query gives the rows of its SQL."""

import pytest

from pluvio import catalog

SQL = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(name, same_rows):
    same_rows(catalog.queries()[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQL)))
def test_queries_without_sql_have_rows(name, spark, sf_dir):
    assert catalog.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 25
    assert set(catalog.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
