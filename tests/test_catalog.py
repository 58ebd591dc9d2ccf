"""Every named query against its SQL on DuckDB."""

import pytest

import __spark_entry__ as entry
from tickloom import catalog
from tools.compare import connect, differences

QUERIES, SQL = catalog.QUERIES, catalog.SQL


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, folder, duck, name):
    got = QUERIES[name](spark, folder).toPandas()
    assert differences(got, duck.execute(SQL[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["date_id", "n_rows", "score", "mean_roll5"] and out.count() == 30
