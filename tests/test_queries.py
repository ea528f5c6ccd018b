"""Every registered query beside its SQL on the smallest tables."""

import pytest

from chronopix import registry
from tests.compare import database, rows

registry.load()
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows_as_sql(spark, con, name):
    got, want = registry.QUERIES[name](spark, FOLDER).toPandas(), con.sql(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_runs_without_sql(spark, name):
    assert registry.QUERIES[name](spark, FOLDER).collect()


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    flagship = entry.entry(spark)
    assert rows(flagship.toPandas()) == rows(database(FOLDER).sql(registry.ORACLE_SQL[registry.FLAGSHIP]).df())
