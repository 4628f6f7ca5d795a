"""Every registered query that has SQL, against DuckDB on the smallest tables."""

import pytest
from compare import DATA, connect, difference

import __spark_entry__ as entry
from oracles import registered

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_matches_sql(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert difference(got, con.execute(registered()[name]).df()) is None


def test_sql_only_for_registered_queries():
    assert set(registered()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
