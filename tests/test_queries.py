import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest

from compare import connect, same
from fluvion.plans import aggregates, analyses, cleaning, core_queries, extras, joins, registry, release, structure, temporal  # noqa: F401

ALL = registry.QUERIES | core_queries.QUERIES
SQL = registry.ORACLE | core_queries.ORACLE


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_gives_the_rows_of_its_sql(spark, data, con, name):
    same(ALL[name](spark, data), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(ALL) - set(SQL)))
def test_query_without_sql_runs(spark, data, name):
    df = ALL[name](spark, data)
    assert df.count() >= 0 and len(set(df.columns)) == len(df.columns)


def test_entry_contract(spark, data):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
