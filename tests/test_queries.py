import pytest

import __spark_entry__ as entry
from kgspark import queries, sql

from .oracle import SF, same, views

Q, S = queries.queries(), sql.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return views()


def test_every_sql_has_a_query():
    assert set(S) <= set(Q)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(S))
def test_against_sql(spark, con, name):
    same(spark, Q[name], S[name], con)


@pytest.mark.parametrize("name", sorted(set(Q) - set(S)))
def test_runs(spark, name):
    df = Q[name](spark, SF)
    assert df.columns and df.count() >= 0
