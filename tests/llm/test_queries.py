import pytest

from kgspark.llm import queries, sql

from ..oracle import SF, same, views

Q, S = queries.queries(), sql.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return views()


@pytest.mark.parametrize("name", sorted(S))
def test_against_sql(spark, con, name):
    same(spark, Q[name], S[name], con)


@pytest.mark.parametrize("name", sorted(set(Q) - set(S)))
def test_runs(spark, name):
    assert Q[name](spark, SF).count() > 0


def test_columns(spark):
    want = {"p1_found": ["entity_type", "record_id", "group_id"], "p2_found": ["field_name", "record_id", "entry"], "p3_found": ["id", "property_name", "row_id"], "p5_found": ["document_id", "item_kind", "item_pos", "cut_kind"], "p8_found": ["doc_id_a", "doc_id_b"]}
    for name, cols in want.items():
        assert Q[name](spark, SF).columns == cols
