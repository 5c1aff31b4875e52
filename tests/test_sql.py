"""The functions under SQL."""

import pytest

from kgspark.functions.sql import register
from kgspark.operators import text as T


def test_sql(spark):
    assert "kg_chunks" in register(spark)
    spark.createDataFrame([(1, "One two. Three four."), (2, None)], "id long, t string").createOrReplaceTempView("docs")
    got = spark.sql("SELECT id, c.chunk_text FROM docs, LATERAL kg_chunks(t, 10) c ORDER BY c.chunk_idx").collect()
    assert [tuple(r) for r in got] == [(1, "One two."), (1, "Three four.")]
    assert spark.sql("SELECT count(*) AS n FROM docs, LATERAL kg_tokens(t) x").first()["n"] == 6
    assert spark.sql("SELECT s.sentence FROM docs, LATERAL kg_sentences(t) s ORDER BY s.start_pos DESC").first()["sentence"] == "Three four."
    assert spark.sql("SELECT kg_nfc('é') AS x").first()["x"] == "é"


def test_ranges():
    tok = T.regex_tokens("Hello world today")
    assert T.slice_text("Hello world today", tok, 0, 2) == "Hello world" and T.slice_text("Hello world today", tok, 1, 1) == ""
    assert T.char_range(tok, 1, 3) == (6, 17)
    for bad in ((0, 9), (-1, 2), (2, 1)):
        with pytest.raises(ValueError):
            T.slice_text("Hello world today", tok, *bad)
    with pytest.raises(ValueError):
        T.char_range(tok, 1, 1)
