"""Tokens, sentences, chunks."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kgspark.operators import text as T


def toks(t):
    return [t[b:e] for _, b, e, _ in T.regex_tokens(t)]


def test_tokens():
    assert T.regex_tokens("Hello world.")[0][0] == T.WORD and len(toks("Hello world.")) == 3
    assert T.regex_tokens("123 pigs")[0][0] == T.NUMBER
    assert T.regex_tokens("Line one.\nLine two.")[3][3]
    assert toks("") == [] and T.regex_tokens("ab cd ef")[0][1:3] == (0, 2)
    assert toks("héllo __ ...a1") == ["héllo", "__", "...", "a", "1"]
    assert [t[1:3] for t in T.grapheme_tokens("é x")] == [(0, 2), (3, 4)]


def test_sentences():
    t = "Roses are red. Violets are blue."
    assert len(list(T.sentences(t, T.regex_tokens(t)))) == 2
    t = "Dr. Smith conducted the study."
    assert list(T.sentences(t, T.regex_tokens(t))) == [(0, 7)]
    t = "Wait... what about this part?"
    assert len(list(T.sentences(t, T.regex_tokens(t)))) == 1
    assert T.sentence_end("a b", T.regex_tokens("a b"), 999) == 2


@pytest.mark.parametrize("text,limit,least", [("A. " * 500, 100, 2), ("A. B. C. D. E. F. G. H. ", 10, 2), ("", 10, 0)])
def test_chunks(text, limit, least):
    tok = T.regex_tokens(text)
    out = list(T.chunks(text, tok, limit))
    assert len(out) >= least
    assert all(tok[b - 1][2] - tok[a][1] <= limit for a, b in out)


def test_long_sentence_and_token():
    t = "x" * 50 + " tail. Next one."
    out = [t[T.regex_tokens(t)[a][1] : T.regex_tokens(t)[b - 1][2]] for a, b in T.chunks(t, T.regex_tokens(t), 20)]
    assert out == ["x" * 50, "tail. Next one."]
    t = "one two three\nfour five six\nseven eight nine"
    tok = T.regex_tokens(t)
    assert [t[tok[a][1] : tok[b - 1][2]] for a, b in T.chunks(t, tok, 15)] == t.split("\n")


@settings(max_examples=200, deadline=None)
@given(st.text("ab. \nX1!", max_size=80), st.integers(1, 30))
def test_chunks_keep_every_token(t, limit):
    tok = T.regex_tokens(t)
    out = list(T.chunks(t, tok, limit))
    assert [i for a, b in out for i in range(a, b)] == list(range(len(tok)))


def test_frames(spark):
    df = spark.createDataFrame([(1, "One two. Three four."), (2, None), (3, "")], "id long, t string")
    assert T.tokenize(df, ["id"], "t").count() == 6
    assert [r["sentence"] for r in T.split_sentences(df, ["id"], "t").orderBy("sentence_idx").collect()] == ["One two.", "Three four."]
    assert T.chunk(df, ["id"], "t", 10).count() == 2
    c = T.previous_context(T.chunk(df, ["id"], "t", 10), "id", "chunk_idx", "chunk_text", 4).orderBy("chunk_idx").collect()
    assert [r["prompt_context"] for r in c] == ["", "[Previous text]: ...two."]
    b = T.batches(spark.range(5).selectExpr("id", "0 AS g"), ["g"], ["id"], 2)
    assert [r["n"] for r in b.groupBy("batch_idx").count().withColumnRenamed("count", "n").orderBy("batch_idx").collect()] == [2, 2, 1]
