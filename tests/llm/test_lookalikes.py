"""Consistent forms: what looks the same is equal, what looks different stays different."""

import itertools
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kgspark.llm.lookalikes import CYRILLIC, GREEK, bigram_scores, consistent, consistent_forms, look_alike_classes, look_alike_pairs, skeleton, viterbi

SAME = [
    ("Dietary thymol", "Dіеtаrу thуmоl"), ("naïve é", unicodedata.normalize("NFD", "naïve é")), ("the (P < 0.01).", "ｔｈｅ （Ｐ < ０．０１）．"), ("a b", "a b"), ("a b", "a b"), ("feed-to-gain", "feed‐to‑gain"),
    ("thymol", "thy​mo­l﻿"), ("efficient flow", "eﬃcient ﬂow"), ("5 °C", "5 ℃"), ("10 µg", "10 μg"), ("10 K", "10 K"), ("Рост", "Pоcт"), ("BETA", "ΒΕΤΑ"), ("ё", "ё"), ("５％", "5%"), ("ADG", "ＡＤＧ"), ("йод", unicodedata.normalize("NFD", "йод")),
]
DIFFERENT = [("10⁹", "109"), ("é", "e"), ("и", "й"), ("α-tocol", "a-tocol"), ("β", "ß"), ("ab", "a b"), ("A", "a"), ("a  b", "a b"), ("naïve", "naive"), ("x²", "x2"), ("a—b", "a-b"), ("½", "1/2"), ("l", "I"), ("0", "O"), ("①", "1")]


@pytest.mark.parametrize("a,b", SAME)
def test_same(a, b):
    assert consistent(a, {}, {}) == consistent(b, {}, {})


@pytest.mark.parametrize("a,b", DIFFERENT)
def test_different(a, b):
    assert consistent(a, {}, {}) != consistent(b, {}, {})


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcoepxyA BC.-éïй" + "".join(CYRILLIC) + "".join(GREEK) + "　​ﬁ℃²⁹ά"), max_size=25))
def test_form_keeps_the_look_and_is_stable(t):
    f = consistent(t, {"ab": -1.0, "": -9.0}, {})
    assert skeleton(f) == skeleton(t)
    assert consistent(f, {"ab": -1.0, "": -9.0}, {}) == f


def test_script_follows_the_context(spark):
    docs = spark.createDataFrame([("осадок и корма растут в воде",), ("the corn was fed to pigs",)], "t string")
    s = bigram_scores(docs, "t")
    assert consistent("The сorn", s, {}) == "The corn"
    assert consistent("кoрма в вoде", s, {}) == "корма в воде"
    assert viterbi("op", "L", s) == "op"


def test_frame(spark):
    rows = [(1, "Dietary", 0), (2, "Dіеtаrу", 0), (3, "Dietary", 0), (4, "dietary", 0), (5, None, 0), (6, "", 0), (7, "​", 0), (8, "Diet­ary", 0), (None, "Dіеtary", 0), (2, "Dіеtаrу", 0), (9, "z" * 30000, 0), (10, "z" * 30000 + "​", 0)]
    df = spark.createDataFrame(rows, "a long, text string, form int")
    got = sorted(tuple(r) for r in look_alike_pairs(df, "a", "text").collect())
    base = {k: t for k, t, _ in rows if k is not None and t is not None}
    want = sorted((x, y) for x, y in itertools.combinations(sorted(base), 2) if base[x] != base[y] and skeleton(base[x]) == skeleton(base[y]))
    assert got == want and (1, 2) in got and (1, 3) not in got and (6, 7) in got and (9, 10) in got
    assert look_alike_pairs(df.limit(0), "a", "text").count() == 0
    forms = {r["a"]: r["out"] for r in consistent_forms(df, "text", "out").collect()}
    assert forms[5] is None and forms[6] == "" == forms[7] and forms[1] == forms[2] and len(forms[9]) == 30000


def test_hot_spellings_and_classes(spark):
    rows = [(i, "Dietary thymol" if i % 3 else "Dіеtary thymol") for i in range(60)] + [(100, "Diet­ary thymol"), (101, "unique"), (102, None), (100, "Diet­ary thymol")]
    df = spark.createDataFrame(rows, "a long, text string")
    base = {k: t for k, t in rows if t is not None}
    want = sorted((x, y) for x, y in itertools.combinations(sorted(base), 2) if base[x] != base[y] and skeleton(base[x]) == skeleton(base[y]))
    links = {k: sum(k in p for p in want) for k in base}
    for hot in (3, 10**9):
        assert sorted(map(tuple, look_alike_pairs(df, "a", "text", hot_rows=hot).collect())) == want
        got = sorted(map(tuple, look_alike_classes(df, "a", "text", hot_rows=hot).collect()))
        assert got == sorted((k, 0, n) for k, n in links.items() if n)
    assert look_alike_classes(df.limit(0), "a", "text").count() == 0
