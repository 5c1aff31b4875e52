"""Similarity joins against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from kgspark.operators import similarity as S


@pytest.fixture(scope="module")
def names():
    random.seed(8)
    return [(random.choice("de"), "".join(random.choice("ab c") for _ in range(random.randint(0, 9))).strip()) for _ in range(160)]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def pairs(names, test):
    own = sorted({n for n in names if n[1]})
    return sorted((d, a, b) for d, a in own for e, b in own if d == e and a < b and test(a, b))


@pytest.mark.parametrize("k", [1, 2, 3])
def test_near(spark, names, k):
    df = spark.createDataFrame([*names, ("d", None), (None, "ab")], "d string, n string")
    assert sorted(tuple(r) for r in S.near_pairs(df, ["d"], "n", k).collect()) == pairs(names, lambda a, b: edits(a, b) <= k)


def test_near_join_of_two_sides(spark, names):
    df = spark.createDataFrame(sorted({n[1] for n in names}), "string").withColumnRenamed("value", "n")
    x, y = df.where("length(n) % 2 = 0").withColumnRenamed("n", "x"), df.where("length(n) % 3 > 0").withColumnRenamed("n", "y")
    own = sorted({n[1] for n in names if n[1]})
    want = sorted((a, b, edits(a, b)) for a in own for b in own if len(a) % 2 == 0 and len(b) % 3 and edits(a, b) <= 2)
    assert sorted(tuple(r) for r in S.near_join(x, y, [], "x", "y", 2).collect()) == want


@pytest.mark.parametrize("least", [0.6, 0.3])
def test_contained(spark, names, least):
    df = spark.createDataFrame(names, "d string, n string")
    want = pairs(names, lambda a, b: (a in b or b in a) and min(len(a), len(b)) / max(len(a), len(b)) >= least)
    assert sorted(tuple(r) for r in S.contained_pairs(df, ["d"], "n", least).collect()) == want


def test_contains_and_words(spark, names):
    df = spark.createDataFrame(sorted(set(names)), "d string, n string")
    x, y = df.withColumnRenamed("n", "x"), df.withColumnRenamed("n", "y")
    some = sorted({n for n in names if n[1]})
    want = sorted((d, a, b) for d, a in some for e, b in some if d == e and (a in b or b in a))
    assert sorted(tuple(r) for r in S.contains_join(x, y, ["d"], "x", "y").collect()) == want
    words = lambda s: set(s.split(" ")) - {""}
    want = sorted((d, a, b) for d, a in some for e, b in some if d == e and len(words(a) & words(b)) >= 2)
    assert sorted(tuple(r) for r in S.words_join(x, y, ["d"], "x", "y", 2).collect()) == want


def test_overlapping(spark):
    random.seed(2)
    rows = [(i, random.choice("de"), s, s + random.randint(0, 40)) for i, s in enumerate(random.randint(0, 300) for _ in range(120))] + [(500, "d", None, 3)]
    df = spark.createDataFrame(rows, "i long, d string, s int, e int")
    got = {r["i"] for r in S.overlapping(df.where(F.col("i") % 2 == 0), df.where(F.col("i") % 2 == 1), "d", "i", "s", "e", 16).collect()}
    real = [r for r in rows if r[2] is not None]
    assert got == {a[0] for a in real if a[0] % 2 == 0 for b in real if b[0] % 2 == 1 and a[1] == b[1] and a[2] < b[3] and b[2] < a[3]}
