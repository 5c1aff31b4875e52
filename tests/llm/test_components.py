"""Groups of matches against union-find; chains, hubs, odd rows."""

import random

import pytest

from kgspark.llm.components import group_matches

SCHEMA = "kind string, l long, r long, record_id long"


def brute(rows):
    up = {}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, a, b, _ in rows:
        if k is None or a is None or b is None or a == b:
            continue
        for x in ((k, a), (k, b)):
            up.setdefault(x, x)
        x, y = sorted((root((k, a)), root((k, b))))
        up[y] = x
    return sorted((k, i, root((k, i))[1]) for k, i in up)


def found(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted((r["kind"], r["record_id"], r["group_id"]) for r in group_matches(df, "l", "r", scope="kind", **kw).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_random(spark, seed):
    random.seed(seed)
    rows = [(random.choice("AB"), random.randint(-50, 250), random.randint(-50, 250), 7) for _ in range(260)]
    assert found(spark, rows) == brute(rows)


def test_chain_hub_and_hot_keys(spark):
    ids = list(range(60))
    random.seed(5)
    random.shuffle(ids)
    rows = [("A", a, b, 0) for a, b in zip(ids, ids[1:])] + [("B", 1000, i, 0) for i in range(80)] + [("B", i, 1000, 0) for i in range(80)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, hot_rows=10) == brute(rows)


def test_odd_rows(spark):
    rows = [("A", 1, 1, 0), ("A", None, 2, 0), ("A", 3, None, 0), (None, 4, 5, 0), ("A", 6, 7, 0), ("A", 6, 7, 0), ("A", 7, 6, 0), ("B", 7, 8, 0)]
    assert found(spark, rows) == [("A", 6, 6), ("A", 7, 6), ("B", 7, 7), ("B", 8, 7)]
    assert found(spark, []) == [] == found(spark, [("A", 1, 1, 0)])
    df = spark.createDataFrame([(1, 2), (2, 3)], "l long, r long")
    assert group_matches(df, "l", "r").columns == ["record_id", "group_id"] and group_matches(df, "l", "r").count() == 3
