"""Orphan references: reasons, the cascade, odd inputs."""

import datetime as dt

from kgspark.operators.orphans import Reference, Source, find_orphans
from kgspark.operators.skew import lookup_join

DAY = [dt.datetime(2024, 1, d + 1, tzinfo=dt.UTC) for d in range(9)]
CHILD = "id long, document_id string, ref string, loaded_at timestamp, target string"
PARENT = "pid long, document_id string, name string, up string, loaded_at timestamp, deleted_at timestamp"


def found(spark, children, parents, refs=None, hot_rows=10**9):
    src = {
        "c": Source(spark.createDataFrame(children, CHILD), "id"),
        "p": Source(spark.createDataFrame(parents, PARENT), "pid", deleted="deleted_at"),
    }
    refs = refs or [Reference("c", "ref", "p", "name")]
    return sorted((r["ref_table"], r["record_id"], r["ref_month"], r["reason"], r["kind"], r["depth"]) for r in find_orphans(src, refs, hot_rows).collect())


def test_reasons(spark):
    parents = [(1, "d", "A-b_c", None, DAY[1], None), (2, "d", "gone", None, DAY[0], DAY[1]), (3, "d", "late", None, DAY[5], None), (4, "d", "late", None, DAY[0], DAY[1]), (5, "d", None, None, DAY[0], None)]
    children = [
        (1, "d", "a b  C ", DAY[2], "x"), (2, "d", "Gone", DAY[2], "x"), (3, "d", "late", DAY[2], "x"), (4, "d", "none", DAY[2], "x"), (4, "d", "none", DAY[2], "x"),
        (5, "e", "a b c", DAY[2], "x"), (6, "d", " _ ", DAY[2], "x"), (7, "d", None, DAY[2], "x"), (8, "d", "late", None, "x"), (9, None, "a b c", DAY[2], "x"), (None, "d", "none", DAY[2], "x"),
    ]
    want = [("c", 2, "2024-01", "deleted", "direct", 0), ("c", 3, "2024-01", "late", "direct", 0), ("c", 4, "2024-01", "missing", "direct", 0), ("c", 5, "2024-01", "missing", "direct", 0), ("c", 9, "2024-01", "missing", "direct", 0)]
    assert found(spark, children, parents) == want
    assert found(spark, children, parents, hot_rows=1) == want


def test_cascade(spark):
    parents = [(1, "d", "top", None, DAY[0], None), (2, "d", "mid", "absent", DAY[0], None), (3, "d", "low", "mid", DAY[0], None), (4, "d", "ok", "top", DAY[0], None), (5, "d", "loop", "loop", DAY[0], None)]
    children = [(1, "d", "low", DAY[2], ""), (2, "d", "ok", DAY[2], ""), (3, "d", "loop", DAY[2], "")]
    refs = [Reference("c", "ref", "p", "name"), Reference("p", "up", "p", "name")]
    got = found(spark, children, parents, refs)
    assert got == [("c", 1, "2024-01", "inherited", "inherited", 2), ("p", 2, "2024-01", "missing", "direct", 0), ("p", 3, "2024-01", "inherited", "inherited", 1)]


def test_empty(spark):
    assert found(spark, [], []) == []
    assert [x[:2] for x in found(spark, [(1, "d", "x", DAY[0], "")], [])] == [("c", 1)]


def test_lookup_join(spark):
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(60)] + [(99, None)], "i long, k string")
    small = spark.createDataFrame([("hot", 1), ("k3", 2)], "k string, v long")
    for how in ("left", "inner"):
        a = sorted(map(str, lookup_join(big, small, ["k"], how, hot_rows=5).collect()))
        assert a == sorted(map(str, big.join(small, ["k"], how).collect()))
