"""Joins within documents: no table is sent to the driver because it is taken for small, and large documents give the same rows."""

import random

import pytest

from kgspark import queries
from kgspark.operators import coref, lookup, similarity

from .oracle import SF

Q = queries.queries()
WORDS = ["zinc", "oxide", "oregano", "oil", "of", "plant", "ab", "(x)", "acid", "z", "pot", "lime", "ash", "bark", "root", "OOP"]


def names(n, seed, scopes="d"):
    random.seed(seed)
    return [(i, random.choice(scopes), " ".join(random.choice(WORDS) for _ in range(random.randint(0, 5)))) for i in range(n)] + [(n, None, "zinc"), (n + 1, "d", None)]


@pytest.mark.parametrize("name", ["find_targets", "relationships", "dangling_references", "overlapping_targets", "coreferences"])
def test_no_table_is_broadcast_by_its_size(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "BroadcastExchange" not in Q[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_wide_scopes(spark):
    x, y = (spark.createDataFrame([(d,) for d in rows], "d string") for rows in (["a"] * 3 + ["b"] * 4 + [None] * 5, ["a"] * 4 + ["b"] * 2 + [None] * 5))
    assert [tuple(r) for r in similarity.wide_scopes(x, y, ["d"], 2).collect()] == [("a",)]
    assert similarity.wide_scopes(x, y, ["d"], 3) is None


def sides(spark, scopes="dddddde"):
    """References and entities of one document above similarity.SCOPE_ROWS on both sides, and of one below."""
    return spark.createDataFrame(names(90, 1, scopes), "i long, d string, r string"), spark.createDataFrame(names(90, 2, scopes), "k long, d string, n string")


def both_ways(monkeypatch, module, run):
    """Rows with the large document by keys, and with every document by its scope alone."""
    by_keys = run()
    monkeypatch.setattr(module, "wide_scopes", lambda *a, **k: None)
    return by_keys, run()


def test_find_in_a_large_document(spark, monkeypatch):
    refs, ents = sides(spark)
    assert [r["d"] for r in similarity.wide_scopes(refs, ents, ["d"]).collect()] == ["d"]
    a, b = both_ways(monkeypatch, lookup, lambda: sorted(tuple(r) for r in lookup.find(refs, ents, scope=["d"], ref_id="i", ref="r", ident="k", name="n").collect()))
    assert a == b and {t for _, _, t in a} >= {1, 2, 3, 4}


def test_dangling_in_a_large_document(spark, monkeypatch):
    refs, ents = sides(spark)
    a, b = both_ways(monkeypatch, lookup, lambda: sorted(r["i"] for r in lookup.dangling(refs, ents.where("k % 9 > 0 AND n NOT LIKE '%z'"), ["d"], "r", "n").collect()))
    assert a == b and 90 in a and 91 not in a


def test_overlapping_in_a_large_document(spark, monkeypatch):
    refs, ents = sides(spark)
    a, b = both_ways(monkeypatch, lookup, lambda: sorted(r["i"] for r in lookup.overlapping_names(refs, ents.where("n LIKE '%a%' AND n LIKE '% %'"), ["d"], "i", "r", "n").collect()))
    assert a == b and 0 < len(a) < 90


def test_coreferences_in_a_large_document(spark, monkeypatch):
    random.seed(3)
    short = [(200 + i, "d", w) for i, w in enumerate(["ZO", "OOP", "Zi", "PA", "zinc oxid", "zinc oxyde", "plant", "plants"])]
    rows = spark.createDataFrame([*names(90, 4, "ddddddde"), *short], "i long, d string, n string")
    run = lambda: sorted((tuple(r) for r in coref.resolve(rows, ["d"], order="i", text="n").select("i", "group_key").collect()), key=str)
    a, b = both_ways(monkeypatch, coref, run)
    assert a == b and len(a) == 100
