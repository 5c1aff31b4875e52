"""Shares reached, repeats kept, marginals raked."""

import random

from pyspark.sql import functions as F

from kgspark.llm import mixing
from kgspark.llm.mixing import marginals, mix, rake, shares

DOCS = "doc_id long, source string, lang string, n long, weight string"


def corpus(spark, n=3000):
    random.seed(9)
    rows = [(i, random.choices(["big", "mid", "small", "other", None], [60, 25, 8, 5, 2])[0], random.choice(["en", "EN", "de", None]), int(random.lognormvariate(5, 1)), "x") for i in range(n)]
    rows += [(n, "big", "en", 0, "x"), (n + 1, "mid", "en", None, "x")]
    return spark.createDataFrame(rows, DOCS)


def test_shares(spark):
    docs = corpus(spark)
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.2, 4)], "source string, target_share double, max_repeats int")
    m = mix(docs, targets, key="doc_id", size="n", others=["lang"]).cache()
    assert m.count() == docs.where("source IN ('big', 'mid', 'small')").count()
    assert m.where("n = 0 AND copies > 0").isEmpty()
    assert m.where("copies < floor(weight) OR copies > ceil(weight + 0.000001)").isEmpty()
    for r in shares(m, targets, "n").collect():
        assert abs(r["actual_share"] / r["target_share"] - 1) < 0.02 and r["most_copies"] <= r["max_repeats"]
    tight = [r for r in shares(m, targets, "n").collect() if r["tokens_used"] >= 0.99 * r["max_repeats"] * r["tokens_there"]]
    assert tight
    by = {r["l"]: r["t"] for r in m.join(docs.select("doc_id", "lang"), "doc_id").groupBy(F.coalesce(F.lower("lang"), F.lit("")).alias("l")).agg(F.sum(F.col("n") * F.col("copies")).alias("t")).collect()}
    have = {r["l"]: r["t"] for r in docs.where("source IN ('big', 'mid', 'small')").groupBy(F.coalesce(F.lower("lang"), F.lit("")).alias("l")).agg(F.sum("n").alias("t")).collect()}
    for k in have:
        assert abs(by[k] / sum(by.values()) - have[k] / sum(have.values())) < 0.04
    again = mix(docs.repartition(7), targets, key="doc_id", size="n", others=["lang"])
    assert m.select("doc_id", "copies").exceptAll(again.select("doc_id", "copies")).isEmpty()


def test_odd_cases(spark):
    docs = corpus(spark, 200)
    gone = spark.createDataFrame([("big", 0.5, 1), ("absent", 0.5, 3), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    m = mix(docs, gone, key="doc_id", size="n")
    got = {r["source"]: r for r in shares(m, gone.where("source IS NOT NULL"), "n").collect()}
    assert got["absent"]["actual_share"] == 0 and abs(got["big"]["actual_share"] - 1) < 1e-9
    assert mix(docs.limit(0), gone, key="doc_id", size="n", others=["lang"]).count() == 0
    small = mix(docs, gone, key="doc_id", size="n", total=5000.0)
    assert small.agg(F.sum(F.col("n") * F.col("copies")).alias("t")).first()["t"] < 6000


def test_marginals_are_met_to_the_tolerance(spark, monkeypatch):
    # source and language go together, so that raking converges slowly
    rows = [("a", "x", "p", 9800), ("a", "y", "p", 300), ("a", "y", "q", 40), ("b", "x", "q", 300), ("b", "y", "p", 9700), ("b", "x", "p", 60)]
    cells = spark.createDataFrame(rows, "source string, l0 string, l1 string, tokens long")
    sources = spark.createDataFrame([("a", 3000.0, 1000.0), ("b", 2000.0, 1000.0)], "source string, target double, cap double")

    got = rake(cells, sources, ["l0", "l1"]).collect()
    for d, i in (("l0", 1), ("l1", 2)):
        for v in {r[i] for r in rows}:
            want = 5000 * sum(r[3] for r in rows if r[i] == v) / 20200
            assert abs(sum(r["tokens"] * r["weight"] for r in got if r[d] == v) / want - 1) < 0.005
    # more cells than are taken to the driver: the same rounds by aggregates
    here = {tuple(r[c] for c in ("source", "l0", "l1")): r["weight"] for r in rake(cells, sources, ["l0", "l1"], tolerance=0.25).collect()}
    monkeypatch.setattr(mixing, "CELLS", 0)
    there = {tuple(r[c] for c in ("source", "l0", "l1")): r["weight"] for r in rake(cells, sources, ["l0", "l1"], tolerance=0.25).collect()}
    assert here.keys() == there.keys() and all(abs(here[k] / there[k] - 1) < 1e-9 for k in here)


def test_marginals_reported(spark):
    docs = spark.createDataFrame([(i, "s", ("en", "de", None)[i % 3], 10) for i in range(30)], "doc_id long, source string, lang string, n long")
    m = mix(docs, spark.createDataFrame([("s", 1.0, 1)], "source string, target_share double, max_repeats int"), key="doc_id", size="n", others=["lang"])
    got = {r["value"]: r for r in marginals(m, docs, "doc_id", "n", ["lang"]).collect()}
    assert set(got) == {"en", "de", None} and all(abs(r[k] - 1 / 3) < 1e-3 for r in got.values() for k in ("wanted_share", "expected_share", "reached_share"))


def test_factor_reaches_the_target_or_all_caps():
    import numpy as np

    random.seed(3)
    for _ in range(300):
        n = random.randint(1, 6)
        tokens, w, cap = (np.array([random.choice([0.0, 0.5, 1.0, random.random() * 9]) for _ in range(n)]) for _ in range(3))
        most = (tokens * np.where(w > 0, cap, 0)).sum()
        target = random.random() * 1.3 * most + 1e-6
        f = mixing._factor(tokens, w, cap, target)
        got = (tokens * np.minimum(cap, w * f)).sum()
        assert abs(got - min(target, most)) <= 1e-6 * max(target, 1), (tokens, w, cap, target, f)
    assert mixing._factor(np.array([2.0]), np.array([1.0]), np.array([np.inf]), 5.0) == 2.5


def test_impossible_marginals_are_warned_of(spark):
    import pytest

    cells = spark.createDataFrame([("a", "x", 100), ("a", "y", 100), ("b", "x", 900)], "source string, l0 string, tokens long")
    sources = spark.createDataFrame([("a", 150.0, 1.0), ("b", 50.0, 1.0)], "source string, target double, cap double")
    with pytest.warns(UserWarning, match="marginals"):
        got = rake(cells, sources, ["l0"]).collect()
    for s, t in (("a", 150.0), ("b", 50.0)):
        assert abs(sum(r["tokens"] * r["weight"] for r in got if r["source"] == s) - t) < 1e-3
