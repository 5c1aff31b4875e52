"""Running totals over a distributed order."""

import random

from pyspark.sql import functions as F

from kgspark.operators.ranking import ordered_totals


def test_totals(spark):
    random.seed(3)
    rows = [(i, random.choice(["a", "a", "a", "b", None]), random.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, g string, v long").repartition(7)
    got = {r["id"]: (r["n"], r["s"]) for r in ordered_totals(df, [F.desc("v"), F.col("id")], {"n": F.lit(1), "s": F.col("v")}, within=["g"]).collect()}
    for g in ("a", "b", None):
        n = s = 0
        for i, _, v in sorted((r for r in rows if r[1] == g), key=lambda r: (-r[2], r[0])):
            assert got[i] == (n, s)
            n, s = n + 1, s + v
    whole = ordered_totals(df, [F.col("id")], {"n": F.lit(1)})
    assert [r["n"] for r in whole.orderBy("id").collect()] == list(range(500))
    assert ordered_totals(df.limit(0), [F.col("id")], {"n": F.lit(1)}, within=["g"]).count() == 0
