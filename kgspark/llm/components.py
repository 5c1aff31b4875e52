"""Consolidating pairwise matches into groups by seed-tree pruning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import HOT_ROWS, hottest, lookup_join
from ..session import checkpointed


def _with_least(rows: DataFrame, values: dict[str, str], most: int, hot_rows: int) -> DataFrame:
    """``rows`` (s, u, ...) with, by name, the least of a column among all rows of their vertex.

    One shuffle by vertex serves the aggregate and its way back. If there may be vertices with ``hot_rows`` rows or more
    (``most`` bounds the number of all rows), those take the other way: their least is aggregated on the map side and
    broadcast, and their rows stay where they are.
    """
    least = {name: F.min(v) for name, v in values.items()}
    over = lambda df: df.withColumns({name: c.over(Window.partitionBy("s", "u")) for name, c in least.items()})
    if most < hot_rows:
        return over(rows)
    rows = checkpointed(rows)
    sums = rows.groupBy("s", "u").agg(F.count(F.lit(1)).alias("deg"), *(c.alias(name) for name, c in least.items()))
    hot = hottest(sums.select("s", "u", "deg"), "deg", hot_rows)
    if hot is None:
        return over(rows)
    hot = F.broadcast(hot)
    warm = rows.join(hot, ["s", "u"], "left_semi").join(F.broadcast(sums.drop("deg").join(hot, ["s", "u"], "left_semi")), ["s", "u"])
    return over(rows.join(hot, ["s", "u"], "left_anti")).unionByName(warm)


def group_matches(pairs: DataFrame, left: str, right: str, scope: str | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(scope, record_id, group_id): one row for each record linked to another; group_id is the group's smallest id.

    Seed-tree pruning. In each round every vertex links itself and its neighbours to the least vertex of its
    neighbourhood; a vertex that is nobody's least then drops out and hangs, in a propagation forest, under the least
    vertex it knows, while the leasts it knows are linked to one another and go on. Each round leaves far fewer
    vertices, so the rounds grow with the logarithm of the longest chain. What never drops out is a seed, the least
    of its group. Seed ids then flow down the forest, latest round first: a parent drops out later than its children,
    so one join a round labels them all, and a round adds its labels to those there without writing them again.

    A round is one job and one table in the checkpoint folder: links once each way by vertex, what the vertices know
    (distinct, combined before the shuffle) by vertex, the links that remain. ``scope`` separates id spaces that
    overlap. Vertices of very high degree keep their rows in place (``_with_least``).

    Pairs with a null side or scope and pairs of a record with itself link nothing; repeats and both directions count
    once; an empty table gives an empty result; other columns of ``pairs`` are ignored, whatever their names.
    """
    s = F.col(scope) if scope else F.lit("")
    e = pairs.select(s.alias("s"), F.col(left).cast("long").alias("x"), F.col(right).cast("long").alias("y"))
    e = e.where(F.col("s").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull() & (F.col("x") != F.col("y")))
    links = checkpointed(e.select("s", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    forest: list[tuple[DataFrame, int]] = []
    n = links.count()
    while n:  # the number of links, or more if some are there several times
        each = F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")
        # min selection: u sends the least of its neighbourhood to all of it, itself included
        edges = _with_least(links.select("s", each).select("s", "e.*"), {"m": "v"}, 2 * n, hot_rows).withColumn("m", F.least("m", "u"))
        known = edges.select("s", F.explode(F.array(F.struct(F.col("v").alias("u"), "m"), F.struct("u", "m"))).alias("e")).select("s", "e.*").distinct()
        # u is somebody's least if its own id was sent to it
        own = known.withColumn("own", F.when(F.col("m") == F.col("u"), F.col("u")))
        judged = checkpointed(_with_least(own, {"top": "m", "stays": "own"}, 4 * n, hot_rows))
        # pruning: who is nobody's least leaves the graph and hangs under the least it knows
        forest.append((judged.where("stays IS NULL AND m = top").select("s", "u", F.col("top").alias("parent")), 4 * n))
        rest = judged.where("m <> top").select("s", F.col("top").alias("a"), F.col("m").alias("b"))
        links, n = rest.distinct(), rest.count()
    labels: list[DataFrame] = []
    for tree, most in reversed(forest):
        if labels:
            above = reduce(DataFrame.unionByName, labels).select("s", F.col("u").alias("parent"), "label")
            tree = lookup_join(tree, above, ["s", "parent"], "left", hot_rows=hot_rows, hot=None if most < hot_rows else "find").select("s", "u", F.coalesce("label", "parent").alias("label"))
            labels.append(checkpointed(tree))
        else:
            labels.append(tree.withColumnRenamed("parent", "label"))
    found = reduce(DataFrame.unionByName, labels) if labels else links.select("s", F.col("a").alias("u"), F.col("b").alias("label"))
    out = found.unionByName(found.select("s", F.col("label").alias("u"), "label").distinct())
    named = [F.col("s").alias(scope)] if scope else []
    return out.select(*named, F.col("u").alias("record_id"), F.col("label").alias("group_id"))
