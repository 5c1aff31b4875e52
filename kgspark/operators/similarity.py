"""Similarity joins that find their pairs through equal keys, so that no group is paired with itself."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed

#: A scope of which one side has at most this many rows is joined by the scope alone: no row meets more rows than about
#: as many keys as its grams or words would make of it. Larger scopes meet through such keys.
SCOPE_ROWS = 64


def wide_scopes(left: DataFrame, right: DataFrame, scope: Sequence[str], most: int = SCOPE_ROWS) -> DataFrame | None:
    """The scopes with more than ``most`` rows on both sides; None if there are none. They are stored, not collected."""
    count = lambda df, n: df.groupBy(*scope).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > most)
    wide = checkpointed(unplanned(count(left, "__l")).join(unplanned(count(right, "__r")), list(scope)).select(*scope))
    return None if wide.isEmpty() else wide


def unplanned(df: DataFrame) -> DataFrame:
    """``df`` for a join that sorts both sides and is never made a broadcast: the planner takes a table for as large as
    its compressed columns, and what is exploded from it for no larger, so it may send far more to the driver than fits."""
    return df.hint("merge")


def halves(df: DataFrame, wide: DataFrame | None, scope: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """The rows of scopes that aren't wide, null scopes among them, and those of scopes that are."""
    if wide is None:
        return df, None
    return df.join(unplanned(wide), list(scope), "left_anti"), df.join(unplanned(wide), list(scope), "left_semi")


def beside(left: DataFrame, right: DataFrame, scope: Sequence[str], test: Column, how: str) -> DataFrame:
    """``left`` joined to ``right`` by the scope alone where ``test`` holds; the scope's columns are those of the left."""
    other = unplanned(right.withColumnsRenamed({s: f"__scope_{s}" for s in scope}))
    same = reduce(lambda x, y: x & y, (F.col(s) == F.col(f"__scope_{s}") for s in scope))
    return left.join(other, same & test, how).drop(*(f"__scope_{s}" for s in scope))


def shares_words(a: str, b: str, least: int) -> Column:
    """Two texts with single blanks between their words have at least ``least`` different words in common."""
    words = lambda c: F.filter(F.split(c, " "), lambda w: w != "")
    return F.size(F.array_intersect(words(a), words(b))) >= least


def _named(df: DataFrame, scope: Sequence[str], name: str) -> DataFrame:
    return df.select(*scope, F.col(name).alias("__n")).where("__n <> ''").distinct()


def near_join(left: DataFrame, right: DataFrame, scope: Sequence[str], a: str, b: str, edits: int) -> DataFrame:
    """Rows of both sides of one scope whose texts are within ``edits`` edits, as (scope, a, b, edits).

    A text cut into edits + 1 segments keeps one of them unchanged, moved by at most ``edits`` places, in any text within
    reach. So the segments of the left meet the substrings of that length and place of the right by an equi-join, and
    only what meets is compared. Texts too short to cut meet by length; there are few different ones. Blank texts are
    near nothing; each pair of different texts is there once.
    """
    k, scope = edits, list(scope)
    plan = unplanned if scope else lambda df: df  # without a scope one side is a vocabulary
    named = lambda df, c: df.select(*scope, F.col(c).alias("__n")).where("__n <> ''").distinct().withColumn("__len", F.char_length("__n"))
    mine, theirs = named(left, a), named(right, b)

    def place(length, i):
        base, rest = F.floor(length / (k + 1)).cast("int"), (length % (k + 1)).cast("int")
        extra = F.greatest(F.lit(0), i - (F.lit(k + 1) - rest))
        return i * base + extra, base + (i >= F.lit(k + 1) - rest).cast("int")

    i = F.explode(F.sequence(F.lit(0), F.lit(k))).alias("__i")
    segs = mine.where(F.col("__len") > k).select(*scope, "__n", "__len", i)
    at, size = place(F.col("__len"), F.col("__i"))
    segs = segs.select(*scope, F.col("__n").alias("__a"), "__len", "__i", F.col("__n").substr(at + 1, size).alias("__part"))
    probe = theirs.where(F.col("__len") > 0).select(*scope, "__n", F.col("__len").alias("__own"), F.explode(F.sequence(F.greatest(F.col("__len") - k, F.lit(k + 1)), F.greatest(F.col("__len") + k, F.lit(k + 1)))).alias("__len"))
    probe = probe.select(*scope, "__n", "__own", "__len", i).select("*", F.explode(F.sequence(F.lit(-k), F.lit(k))).alias("__d"))
    at, size = place(F.col("__len"), F.col("__i"))
    probe = probe.withColumns({"__at": at + F.col("__d"), "__size": size}).where("__at >= 0 AND __at + __size <= __own")
    probe = probe.select(*scope, F.col("__n").alias("__b"), "__len", "__i", F.substring("__n", F.col("__at") + 1, F.col("__size")).alias("__part")).distinct()
    met = segs.join(plan(probe), [*scope, "__len", "__i", "__part"]).select(*scope, "__a", "__b")
    reach = theirs.where(F.col("__len") <= 2 * k).select(*scope, F.col("__n").alias("__b"), F.explode(F.sequence(F.greatest(F.col("__len") - k, F.lit(1)), F.least(F.col("__len") + k, F.lit(k)))).alias("__len")) if k else None
    short = [mine.where(F.col("__len") <= k).select(*scope, F.col("__n").alias("__a"), "__len").join(plan(reach.where("__len >= 1")), [*scope, "__len"]).select(*scope, "__a", "__b")] if k else []
    both = reduce(DataFrame.unionByName, short, met).distinct().withColumn("edits", F.levenshtein("__a", "__b", k)).where("edits >= 0")
    return both.withColumnsRenamed({"__a": a, "__b": b})


def near_pairs(df: DataFrame, scope: Sequence[str], name: str, edits: int) -> DataFrame:
    """(scope, a, b), a < b: distinct names of a scope within ``edits`` edits, found by ``near_join``."""
    names = df.select(*scope, F.col(name).alias("a"), F.col(name).alias("b"))
    return near_join(names.drop("b"), names.drop("a"), scope, "a", "b", edits).where("a < b").select(*scope, "a", "b")


def contained_pairs(df: DataFrame, scope: Sequence[str], name: str, least: float) -> DataFrame:
    """(scope, a, b), a < b: distinct names of which one lies in the other and has at least ``least`` of its length.

    A name offers its substrings of that length or more (a fraction of the square of its own length), and they meet the
    names they equal; what meets is a pair.
    """
    n = _named(df, scope, name)
    size = F.char_length("__n")
    lengths = n.select(*scope, "__n", F.explode(F.sequence(F.greatest(F.ceil(size * least - 1e-9).cast("int"), F.lit(1)), size)).alias("__k"))
    subs = lengths.select(*scope, F.col("__n").alias("__long"), F.explode(F.sequence(F.lit(1), F.char_length("__n") - F.col("__k") + 1)).alias("__at"), "__k")
    subs = subs.select(*scope, "__long", F.col("__long").substr(F.col("__at"), F.col("__k")).alias("__n")).where("__n <> __long").distinct()
    met = subs.join(unplanned(n), [*scope, "__n"])
    return met.select(*scope, F.least("__n", "__long").alias("a"), F.greatest("__n", "__long").alias("b")).distinct()


def contains_join(left: DataFrame, right: DataFrame, scope: Sequence[str], a: str, b: str) -> DataFrame:
    """Rows of both sides of one scope of whose texts one contains the other; both texts are not blank.

    The shorter text's first three characters (or all, if it has fewer) occur in the longer; so its opening meets the
    grams of the longer by an equi-join in either direction, and only what meets is compared. Columns but the scope
    must have different names.
    """
    def opening(df: DataFrame, c: str) -> DataFrame:
        return df.where(F.col(c) != "").withColumn("__g", F.substring(c, 1, 3))

    def grams(df: DataFrame, c: str) -> DataFrame:
        n = F.char_length(c)
        each = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(3), n - i + 1)), lambda k: F.col(c).substr(i, k))))
        return df.where(F.col(c) != "").select("*", F.explode(F.array_distinct(each)).alias("__g"))

    cols = [*scope, *(c for c in left.columns if c not in scope), *(c for c in right.columns if c not in scope)]
    plan = unplanned if scope else lambda df: df  # without a scope one side is a vocabulary
    one = grams(left, a).join(plan(opening(right, b)), [*scope, "__g"]).where(F.col(a).contains(F.col(b)))
    two = opening(left, a).join(plan(grams(right, b)), [*scope, "__g"]).where(F.col(b).contains(F.col(a)) & (F.col(a) != F.col(b)))
    return one.select(*cols).unionByName(two.select(*cols))


def words_join(left: DataFrame, right: DataFrame, scope: Sequence[str], a: str, b: str, least: int) -> DataFrame:
    """Rows of both sides of one scope whose texts share at least ``least`` different words between blanks."""
    word = lambda df, c: df.select("*", F.explode(F.array_distinct(F.filter(F.split(c, " "), lambda w: w != ""))).alias("__w"))
    cols = [*scope, *(c for c in left.columns if c not in scope), *(c for c in right.columns if c not in scope)]
    met = word(left, a).join(unplanned(word(right, b)), [*scope, "__w"])
    return met.groupBy(*cols).agg(F.count_distinct("__w").alias("__shared")).where(F.col("__shared") >= least).select(*cols)


def overlapping(left: DataFrame, right: DataFrame, scope: str, ident: str, start: str, end: str, width: int = 1024) -> DataFrame:
    """(ident) of the left rows whose interval overlaps one of the right in the same scope; null intervals overlap none.

    Intervals meet through the bins of ``width`` that they touch, so a scope with very many is not paired with itself.
    """
    bins = F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.greatest(F.col(end) - 1, F.col(start)) / width))).alias("__b")
    sound = (F.col(start).isNotNull()) & F.col(end).isNotNull()
    mine = left.where(sound).select(F.col(scope).alias("__d"), ident, F.col(start).alias("__s"), F.col(end).alias("__e"), bins)
    theirs = right.where(sound).select(F.col(scope).alias("__d"), F.col(start).alias("__t"), F.col(end).alias("__f"), bins)
    return mine.join(theirs, ["__d", "__b"]).where("__s < __f AND __t < __e").select(ident).distinct()
