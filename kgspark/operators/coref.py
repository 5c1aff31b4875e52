"""Coreference within a document: alias maps, pairs of names by joins, and one ordered pass over the pairs."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import abbreviates, contained, coref_name, nonblank, strip
from .similarity import beside, contained_pairs, halves, near_pairs, unplanned, wide_scopes


def alias_map(mentions: DataFrame, scope: Sequence[str], name: str, abbreviation: str) -> DataFrame:
    """(scope, alias, canonical): abbreviations beside the full name they are stated with; of several the shortest name."""
    full, short = coref_name(F.col(name)), coref_name(F.col(abbreviation))
    pairs = mentions.select(*scope, short.alias("alias"), full.alias("canonical")).where("alias <> '' AND canonical <> '' AND alias <> canonical")
    return pairs.groupBy(*scope, "alias").agg(F.min_by("canonical", F.struct(F.char_length("canonical"), "canonical")).alias("canonical"))


def subset_aliases(mentions: DataFrame, scope: Sequence[str], name: str) -> DataFrame:
    """(scope, alias, canonical): longer names that have all the words of a shorter name point to the shorter one.

    Names meet only through a shared word, so nothing is paired that has no word in common.
    """
    n = mentions.select(*scope, coref_name(F.col(name)).alias("n")).where("n <> ''").distinct().withColumn("w", F.array_distinct(F.split("n", " "))).where(F.size("w") >= 2)
    least = n.withColumn("k", F.array_min("w"))
    other = n.select(*scope, F.col("n").alias("m"), F.col("w").alias("v"), F.explode("w").alias("k"))
    hit = least.join(other, [*scope, "k"]).where((F.size("w") < F.size("v")) & (F.size(F.array_except("w", "v")) == 0))
    return hit.groupBy(*scope, F.col("m").alias("alias")).agg(F.min_by("n", F.struct(F.char_length("n"), "n")).alias("canonical"))


def name_pairs(keys: DataFrame, texts: DataFrame, scope: Sequence[str], edits: int = 1, overlap: float = 0.6, wide: DataFrame | None | str = "find") -> DataFrame:
    """(scope, a, b, way): keys of one scope that may name the same thing, each pair once.

    way 'near' is at most ``edits`` edits, 'inside' is one key inside the other (at least ``overlap`` of its length),
    'short' is a text of one (``texts``: scope, key, text) that abbreviates a text of the other. The keys of a scope meet
    each other; in scopes with many (``wide``, if the caller knows them) all three are equi-joins: on segments, on
    substrings, and on an abbreviation's first letter among the letters of the full name.
    """
    if isinstance(wide, str):
        wide = wide_scopes(texts, texts, scope)
    (few_k, many_k), (few_t, many_t) = halves(keys.select(*scope, "key"), wide, scope), halves(texts.select(*scope, "key", "text"), wide, scope)
    size = F.char_length(strip(F.col("text")))
    short = lambda df: df.where(size.between(1, 5)).select(*scope, F.col("key").alias("a"), F.col("text").alias("__s"), F.lower(F.substring(strip(F.col("text")), 1, 1)).alias("__c"))
    full = lambda df, *more: df.where(size > 5).select(*scope, F.col("key").alias("b"), F.col("text").alias("__f"), *more)
    stands = (F.col("a") != F.col("b")) & abbreviates(F.col("__s"), F.col("__f"))
    pair = lambda df: df.select(*scope, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit("short").alias("way")).distinct()
    a, b = F.col("a"), F.col("b")
    # the lengths allow only so many edits
    near = (F.abs(F.char_length(a) - F.char_length(b)) <= edits) & (F.levenshtein(a, b, edits) >= 0)
    way = F.explode(F.array_compact(F.array(F.when(near, F.lit("near")), F.when(contained(a, b, overlap - 1e-9), F.lit("inside"))))).alias("way")
    named = few_k.where("key <> ''").distinct()
    met = beside(named.withColumnRenamed("key", "a"), named.withColumnRenamed("key", "b"), scope, a < b, "inner")
    ways = [met.select(*scope, "a", "b", way), pair(beside(short(few_t), full(few_t), scope, F.lower("__f").contains(F.col("__c")) & stands, "inner"))]
    if wide is not None:
        ways += [near_pairs(many_k, scope, "key", edits).withColumn("way", F.lit("near")), contained_pairs(many_k, scope, "key", overlap).withColumn("way", F.lit("inside"))]
        letters = F.explode(F.array_distinct(F.split(F.lower("text"), ""))).alias("__c")
        ways.append(pair(short(many_t).join(unplanned(full(many_t, letters)), [*scope, "__c"]).where(stands)))
    return reduce(DataFrame.unionByName, ways)


def merge_in_order(place: Mapping[str, int], pairs: Iterable[tuple[str, str, str]]) -> dict[str, str]:
    """The group that each key goes to, by one pass over the pairs in the order of the keys.

    Every key in turn joins the first group before it whose own key is near. Then every group in turn meets the later
    groups it is paired with, in their order: that the keys lie in one another, or that any of their texts abbreviates
    one. The shorter key goes into the longer (of equal ones the later); who takes another in meets its partners too,
    from there on. Greedy and not transitive, so the order decides, not the components.
    """
    near, inside, short = defaultdict(set), defaultdict(set), defaultdict(set)
    for a, b, way in pairs:
        side = {"near": near, "inside": inside, "short": short}[way]
        side[a].add(b)
        side[b].add(a)
    to: dict[str, str] = {}
    for k in sorted(place, key=place.get):
        before = [g for g in near[k] if to.get(g) == g]
        to[k] = min(before, key=place.get, default=k)

    def group(k: str) -> str:
        while to[k] != k:
            k = to[k]
        return k

    partners = defaultdict(set)  # of each group: the keys that one of its texts is paired with
    for k, g in to.items():
        partners[g] |= short[k]
    for g in sorted((k for k, h in to.items() if k == h), key=place.get):
        now = place[g]
        while to[g] == g:
            later = [k for k in {group(k) for k in partners[g]} | inside[g] if to[k] == k and place[k] > now]
            if not later:
                break
            k = min(later, key=place.get)
            now = place[k]
            keep, lose = (g, k) if len(g) >= len(k) else (k, g)
            to[lose] = keep
            partners[keep] |= partners[lose]
    return {k: group(k) for k in to}


def resolve(mentions: DataFrame, scope: Sequence[str], *, order: str, text: str, attribute: str | None = None, aliases: DataFrame | None = None, fuzzy: bool = True, edits: int = 1, overlap: float = 0.6) -> DataFrame:
    """The mentions with ``group_key``: the key of the group of mentions that name the same thing in their scope.

    Aliases are looked up by equi-join; then pairs of distinct keys are found by joins (``name_pairs``), and only the
    pairs of a scope, which has few, are gathered for the ordered pass; keys without a pair are groups of their own and
    stay where they are. Mentions without a key have no group (null).
    """
    key = coref_name(F.coalesce(nonblank(F.col(attribute)), F.col(text)) if attribute else F.col(text))
    m = mentions.withColumn("__k", F.nullif(key, F.lit("")))
    if aliases is not None:
        m = m.join(unplanned(aliases.select(*scope, F.col("alias").alias("__k"), F.col("canonical").alias("__c"))), [*scope, "__k"], "left").withColumn("__k", F.coalesce("__c", "__k")).drop("__c")
    if not fuzzy:
        return m.withColumnRenamed("__k", "group_key")
    known = m.where("__k IS NOT NULL").select(*scope, F.col("__k").alias("key"), F.col(order).alias("o"), F.col(text).alias("text"))
    keys = known.groupBy(*scope, "key").agg(F.min("o").alias("o"))
    pairs = name_pairs(keys, known.select(*scope, "key", "text").distinct(), scope, edits, overlap, wide_scopes(mentions, mentions, scope))
    for side in ("a", "b"):
        pairs = pairs.join(unplanned(keys.select(*scope, F.col("key").alias(side), F.col("o").alias(f"o_{side}"))), [*scope, side])
    scope = list(scope)
    types = ", ".join(f"`{s}` {mentions.schema[s].dataType.simpleString()}" for s in scope)

    def merged_rows(where: tuple, listed: list[tuple]) -> list[tuple]:
        when = {k: o for a, b, _, o_a, o_b in listed for k, o in ((a, o_a), (b, o_b))}
        place = {k: i for i, k in enumerate(sorted(when, key=lambda k: (when[k], k)))}
        return [(*where, k, g) for k, g in merge_in_order(place, ((a, b, way) for a, b, way, *_ in listed)).items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, listed, out, kinds = None, [], [], []

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[*scope, "__k", "__g"])

        for batch in batches:
            kinds = [*(batch[s].type for s in scope), pa.string(), pa.string()]
            rows = zip(*(batch[c].to_pylist() for c in ("a", "b", "way", "o_a", "o_b")))
            for here, row in zip(zip(*(batch[s].to_pylist() for s in scope)), rows):
                if here != where:
                    out += merged_rows(where, listed) if listed else []
                    where, listed = here, []
                    if len(out) >= 10_000:
                        yield full()
                        out = []
                listed.append(row)
        out += merged_rows(where, listed) if listed else []
        if out:
            yield full()

    # a scope's pairs follow one another, so one scope is held at a time
    merged = pairs.repartition(*scope).sortWithinPartitions(*scope).mapInArrow(run, f"{types}, __k string, __g string")
    return m.join(unplanned(merged), [*scope, "__k"], "left").withColumn("group_key", F.coalesce("__g", "__k")).drop("__k", "__g")
