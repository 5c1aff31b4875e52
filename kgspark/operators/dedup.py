"""Deduplicating mentions: grouping by identity and merging in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import nonblank, strip


def longest(value: Column, order: Column) -> Column:
    """Aggregate: the longest value, of equals the first in order."""
    return F.max_by(value, F.struct(F.char_length(value), -order))


def first_stated(value: Column, order: Column) -> Column:
    """Aggregate: the first value in order that isn't blank."""
    return F.min_by(value, F.when(nonblank(value).isNotNull(), order))


def joined(parts: Column, separator: str) -> Column:
    """Parts in order joined, without those that an earlier or later part contains; blanks don't count."""
    clean = F.filter(F.transform(parts, strip), lambda p: p != "")
    distinct = F.array_distinct(clean)
    kept = F.filter(distinct, lambda p: ~F.exists(distinct, lambda q: (q != p) & q.contains(p)))
    return F.array_join(kept, separator)


def in_order(value: Column, order: Column) -> Column:
    """Aggregate: the values as an array in the given order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda s: s["v"])


def merge_groups(mentions: DataFrame, keys: Sequence[str], *, order: str, text: str, evidence: str | None = None, attributes: str | None = None, separator: str = "\n---\n", rule: str = "longest", lists: Sequence[str] = (), source: str | None = None) -> DataFrame:
    """One row per group: first order, longest text, evidence joined, attributes merged, number of rows, merged texts.

    ``rule`` is 'longest' (of each attribute the longest value) or 'first' (the first stated one). Attributes are
    merged by key in a shuffle of their own, so a group's rows are never gathered for them; texts and evidence are
    gathered per group once equal ones are dropped, which bounds them by what differs. Attributes named in ``lists`` hold
    JSON arrays and are united, their members in the order in which they first occur. With ``source`` the column
    merged_from lists the different sources of a group of several rows, sorted.
    """
    o = F.col(order)
    out = mentions.groupBy(*keys).agg(F.min(o).alias(order), longest(F.col(text), o).alias(text), F.count(F.lit(1)).alias("n_rows"))
    if evidence:
        parts = mentions.where(strip(F.col(evidence)) != "").groupBy(*keys, F.col(evidence).alias("__e")).agg(F.min(o).alias("__o"))
        ev = parts.groupBy(*keys).agg(joined(in_order(F.col("__e"), F.col("__o")), separator).alias(evidence))
        out = out.join(ev, list(keys), "left").withColumn(evidence, F.coalesce(evidence, F.lit("")))
    if attributes:
        long = mentions.select(*keys, o.alias("__o"), F.explode(attributes).alias("__k", "__v")).where(strip(F.col("__v")) != "")
        pick = longest(F.col("__v"), F.col("__o")) if rule == "longest" else F.min_by("__v", "__o")
        one = long.where(~F.col("__k").isin(*lists)).groupBy(*keys, "__k").agg(pick.alias("__v"))
        if lists:
            each = long.where(F.col("__k").isin(*lists)).select(*keys, "__k", "__o", F.posexplode(F.coalesce(F.from_json("__v", "array<string>"), F.array("__v"))).alias("__i", "__m"))
            members = each.where(strip(F.col("__m")) != "").groupBy(*keys, "__k", "__m").agg(F.min(F.struct("__o", "__i")).alias("__f"))
            one = one.unionByName(members.groupBy(*keys, "__k").agg(F.to_json(in_order(F.col("__m"), F.col("__f"))).alias("__v")))
        maps = one.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__k", "__v")))).alias(attributes))
        out = out.join(maps, list(keys), "left")
    if source:
        parts = mentions.select(*keys, F.col(source).alias("__s")).where("__s IS NOT NULL").distinct().groupBy(*keys).agg(F.array_sort(F.collect_list("__s")).alias("merged_from"))
        out = out.join(parts, list(keys), "left").withColumn("merged_from", F.when(F.col("n_rows") > 1, F.col("merged_from")))
    return out


def across_documents(mentions: DataFrame, keys: Sequence[str], document: str, text: str, order: str) -> DataFrame:
    """One row per identity over all documents, with the sorted documents it comes from."""
    docs = mentions.select(*keys, document).distinct().groupBy(*keys).agg(F.array_sort(F.collect_list(document)).alias("documents"))
    best = mentions.groupBy(*keys).agg(longest(F.col(text), F.col(order)).alias(text))
    return best.join(docs, list(keys))


def spellings(mentions: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Identities written in more than one way, with the ways."""
    ways = mentions.groupBy(*keys, text).agg(F.count(F.lit(1)).alias("__n"))
    return ways.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_spellings"), F.array_join(F.array_sort(F.collect_list(text)), " | ").alias("spellings")).where("n_spellings > 1")
