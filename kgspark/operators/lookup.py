"""Finding the entity that a reference names: alias tables, tiers, dangling and missing targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import initials, relation_name, strip
from .similarity import beside, contains_join, halves, shares_words, unplanned, wide_scopes, words_join


def alias_table(entities: DataFrame, *, scope: Sequence[str], ident: str, text: str, attributes: str) -> DataFrame:
    """(scope, key, ident): every text under which an entity may be named; of several with one key the least id."""
    aliases = F.explode(F.array_distinct(F.concat(F.array(F.col(text)), F.map_values(attributes)))).alias("alias")
    long = entities.select(*scope, ident, aliases).select(*scope, ident, F.lower(strip(F.col("alias"))).alias("key")).where("key <> ''")
    return long.groupBy(*scope, "key").agg(F.min(ident).alias(ident))


def find(references: DataFrame, entities: DataFrame, *, scope: Sequence[str], ref_id: str, ref: str, ident: str, name: str) -> DataFrame:
    """(ref_id, ident, tier) of each reference that names an entity of its scope.

    Tier 1 equal in any case, 2 equal without brackets and punctuation, 3 one contains the other, 4 two or more words
    shared, 5 initials; of the best tier the least id is taken. References meet the entities of their scope; in scopes
    with many of both every tier is an equi-join instead (``_find_by_keys``).
    """
    refs = references.select(*scope, ref_id, F.col(ref).alias("__r")).where(strip(F.col("__r")) != "")
    ents = entities.select(*scope, ident, F.col(name).alias("__n")).where(strip(F.col("__n")) != "")
    wide = wide_scopes(refs, ents, scope)
    (few_r, many_r), (few_e, many_e) = halves(refs, wide, scope), halves(ents, wide, scope)
    mine = few_r.select(*scope, ref_id, F.lower(strip(F.col("__r"))).alias("__a"), relation_name(F.col("__r")).alias("__x"), F.upper(strip(F.col("__r"))).alias("__i"))
    theirs = few_e.select(*scope, ident, F.lower(strip(F.col("__n"))).alias("__b"), relation_name(F.col("__n")).alias("__y"), initials(F.col("__n")).alias("__j"))
    x, y = F.col("__x"), F.col("__y")
    tier = F.when(F.col("__a") == F.col("__b"), 1).when((x != "") & (x == y), 2)
    tier = tier.when((F.char_length(x) >= 3) & (F.char_length(y) >= 3) & (x.contains(y) | y.contains(x)), 3).when(shares_words("__x", "__y", 2), 4)
    tier = tier.when((F.col("__i") == F.col("__j")) & (F.char_length("__i") >= 2), 5)
    hits = beside(mine, theirs, scope, F.lit(True), "inner").select(ref_id, ident, tier.alias("tier")).where("tier IS NOT NULL")
    if wide is not None:
        hits = hits.unionByName(_find_by_keys(many_r, many_e, scope, ref_id, ident))
    best = hits.groupBy(ref_id).agg(F.min(F.struct("tier", ident)).alias("b"))
    return best.select(ref_id, F.col(f"b.{ident}").alias(ident), "b.tier")


def _find_by_keys(refs: DataFrame, ents: DataFrame, scope: Sequence[str], ref_id: str, ident: str) -> DataFrame:
    """``find`` by equi-joins alone: on forms, on grams, on words, on initials; the looser tiers see only the references
    that the equal ones leave."""
    ents = ents.distinct()
    forms = lambda c: F.explode(F.array(F.struct(F.lit(1).alias("tier"), F.lower(strip(c)).alias("form")), F.struct(F.lit(2).alias("tier"), relation_name(c).alias("form")))).alias("f")
    mine = refs.select(*scope, ref_id, forms(F.col("__r"))).select(*scope, ref_id, "f.*").where("form <> ''")
    keyed = ents.select(*scope, ident, forms(F.col("__n"))).select(*scope, ident, "f.*").where("form <> ''").groupBy(*scope, "tier", "form").agg(F.min(ident).alias(ident))
    equal = mine.join(unplanned(keyed), [*scope, "tier", "form"]).groupBy(ref_id).agg(F.min(F.struct("tier", ident)).alias("b"))
    equal = equal.select(ref_id, F.col(f"b.{ident}").alias(ident), "b.tier")
    left = refs.join(unplanned(equal.select(ref_id)), ref_id, "left_anti").withColumn("__x", relation_name(F.col("__r")))
    ents = ents.withColumn("__y", relation_name(F.col("__n")))
    short = F.char_length("__x") >= 3
    inside = contains_join(left.where(short), ents.where(F.char_length("__y") >= 3), scope, "__x", "__y").select(ref_id, ident, F.lit(3).alias("tier"))
    shared = words_join(left, ents, scope, "__x", "__y", 2).select(ref_id, ident, F.lit(4).alias("tier"))
    by_initials = left.withColumn("__i", F.upper(strip(F.col("__r")))).where(F.char_length("__i") >= 2).join(unplanned(ents.withColumn("__i", initials(F.col("__n")))), [*scope, "__i"]).select(ref_id, ident, F.lit(5).alias("tier"))
    return equal.unionByName(inside).unionByName(shared).unionByName(by_initials)


def detect(records: DataFrame, targets: DataFrame, *, scope: Sequence[str], ident: str, text: str, attributes: str, target_key: str, target_name: str) -> DataFrame:
    """(ident, target_key): the target that a record without a filled reference names by its own text, then by any
    attribute, then by a shared word of more than three letters; the least key of the best way."""
    t = targets.select(*scope, F.col(target_key).alias("__k"), F.lower(strip(F.col(target_name))).alias("key")).where("key <> ''")
    own = records.select(*scope, ident, F.lit(1).alias("way"), F.lower(strip(F.col(text))).alias("key"))
    attr = records.select(*scope, ident, F.lit(2).alias("way"), F.explode(F.map_values(attributes)).alias("v")).select(*scope, ident, "way", F.lower(strip(F.col("v"))).alias("key"))
    word = lambda c: F.explode(F.array_distinct(F.filter(F.split(F.lower(c), r"(?U)\W+"), lambda w: F.char_length(w) > 3)))
    by_word = records.select(*scope, ident, F.lit(3).alias("way"), word(F.col(text)).alias("word")).join(t.select(*scope, "__k", word(F.col("key")).alias("word")), [*scope, "word"])
    hits = own.unionByName(attr).where("key <> ''").join(t, [*scope, "key"]).select(ident, "way", "__k").unionByName(by_word.select(ident, "way", "__k"))
    return hits.groupBy(ident).agg(F.min(F.struct("way", "__k")).alias("b")).select(ident, F.col("b.__k").alias(target_key))


def dangling(references: DataFrame, targets: DataFrame, scope: Sequence[str], ref: str, key: str) -> DataFrame:
    """References that no target of their scope answers, neither equal nor one containing the other. They meet the targets
    of their scope, in scopes with many of both by equal forms and grams."""
    r = references.where(strip(F.col(ref)) != "").withColumn("__r", F.lower(strip(F.col(ref))))
    t = targets.select(*scope, F.lower(strip(F.col(key))).alias("__t")).where("__t <> ''")
    wide = wide_scopes(r, t, scope)
    (few_r, many_r), (few_t, many_t) = halves(r, wide, scope), halves(t, wide, scope)
    out = beside(few_r, few_t, scope, F.col("__r").contains(F.col("__t")) | F.col("__t").contains(F.col("__r")), "left_anti")
    if wide is not None:
        many_t = many_t.distinct()
        left = many_r.join(unplanned(many_t.withColumnRenamed("__t", "__r")), [*scope, "__r"], "left_anti")
        near = contains_join(left.select(*scope, "__r").distinct(), many_t, scope, "__r", "__t").select(*scope, "__r").distinct()
        out = out.unionByName(left.join(unplanned(near), [*scope, "__r"], "left_anti"))
    return out.drop("__r")


def answered(parents: DataFrame, children: DataFrame, scope: Sequence[str], parent_keys: Sequence[str], ref: str) -> DataFrame:
    """Parents that some child names by one of their keys: a semi-join over the keys."""
    keys = F.explode(F.array_distinct(F.array(*(F.lower(strip(F.col(k))) for k in parent_keys)))).alias("__k")
    named = children.select(*scope, F.lower(strip(F.col(ref))).alias("__k")).where("__k <> ''").distinct()
    hit = parents.select(*scope, *[c for c in parents.columns if c not in scope], keys).join(named, [*scope, "__k"], "left_semi").drop("__k")
    return hit.distinct()


def marked(parents: DataFrame, children: DataFrame, scope: Sequence[str], ident: str, parent_keys: Sequence[str], ref: str) -> DataFrame:
    """All parents with ``named``: whether some child names them by one of their keys."""
    hit = answered(parents.select(*scope, ident, *parent_keys), children, scope, parent_keys, ref).select(ident, F.lit(True).alias("named")).distinct()
    return parents.join(hit, ident, "left").withColumn("named", F.coalesce("named", F.lit(False)))


def constrained(records: DataFrame, allowed: DataFrame, cls: str, identity: str) -> DataFrame:
    """Records whose class and identity are listed in ``allowed`` (columns of the same names), any case; classes that are
    not listed at all aren't constrained. A semi-join; the listed classes are few and broadcast by size."""
    key = lambda df: df.select(F.col(cls).alias("__c"), F.lower(strip(F.col(identity))).alias("__k")).distinct()
    a = key(allowed)
    r = records.withColumns({"__c": F.col(cls), "__k": F.lower(strip(F.col(identity)))})
    free = r.join(a.select("__c").distinct(), "__c", "left_anti")
    return free.select(*records.columns).unionByName(r.join(a, ["__c", "__k"], "left_semi").select(*records.columns))


def missing_targets(references: DataFrame, targets: DataFrame, scope: Sequence[str], ref: str, keys: Sequence[str], order: str) -> DataFrame:
    """(scope, key, name): one row to create per target that is named but absent, written as it is named first."""
    named = references.where(strip(F.col(ref)) != "").groupBy(*scope, F.lower(strip(F.col(ref))).alias("key")).agg(F.min_by(F.col(ref), F.col(order)).alias("name"))
    have = targets.select(*scope, F.explode(F.array(*(F.lower(strip(F.col(k))) for k in keys))).alias("key")).where("key IS NOT NULL").distinct()
    return named.join(have, [*scope, "key"], "left_anti")


def rewrite(references: DataFrame, aliases: DataFrame, scope: Sequence[str], ref: str) -> DataFrame:
    """References with their text replaced by the canonical name where the alias map (scope, alias, canonical) has it."""
    key = F.lower(strip(F.col(ref)))
    a = aliases.select(*scope, F.col("alias").alias("__a"), "canonical")
    r = references.withColumn("__a", key)
    return r.join(a, [*scope, "__a"], "left").withColumn(ref, F.coalesce("canonical", ref)).drop("__a", "canonical")


def overlapping_names(left: DataFrame, right: DataFrame, scope: Sequence[str], ident: str, a: str, b: str, least: int = 2) -> DataFrame:
    """(ident) of the left rows whose name contains, lies in, or shares ``least`` words with a name of the right;
    names meet within their scope, in scopes with many of both by grams and words."""
    x = left.select(*scope, ident, relation_name(F.col(a)).alias("__x")).where("__x <> ''")
    y = right.select(*scope, relation_name(F.col(b)).alias("__y")).where("__y <> ''")
    wide = wide_scopes(x, y, scope)
    (few_x, many_x), (few_y, many_y) = halves(x, wide, scope), halves(y, wide, scope)
    test = F.col("__x").contains(F.col("__y")) | F.col("__y").contains(F.col("__x")) | shares_words("__x", "__y", least)
    hits = beside(few_x, few_y, scope, test, "left_semi").select(ident)
    if wide is not None:
        many_x, many_y = many_x.distinct(), many_y.distinct()
        hits = hits.unionByName(contains_join(many_x, many_y, scope, "__x", "__y").select(ident)).unionByName(words_join(many_x, many_y, scope, "__x", "__y", least).select(ident))
    return hits.distinct()
