"""Rules over mentions: required fields, evidence, domains, exclusivity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import coref_name, name_quality, nonblank, strip
from ..functions.values import number


def missing_required(cls: Column, value: Mapping[str, Column], required: Mapping[str, Sequence[str]]) -> Column:
    """The required fields of the row's class that are null or blank, in order."""
    gaps = [F.when((cls == c) & nonblank(value[f]).isNull(), F.lit(f)) for c, fs in required.items() for f in fs]
    return F.filter(F.array(*gaps), lambda x: x.isNotNull()) if gaps else F.array().cast("array<string>")


def complete(rows: DataFrame, cls: str, value: Mapping[str, Column], required: Mapping[str, Sequence[str]], preserved: Column | None = None) -> DataFrame:
    """Rows with all required fields stated; preserved rows stay whatever they lack."""
    keep = F.size(missing_required(F.col(cls), value, required)) == 0
    return rows.where(keep | F.coalesce(preserved, F.lit(False)) if preserved is not None else keep)


def evidence_tier(text: Column, evidence: Column, document: Column, least: float = 0.5) -> Column:
    """How far a mention is borne out: 1 stated in its evidence, 2 in the document, 3 without its brackets, 4 by at
    least ``least`` of its words of more than three letters, null not at all."""
    t, e, d = F.lower(strip(text)), F.lower(F.coalesce(evidence, F.lit(""))), F.lower(F.coalesce(document, F.lit("")))
    bare = strip(F.regexp_replace(t, r"(?U)\s*\([^)]*\)", ""))
    words = F.array_distinct(F.filter(F.split(t, r"(?U)\W+"), lambda w: F.char_length(w) > 3))
    found = F.size(F.filter(words, lambda w: e.contains(w)))
    return F.when((t != "") & e.contains(t), 1).when((t != "") & d.contains(t), 2).when((bare != "") & (e.contains(bare) | d.contains(bare)), 3).when((F.size(words) > 0) & (found / F.size(words) >= least), 4)


def verify(rows: DataFrame, documents: DataFrame, *, document: str, ident: str, text: str, evidence: str, body: str) -> DataFrame:
    """(ident, tier): ``evidence_tier`` for every row against its document.

    What the evidence decides needs no document; the rest asks once per document and distinct mention, so a body is
    folded once and joined to few mentions, not to every row.
    """
    mine = rows.select(ident, document, F.col(text).alias("__t"), F.col(evidence).alias("__e"))
    here = mine.withColumn("__tier", evidence_tier(F.col("__t"), F.col("__e"), F.lit(None).cast("string")))
    asked = here.where(F.coalesce("__tier", F.lit(9)) > 1).select(document, "__t").where("__t IS NOT NULL").distinct()
    bodies = documents.select(document, F.lower(body).alias("__b"))
    t = F.lower(strip(F.col("__t")))
    bare = strip(F.regexp_replace(t, r"(?U)\s*\([^)]*\)", ""))
    there = asked.join(bodies, document).select(document, "__t", F.when((t != "") & F.col("__b").contains(t), 2).when((bare != "") & F.col("__b").contains(bare), 3).alias("__there"))
    out = here.join(there.where("__there IS NOT NULL"), [document, "__t"], "left")
    return out.select(ident, F.when(F.col("__tier") == 1, 1).otherwise(F.least("__tier", "__there")).alias("tier"))


def real_parts(whole: Column, parts: Column) -> Column:
    """The components that aren't blank and aren't the product itself."""
    return F.filter(parts, lambda p: (strip(p) != "") & (F.lower(strip(p)) != F.lower(strip(whole))))


def good_enough(name: Column, strict: bool, least: int = 40) -> Column:
    return name_quality(name) >= least if strict else F.lit(True)


def domain_warnings(value: Mapping[str, Column], domains: Mapping[str, Sequence[str]], numeric: Sequence[str] = ()) -> Column:
    """Names of the stated fields whose value isn't in its list, or isn't a number."""
    out = [F.when(nonblank(value[f]).isNotNull() & ~strip(value[f]).isin(*allowed), F.lit(f)) for f, allowed in domains.items()]
    out += [F.when(nonblank(value[f]).isNotNull() & number(value[f]).isNull(), F.lit(f)) for f in numeric]
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def exclusive(mentions: DataFrame, scope: Sequence[str], *, cls: str, name: str, order: str, priority: Mapping[str, int]) -> DataFrame:
    """Mentions without those whose identity another class claims with a higher priority; of equals the first stays.

    Each (scope, identity) is reduced to its best claim by one aggregate, joined back by its key.
    """
    rank = F.create_map(*(F.lit(x) for kv in priority.items() for x in kv))[F.col(cls)]
    m = mentions.withColumn("__k", coref_name(F.col(name)))
    claims = m.where(rank.isNotNull() & (F.col("__k") != "")).groupBy(*scope, "__k").agg(F.min_by(F.col(cls), F.struct(-rank, F.col(order))).alias("__best"), F.min(cls).alias("__a"), F.max(cls).alias("__b")).where("__a <> __b")
    lost = F.col("__best").isNotNull() & rank.isNotNull() & (F.col(cls) != F.col("__best"))
    return m.join(claims.select(*scope, "__k", "__best"), [*scope, "__k"], "left").where(~lost).drop("__k", "__best")
