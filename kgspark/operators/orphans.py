"""References to records that do not exist: direct orphans, and what they orphan in turn."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .skew import HOT_ROWS, hot_keys, lookup_join


@dataclass(frozen=True)
class Source:
    """A table in the foreign-key graph: its rows, id, and the columns for scope, arrival and deletion."""

    rows: DataFrame
    id: str
    scope: str = "document_id"
    loaded: str = "loaded_at"
    deleted: str | None = None


@dataclass(frozen=True)
class Reference:
    """``table.field`` names a record of ``parent`` in the same scope by the text of ``key``."""

    table: str
    field: str
    parent: str
    key: str


def reference_key(text: Column) -> Column:
    """Lower case, every run of hyphens, underscores and blanks one blank, none at the ends; blank texts become null."""
    return F.nullif(F.trim(F.lower(F.regexp_replace(text, r"(?U)[\s_-]+", " "))), F.lit(""))


def _children(sources: Mapping[str, Source], references: Sequence[Reference]) -> DataFrame:
    """One row per reference that is made; a table with several is read once."""
    parts = []
    for name in dict.fromkeys(r.table for r in references):
        s = sources[name]
        made = [r for r in references if r.table == name]
        each = F.explode(F.array(*(F.struct(F.lit(r.field).alias("field"), F.lit(f"{r.parent}.{r.key}").alias("target"), reference_key(F.col(r.field)).alias("key")) for r in made)))
        long = s.rows.select(F.lit(name).alias("table"), F.col(s.id).cast("long").alias("id"), F.col(s.scope).cast("string").alias("scope"), F.col(s.loaded).alias("loaded"), each.alias("r"))
        parts.append(long.select("table", "id", "scope", "loaded", "r.field", "r.target", "r.key").where("key IS NOT NULL AND id IS NOT NULL"))
    return reduce(DataFrame.unionByName, parts)


def _parents(sources: Mapping[str, Source], references: Sequence[Reference]) -> DataFrame:
    """One row per parent row and key by which it can be named."""
    parts = []
    for name, key in dict.fromkeys((r.parent, r.key) for r in references):
        s = sources[name]
        gone = F.col(s.deleted).isNotNull() if s.deleted else F.lit(False)
        rows = s.rows.select(F.lit(name).alias("parent"), F.col(s.id).cast("long").alias("parent_id"), F.col(s.scope).cast("string").alias("scope"), F.lit(f"{name}.{key}").alias("target"), reference_key(F.col(key)).alias("key"), F.col(s.loaded).alias("arrived"), gone.alias("gone"))
        parts.append(rows.where("key IS NOT NULL AND scope IS NOT NULL"))
    return reduce(DataFrame.unionByName, parts)


_ON = ["target", "scope", "key"]


def _hot(children: DataFrame, hot_rows: int) -> DataFrame | None:
    """Keys named by very many rows; a key can only be hot in a hot scope, so few rows are counted by key, mostly none."""
    scopes = hot_keys(children, ["scope"], hot_rows)
    return None if scopes is None else hot_keys(children.join(F.broadcast(scopes), "scope", "left_semi"), _ON, hot_rows)


def find_orphans(sources: Mapping[str, Source], references: Sequence[Reference], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(ref_table, ref_field, record_id, ref_month, reason, kind, depth): one row per orphan reference.

    Direct orphans (depth 0) have reason 'missing' if no row of the parent table agrees in scope and key, 'deleted' if
    all that agree are deleted, 'late' if all of those not deleted arrived after the referring row. Parents are first
    reduced to one row per key, so the join is a lookup and never multiplies rows.

    Fixpoint cascade: a reference whose agreeing, not deleted parents are all orphans themselves is an inherited
    orphan (reason 'inherited'). Rounds of semi-joins go down the foreign-key graph, each from the orphans that the
    round before found to the keys they can be named by and on to the references that name these, until a round finds
    none; a reference reported once is not reported again, so cycles end. If no parent table makes references, the
    first round is the last.

    ref_month is the month, in UTC, of the referring row's arrival, null if that is null. Null and blank references,
    and rows without an id, refer to nothing; a null scope agrees with nothing. Redelivered rows count once, by their
    earliest arrival. A missing arrival is not later than anything. Equal parents are one target; empty tables on
    either side are allowed; columns not named, whatever they are called, are ignored.
    """
    children, parents = _children(sources, references), _parents(sources, references)
    early = F.lit("0001-01-01 00:00:00").cast("timestamp")
    targets = parents.groupBy(*_ON).agg(F.min(F.when(~F.col("gone"), F.coalesce("arrived", early))).alias("first"), F.lit(True).alias("known"))
    reason = F.when(F.col("known").isNull(), "missing").when(F.col("first").isNull(), "deleted").when(F.col("first") > F.col("loaded"), "late")
    hot = _hot(children, hot_rows)
    judged = lookup_join(children, targets, _ON, "left", hot=hot).withColumn("reason", reason)
    found = [checkpointed(_once(judged.where("reason IS NOT NULL")).withColumns({"kind": F.lit("direct"), "depth": F.lit(0)}))]
    while True:
        fresh = found[-1]
        hit = {r["table"] for r in fresh.select("table").distinct().collect()}
        below = [r for r in references if r.parent in hit]
        if not below:
            break
        orphaned = lambda fs: reduce(DataFrame.unionByName, (f.select(F.col("table").alias("parent"), F.col("id").alias("parent_id")) for f in fs))
        live = _parents(sources, below).where(~F.col("gone")).select("parent", "parent_id", *_ON)
        touched = live.join(orphaned([fresh]).distinct(), ["parent", "parent_id"], "left_semi").select(*_ON).distinct()
        state = live.join(touched, _ON, "left_semi").join(orphaned(found).distinct().withColumn("bad", F.lit(True)), ["parent", "parent_id"], "left")
        lost = state.groupBy(*_ON).agg(F.min(F.coalesce("bad", F.lit(False))).alias("lost")).where("lost")
        down = lookup_join(_children(sources, below), lost, _ON, "inner", hot=hot).withColumn("reason", F.lit("inherited"))
        known = reduce(DataFrame.unionByName, (f.select("table", "field", "id") for f in found))
        fresh = checkpointed(_once(down).join(known, ["table", "field", "id"], "left_anti").withColumns({"kind": F.lit("inherited"), "depth": F.lit(len(found))}))
        if fresh.isEmpty():
            break
        found.append(fresh)
    return _report(reduce(DataFrame.unionByName, found))


def _once(orphans: DataFrame) -> DataFrame:
    best = F.min(F.struct("loaded", "reason")).alias("s")
    return orphans.groupBy("table", "field", "id").agg(best).select("table", "field", "id", "s.loaded", "s.reason")


def _report(orphans: DataFrame) -> DataFrame:
    return orphans.select(F.col("table").alias("ref_table"), F.col("field").alias("ref_field"), F.col("id").alias("record_id"), F.date_format("loaded", "yyyy-MM").alias("ref_month"), "reason", "kind", "depth")


def orphan_summary(orphans: DataFrame) -> DataFrame:
    """Counts per table, field, month, reason and kind."""
    return orphans.groupBy("ref_table", "ref_field", "ref_month", "reason", "kind").agg(F.count(F.lit(1)).alias("n_orphans"))
