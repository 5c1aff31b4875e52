"""Rules over mentions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import validate
from ..session import table
from . import query
from . import sqltext as S
from .cleaning import _QUALITY as QUALITY
from .cleaning import _T as _NAME

_REQUIRED = ("indicator_abbreviation", "direction", "relation_type")
_GAPS = "list_filter([" + ", ".join(f"CASE WHEN coalesce({S.strip(c)}, '') = '' THEN '{c}' END" for c in _REQUIRED) + "], lambda x: x IS NOT NULL)"


@query(f"SELECT DISTINCT result_id, array_to_string({_GAPS}, ', ') AS missing FROM results WHERE len({_GAPS}) > 0")
def missing_required(spark: SparkSession, sf: str) -> DataFrame:
    """Required fields that a result lacks."""
    r = table(spark, sf, "results")
    gaps = validate.missing_required(F.lit("Result"), {c: F.col(c) for c in _REQUIRED}, {"Result": _REQUIRED})
    return r.select("result_id", gaps.alias("g")).where(F.size("g") > 0).select("result_id", F.array_join("g", ", ").alias("missing")).distinct()


@query(f"SELECT DISTINCT result_id FROM results WHERE len({_GAPS}) = 0")
def required_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Results with all required fields."""
    r = table(spark, sf, "results").withColumn("cls", F.lit("Result"))
    return validate.complete(r, "cls", {c: F.col(c) for c in _REQUIRED}, {"Result": _REQUIRED}).select("result_id").distinct()


@query(f"SELECT DISTINCT result_id FROM results WHERE {S.strip('evidence_text')} <> ''")
def stated_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Results with evidence."""
    return table(spark, sf, "results").where(N.nonblank(F.col("evidence_text")).isNotNull()).select("result_id").distinct()


_X, _E, _D = f"lower({S.strip('tissue_site')})", "lower(coalesce(evidence_text, ''))", "lower(coalesce(body_text, ''))"


@query(rf"""SELECT DISTINCT result_id, CASE WHEN t <> '' AND contains(e, t) THEN 1 WHEN t <> '' AND contains(d, t) THEN 2 WHEN b <> '' AND (contains(e, b) OR contains(d, b)) THEN 3
 WHEN len(w) > 0 AND len(list_filter(w, lambda x: contains(e, x))) / len(w) >= 0.5 THEN 4 END AS tier
FROM (SELECT result_id, t, e, d, {S.strip(r"regexp_replace(t, '\s*\([^)]*\)', '', 'g')")} AS b, list_distinct(list_filter(regexp_split_to_array(t, '\W+'), lambda x: length(x) > 3)) AS w
 FROM (SELECT result_id, {_X} AS t, {_E} AS e, {_D} AS d FROM results LEFT JOIN articles USING (document_id) WHERE tissue_site IS NOT NULL))""")
def evidence_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """How far a result's site is borne out by its evidence or its article."""
    r = table(spark, sf, "results").where("tissue_site IS NOT NULL")
    return validate.verify(r, table(spark, sf, "articles"), document="document_id", ident="result_id", text="tissue_site", evidence="evidence_text", body="body_text").distinct()


_PARTS = f"list_filter(string_split(standard_name, ','), lambda p: {S.strip('p')} <> '' AND lower({S.strip('p')}) <> lower({S.strip('standard_name')}))"


@query(f"SELECT alternative_id, len({_PARTS}) AS n_parts FROM alternatives WHERE len({_PARTS}) >= 2")
def composites(spark: SparkSession, sf: str) -> DataFrame:
    """Names with two parts or more."""
    parts = validate.real_parts(F.col("standard_name"), F.split("standard_name", ","))
    return table(spark, sf, "alternatives").select("alternative_id", F.size(parts).cast("long").alias("n_parts")).where("n_parts >= 2")


@query(f"SELECT alternative_id, standard_name FROM (SELECT alternative_id, standard_name, {_NAME} AS t FROM alternatives) WHERE {QUALITY} >= 90")
def strict_names(spark: SparkSession, sf: str) -> DataFrame:
    """Substances whose name is good enough in strict mode."""
    return table(spark, sf, "alternatives").where(validate.good_enough(F.col("standard_name"), True, 90)).select("alternative_id", "standard_name")


_DIRECTIONS = ("increased", "decreased", "no_significant_change")
_LEVELS = ("p_less_0.001", "p_less_0.01", "p_less_0.05", "trend_0.05_0.1", "not_significant")


@query("SELECT DISTINCT result_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN {S.strip(c)} <> '' AND {S.strip(c)} NOT IN ({', '.join(repr(v) for v in vs)}) THEN '{c}' END" for c, vs in (("direction", _DIRECTIONS), ("significance_level", _LEVELS))) + rf", CASE WHEN {S.strip('effect_size')} <> '' AND NOT regexp_matches({S.strip('effect_size')}, '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$') THEN 'effect_size' END], lambda x: x IS NOT NULL), ', ') AS warnings FROM results")
def domain_warnings(spark: SparkSession, sf: str) -> DataFrame:
    """Fields of a result outside their list, or no number."""
    cols = {c: F.col(c) for c in ("direction", "significance_level", "effect_size")}
    w = validate.domain_warnings(cols, {"direction": _DIRECTIONS, "significance_level": _LEVELS}, ["effect_size"])
    return table(spark, sf, "results").select("result_id", F.array_join(w, ", ").alias("warnings")).distinct()


@query(f"""WITH m AS (SELECT document_id, 'Alternative' AS cls, alternative_id AS id, standard_name AS name, 2 AS p FROM alternatives UNION ALL SELECT document_id, 'Intervention', intervention_id, intervention_target, 3 FROM (SELECT DISTINCT document_id, intervention_id, intervention_target FROM interventions)),
k AS (SELECT *, {S.coref_name('name')} AS k FROM m), b AS (SELECT document_id, k, arg_min(cls, (-p, id)) AS best FROM k WHERE k <> '' GROUP BY ALL)
SELECT cls, id FROM k LEFT JOIN b USING (document_id, k) WHERE best IS NULL OR best = cls""")
def exclusive_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Mentions without those that another class claims with a higher priority."""
    a = table(spark, sf, "alternatives").select("document_id", F.lit("Alternative").alias("cls"), F.col("alternative_id").alias("id"), F.col("standard_name").alias("name"))
    i = table(spark, sf, "interventions").select("document_id", F.lit("Intervention").alias("cls"), F.col("intervention_id").alias("id"), F.col("intervention_target").alias("name")).distinct()
    return validate.exclusive(a.unionByName(i), ["document_id"], cls="cls", name="name", order="id", priority={"Alternative": 2, "Intervention": 3}).select("cls", "id")
