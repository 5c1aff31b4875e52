"""The property graph and its delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import values as V
from ..operators import gate, graph, text, vocabulary
from ..session import table
from ..sources import sinks
from . import query
from . import sqltext as S


def _substance_mentions(spark: SparkSession, sf: str) -> DataFrame:
    attrs = F.map_filter(F.create_map(F.lit("abbreviation"), "abbreviation", F.lit("cas_number"), "cas_number"), lambda k, v: v.isNotNull())
    return table(spark, sf, "alternatives").select("document_id", F.lit("Alternative").alias("cls"), "standard_name", attrs.alias("attributes"), "alternative_id")


def _substance_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return graph.nodes(_substance_mentions(spark, sf), document="document_id", cls="cls", name="standard_name", attributes="attributes", order="alternative_id", global_types=["Alternative"])


_AID = S.global_id("alte", "Alternative", "standard_name")
_NODES = f"""nodes AS (SELECT {_AID} AS id, 'Alternative' AS label, arg_min(standard_name, alternative_id) AS name, arg_min(abbreviation, alternative_id) FILTER ({S.strip('abbreviation')} <> '') AS abbreviation,
 arg_min(cas_number, alternative_id) FILTER ({S.strip('cas_number')} <> '') AS cas_number, array_to_string(list_sort(list(DISTINCT document_id)), '|') AS source_pmids FROM alternatives WHERE {S.strip('standard_name')} <> '' GROUP BY 1)"""


@query(f"WITH {_NODES} SELECT * FROM nodes")
def graph_nodes_built(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of substances: first stated properties, all documents."""
    p = F.col("properties")
    return _substance_nodes(spark, sf).select("id", "label", "name", p["abbreviation"].alias("abbreviation"), p["cas_number"].alias("cas_number"), F.array_join("source_pmids", "|").alias("source_pmids"))


_REFS = f"""refs AS (SELECT DISTINCT {S.global_id('resu', 'Result', "indicator_abbreviation || ' ' || result_id", 'document_id')} AS source_id, {S.global_id('indi', 'Indicator', 'indicator_abbreviation')} AS target_id, 'corresponds_to' AS type, evidence_text, document_id, result_id
 FROM results WHERE {S.strip('indicator_abbreviation')} <> '')"""


def _references(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "results").where(N.nonblank(F.col("indicator_abbreviation")).isNotNull())
    none = F.lit(None).cast("string")
    return r.select(
        N.global_id(F.lit("Result"), F.concat_ws(" ", "indicator_abbreviation", F.col("result_id").cast("string")), F.col("document_id"), []).alias("source_id"),
        N.global_id(F.lit("Indicator"), F.col("indicator_abbreviation"), none, ["Indicator"]).alias("target_id"), F.lit("corresponds_to").alias("type"), "evidence_text", "document_id", "result_id",
    )


@query(f"WITH {_REFS} SELECT source_id, target_id, type, arg_min(evidence_text, result_id) FILTER (evidence_text IS NOT NULL) AS evidence, array_to_string(list_sort(list(DISTINCT document_id)), '|') AS source_pmids FROM refs GROUP BY ALL")
def graph_edges_built(spark: SparkSession, sf: str) -> DataFrame:
    """Edges from results to their indicators."""
    e = graph.edges(_references(spark, sf), source="source_id", target="target_id", kind="type", document="document_id", evidence="evidence_text", order="result_id")
    return e.withColumn("source_pmids", F.array_join("source_pmids", "|"))


@query(f"""WITH {_REFS} SELECT count(*) AS n_dangling FROM (SELECT DISTINCT target_id FROM refs) WHERE target_id NOT IN (SELECT {S.global_id('indi', 'Indicator', 'abbreviation')} FROM indicators WHERE {S.strip('abbreviation')} <> '')""")
def dangling_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Targets of edges that are no node."""
    none = F.lit(None).cast("string")
    ids = table(spark, sf, "indicators").where(N.nonblank(F.col("abbreviation")).isNotNull()).select(N.global_id(F.lit("Indicator"), F.col("abbreviation"), none, ["Indicator"]).alias("id")).distinct()
    e = _references(spark, sf).select(F.col("target_id").alias("source_id"), "target_id", "type").distinct()
    return graph.dangling_edges(e, ids).agg(F.count(F.lit(1)).alias("n_dangling"))


@query(f"SELECT {S.global_id('alcl', 'Alternative_Class', 'alternative_class')} AS id, 'Alternative_Class' AS label, alternative_class AS name, min(subclass) AS subclass FROM vocabulary WHERE {S.strip('alternative_class')} <> '' GROUP BY ALL")
def class_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """A node per class of the vocabulary."""
    return graph.class_nodes(table(spark, sf, "vocabulary"), "alternative_class", "subclass")


@query(f"""WITH {S.ENTRY} SELECT DISTINCT {_AID} AS source_id, {S.global_id('alcl', 'Alternative_Class', 'entry_class')} AS target_id, 'belongs_to' AS type FROM alternatives JOIN entries ON lower({S.strip('standard_name')}) = key""")
def belongs_to(spark: SparkSession, sf: str) -> DataFrame:
    """Edges from substances to their classes."""
    from .lookups import _vocabulary

    n = table(spark, sf, "alternatives").select("standard_name", F.lower(N.strip(F.col("standard_name"))).alias("key")).join(vocabulary.small(_vocabulary(spark, sf)), "key")
    return graph.belongs_to(n.withColumn("id", N.global_id(F.lit("Alternative"), F.col("standard_name"), F.lit(None).cast("string"), ["Alternative"])), ident="id", cls="entry_class")


_STEPS = f"""n AS (SELECT id, label AS l, {S.graph_name('name')} AS n, {S.graph_name('abbreviation')} AS a FROM nodes),
k AS (SELECT l, n, arg_min(id, (way, id)) AS into_id FROM (SELECT l, a AS n, 0 AS way, id FROM n UNION ALL SELECT l, n, 1, id FROM n) WHERE n <> '' GROUP BY ALL),
step AS (SELECT n.id, k.into_id FROM n JOIN k USING (l, n) WHERE n.n <> '' AND n.id <> k.into_id),
walk AS (SELECT id, into_id AS cur, [id, into_id] AS path FROM step UNION ALL SELECT w.id, s.into_id, list_append(w.path, s.into_id) FROM walk w JOIN step s ON s.id = w.cur WHERE NOT list_contains(w.path, s.into_id)),
ends AS (SELECT id, arg_max(cur, len(path)) AS cur, arg_max(path, len(path)) AS path FROM walk GROUP BY 1),
merged AS (SELECT id, into_id FROM (SELECT e.id, CASE WHEN s.into_id IS NULL THEN cur ELSE list_min(path[list_position(path, s.into_id):]) END AS into_id FROM ends e LEFT JOIN step s ON s.id = e.cur) WHERE id <> into_id)"""


@query(f"WITH RECURSIVE {_NODES}, {_STEPS} SELECT id, into_id AS \"into\" FROM merged")
def merged_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes whose name is another node's abbreviation or full name, and where they go."""
    p = F.col("properties")
    n = _substance_nodes(spark, sf).select("id", "label", "name", p["abbreviation"].alias("abbreviation"), F.col("name").alias("full"))
    return graph.merge_map(n, ident="id", label="label", name="name", abbreviation="abbreviation", full="full")


@query(f"""WITH RECURSIVE {_NODES}, {_STEPS}, r AS (SELECT n.*, coalesce(m.into_id, n.id) AS root FROM nodes n LEFT JOIN merged m USING (id)),
d AS (SELECT root, array_to_string(list_sort(list(DISTINCT x)), '|') AS source_pmids FROM (SELECT root, unnest(string_split(source_pmids, '|')) AS x FROM r) WHERE x <> '' GROUP BY 1)
SELECT root AS id, arg_min(name, (id <> root, id)) AS name, arg_min(abbreviation, (id <> root, id)) FILTER ({S.strip('abbreviation')} <> '') AS abbreviation, arg_min(cas_number, (id <> root, id)) FILTER ({S.strip('cas_number')} <> '') AS cas_number, any_value(d.source_pmids) AS source_pmids FROM r LEFT JOIN d USING (root) GROUP BY root""")
def nodes_after_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The nodes that stay, their gaps filled from the nodes merged into them."""
    p = F.col("properties")
    n = graph.merge_nodes(_substance_nodes(spark, sf), merged_nodes(spark, sf))
    return n.select("id", "name", p["abbreviation"].alias("abbreviation"), p["cas_number"].alias("cas_number"), F.array_join("source_pmids", "|").alias("source_pmids"))


@query("""WITH m AS (SELECT * FROM (SELECT id, min(id) OVER (PARTITION BY substr(id, 1, 7)) AS into_id FROM (SELECT DISTINCT id FROM graph_nodes)) WHERE id <> into_id),
e AS (SELECT DISTINCT id AS s, substr(id, 1, 4) || '_hub' AS t FROM graph_nodes UNION SELECT DISTINCT id, first_id FROM (SELECT id, min(id) OVER (PARTITION BY source) AS first_id FROM graph_nodes))
SELECT DISTINCT coalesce(a.into_id, s) AS source_id, coalesce(b.into_id, t) AS target_id, 'linked' AS type FROM e LEFT JOIN m a ON a.id = s LEFT JOIN m b ON b.id = t WHERE coalesce(a.into_id, s) <> coalesce(b.into_id, t)""")
def edge_remap(spark: SparkSession, sf: str) -> DataFrame:
    """Edges after nodes were merged: ends replaced, self-loops and repeats gone."""
    n = table(spark, sf, "graph_nodes").select("id", "source")
    ids = n.select("id").where("id IS NOT NULL").distinct().withColumn("g", F.substring("id", 1, 7))
    m = ids.join(ids.groupBy("g").agg(F.min("id").alias("into")), "g").where("id <> into").select("id", "into")
    hub = n.select("id", F.concat(F.substring("id", 1, 4), F.lit("_hub")).alias("t"))
    named = n.withColumn("source", F.coalesce("source", F.lit("")))
    by_source = named.join(named.groupBy("source").agg(F.min("id").alias("t")), "source").select("id", "t")
    e = hub.unionByName(by_source).distinct().select(F.col("id").alias("source_id"), F.col("t").alias("target_id"), F.lit("linked").alias("type"))
    return graph.remap(e, m)


@query("SELECT CASE WHEN grouping(cls) = 1 THEN 'total' ELSE cls END AS cls, count(*) AS n FROM (SELECT 'Alternative' AS cls FROM alternatives UNION ALL SELECT 'Indicator' FROM indicators UNION ALL SELECT 'Tissue_Site' FROM tissue_sites UNION ALL SELECT 'Intervention' FROM interventions UNION ALL SELECT 'Result' FROM results) GROUP BY ROLLUP (cls)")
def type_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Mentions per class and in all: a union of the phases' tables."""
    parts = [table(spark, sf, t).select(F.lit(c).alias("cls")) for c, t in (("Alternative", "alternatives"), ("Indicator", "indicators"), ("Tissue_Site", "tissue_sites"), ("Intervention", "interventions"), ("Result", "results"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.rollup("cls").agg(F.count(F.lit(1)).alias("n")).select(F.coalesce("cls", F.lit("total")).alias("cls"), "n")


_GOOD = f"good AS (SELECT DISTINCT document_id FROM alternatives WHERE {S.strip('abbreviation')} <> '')"


def _gated(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    a = table(spark, sf, "alternatives")
    return gate.split(table(spark, sf, "articles"), a, "document_id", gate.condition("abbreviation exists", lambda f: F.col(f)))


@query(f"WITH {_GOOD} SELECT document_id, document_id IN (FROM good) AS passed FROM articles")
def gate_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with an entity that meets the gate's condition, and the others."""
    passed, failed = _gated(spark, sf)
    return passed.select("document_id", F.lit(True).alias("passed")).unionByName(failed.select("document_id", F.lit(False).alias("passed")))


@query(f"""WITH {_GOOD}, f AS (SELECT DISTINCT document_id, result_id, indicator_abbreviation, direction FROM results QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY result_id) = 1)
SELECT document_id, indicator_abbreviation, direction FROM articles LEFT JOIN f USING (document_id) WHERE document_id IN (FROM good)""")
def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """One row per document that passed, with fields of its first result."""
    passed, _ = _gated(spark, sf)
    return sinks.manifest(passed.select("document_id"), table(spark, sf, "results"), "document_id", "result_id", ["indicator_abbreviation", "direction"])


@query(f"""WITH {_GOOD}, p AS (SELECT document_id FROM articles WHERE document_id IN (FROM good))
SELECT 'passed' AS item, count(*) AS n FROM p UNION ALL SELECT 'failed', (SELECT count(*) FROM articles) - count(*) FROM p UNION ALL SELECT 'total', count(*) FROM articles UNION ALL SELECT 'class:Indicator', count(*) FROM indicators WHERE document_id IN (FROM p)""")
def delivery_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Documents passed and failed, and mentions of those passed."""
    passed, failed = _gated(spark, sf)
    return sinks.summary(passed, failed, table(spark, sf, "indicators").withColumn("cls", F.lit("Indicator")), "document_id", "cls")


@query(r"SELECT alternative_id, document_id, regexp_replace(abbreviation, '\s+', ' ', 'g') AS abbreviation, regexp_replace(cas_number, '\s+', ' ', 'g') AS cas_number, CASE WHEN source_organism IS NOT NULL THEN true ELSE false END AS has_other FROM alternatives")
def review_table(spark: SparkSession, sf: str) -> DataFrame:
    """The review table: fixed columns, the schema's attributes, others as JSON."""
    attrs = F.map_filter(F.create_map(*(x for c in ("abbreviation", "cas_number", "source_organism") for x in (F.lit(c), F.col(c)))), lambda k, v: v.isNotNull())
    r = sinks.review_table(table(spark, sf, "alternatives").withColumn("attributes", attrs), ["alternative_id", "document_id"], "attributes", ["abbreviation", "cas_number"])
    return r.select("alternative_id", "document_id", "abbreviation", "cas_number", F.col("other_attributes").isNotNull().alias("has_other"))


@query(f"""SELECT DISTINCT i.document_id, 'Intervention' AS source_type, i.intervention_target AS target_text, 'uses' AS relation, 'Alternative' AS target_type, substr(i.evidence_text, 1, 500) AS evidence, a.k IS NOT NULL AS target_found
FROM interventions i LEFT JOIN (SELECT DISTINCT document_id, lower({S.strip('standard_name')}) AS k FROM alternatives WHERE {S.strip('standard_name')} <> '') a ON a.document_id = i.document_id AND a.k = lower({S.strip('i.intervention_target')}) WHERE {S.strip('i.intervention_target')} <> ''""")
def relationship_table(spark: SparkSession, sf: str) -> DataFrame:
    """References as rows, with evidence cut to 500 characters and whether the target was found."""
    key = lambda c: F.lower(N.strip(F.col(c)))
    i = table(spark, sf, "interventions").withColumn("k", key("intervention_target")).where("k <> ''")
    a = table(spark, sf, "alternatives").select("document_id", key("standard_name").alias("k"), F.lit(True).alias("hit")).where("k <> ''").distinct()
    out = i.join(a, ["document_id", "k"], "left")
    return out.select("document_id", F.lit("Intervention").alias("source_type"), F.col("intervention_target").alias("target_text"), F.lit("uses").alias("relation"), F.lit("Alternative").alias("target_type"), F.substring("evidence_text", 1, 500).alias("evidence"), F.coalesce("hit", F.lit(False)).alias("target_found")).distinct()


def _case(col: str, m: dict[str, str]) -> str:
    return f"CASE lower({S.strip(col)}) " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in m.items()) + f" ELSE {col} END"


_AUDIT = f"""audit AS (SELECT 'normalize' AS phase, CASE WHEN {_case('direction', V.DIRECTIONS)} <> direction THEN 'changed' WHEN direction IS NULL THEN 'warning' ELSE 'same' END AS kind FROM results
 UNION ALL SELECT 'filter', CASE WHEN coalesce({S.strip('evidence_text')}, '') = '' THEN 'dropped' ELSE 'same' END FROM results)"""


@query(f"WITH {_AUDIT} SELECT phase, count_if(kind = 'changed')::BIGINT AS n_changed, count_if(kind = 'warning')::BIGINT AS n_warning, count_if(kind = 'dropped')::BIGINT AS n_dropped, count_if(kind = 'merged')::BIGINT AS n_merged FROM audit GROUP BY ROLLUP (phase)")
def cleaning_report(spark: SparkSession, sf: str) -> DataFrame:
    """Changes, warnings and drops per phase and in all."""
    r = table(spark, sf, "results")
    d = F.col("direction")
    a = r.select(F.lit("normalize").alias("phase"), F.when(V.mapped(d, V.DIRECTIONS) != d, "changed").when(d.isNull(), "warning").otherwise("same").alias("kind"))
    b = r.select(F.lit("filter").alias("phase"), F.when(N.nonblank(F.col("evidence_text")).isNull(), "dropped").otherwise("same").alias("kind"))
    return sinks.report(a.unionByName(b), "phase", "kind")


@query("SELECT document_id, result_id, direction FROM (SELECT DISTINCT document_id, result_id, direction FROM results) QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY result_id) <= 3")
def first_results(spark: SparkSession, sf: str) -> DataFrame:
    """The first three results of each document: a report's truncation."""
    return text.top_rows(table(spark, sf, "results").select("document_id", "result_id", "direction").distinct(), ["document_id"], [F.col("result_id")], 3)
