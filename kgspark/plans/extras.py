"""Queries of readers, merges and exports that the other modules leave out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import align, dedup, graph, lookup, text
from ..operators.similarity import unplanned
from ..session import table
from ..sources import articles as src
from . import SQL, graphs, lookups, query
from . import sqltext as S

# what XML may not hold, and the line ends that its readers make one of
_PLAIN = r"[^\x20-\x7e]"
_FIELDS = ("pmid", "pmcid", "doi", "title", "journal")


def _xml(c: Column) -> Column:
    t = F.regexp_replace(F.coalesce(c, F.lit("")), _PLAIN, "")
    return F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _sql_plain(x: str) -> str:
    return rf"trim(regexp_replace(coalesce({x}, ''), '[^\x20-\x7e]', '', 'g'))"


_KEYS = """CASE WHEN contains(t, 'introduction') OR contains(t, 'background') THEN 'introduction' WHEN contains(t, 'method') OR contains(t, 'materials') THEN 'methods' WHEN contains(t, 'result') THEN 'results'
 WHEN contains(t, 'discussion') OR contains(t, 'conclusion') THEN 'discussion' WHEN t <> '' THEN left(replace(t, ' ', '_'), 30) ELSE 'other' END"""


@query(f"""WITH a AS (SELECT row_number() OVER (ORDER BY document_id) AS n, document_id AS d, {', '.join(f"{_sql_plain(c)} AS {c}" for c in _FIELDS)}, sections FROM articles),
s AS (SELECT d, pos, lower({_sql_plain('k')}) AS t, trim(regexp_replace(coalesce(k, ''), '[^\x20-\x7e]', '', 'g') || regexp_replace(coalesce(x, ''), '[^\x20-\x7e]', '', 'g')) AS x FROM (SELECT d, pos, sections[pos].section_key AS k, sections[pos].section_text AS x FROM (SELECT d, sections, unnest(range(1, len(sections) + 1)) AS pos FROM a))),
k AS (SELECT d, key, min(pos) AS p, string_agg(x, chr(10) || chr(10) ORDER BY pos) AS x FROM (SELECT d, pos, {_KEYS} AS key, x FROM s) GROUP BY ALL),
l AS (SELECT d, string_agg(key || '=' || x, chr(10) ORDER BY p) AS sections FROM k GROUP BY 1)
SELECT d AS file_id, coalesce(nullif(pmid, ''), nullif(pmcid, ''), d) AS document_id, {', '.join(f"nullif({c}, '') AS {c}" for c in _FIELDS[:3])}, title, journal, '2021' AS publication_year, '2021-03-09' AS publication_date, coalesce(l.sections, '') AS sections FROM a LEFT JOIN l USING (d)""")
def parsed_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Articles written as XML, with three dates of different rank, and parsed again."""
    tag = lambda kind, c: F.concat(F.lit(f'<article-id pub-id-type="{kind}">'), _xml(F.col(c)), F.lit("</article-id>"))
    date = lambda kind, y, m, d: f'<pub-date pub-type="{kind}"><day>{d}</day><month>{m}</month><year>{y}</year></pub-date>'
    dates = date("collection", 2019, 1, 1) + date("epub", 2021, 3, 9) + date("pmc-release", 2020, 5, 5)
    front = F.concat(tag("pmid", "pmid"), tag("pmc", "pmcid"), tag("doi", "doi"), F.lit("<article-title>"), _xml(F.col("title")), F.lit("</article-title><journal-title>"), _xml(F.col("journal")), F.lit("</journal-title>" + dates))
    sec = lambda s: F.concat(F.lit("<sec><title>"), _xml(s["section_key"]), F.lit("</title><p>"), _xml(s["section_text"]), F.lit("</p></sec>"))
    body = F.coalesce(F.array_join(F.transform("sections", sec), ""), F.lit(""))
    a = table(spark, sf, "articles").select(F.concat(F.lit("/in/"), "document_id", F.lit(".xml")).alias("path"), F.concat(F.lit("<article><front>"), front, F.lit("</front><body>"), body, F.lit("</body></article>")).cast("binary").alias("content"))
    p = src.parse_files(a)
    listed = F.array_join(F.transform("sections", lambda s: F.concat(s["section_key"], F.lit("="), s["section_text"])), "\n")
    return p.select(F.regexp_extract("file_path", r"/in/(.*)\.xml$", 1).alias("file_id"), "document_id", *_FIELDS, "publication_year", "publication_date", listed.alias("sections"))


@query(f"""WITH e AS (SELECT id, row_id, i, {S.strip('source_pmids[i]')} AS m FROM (SELECT id, row_id, source_pmids, unnest(range(1, len(source_pmids) + 1)) AS i FROM graph_nodes)),
f AS (SELECT id, m, min((row_id, i)) AS o FROM e WHERE m <> '' GROUP BY ALL), l AS (SELECT id, string_agg(m, '|' ORDER BY o) AS pmids FROM f GROUP BY 1)
SELECT id, n_rows, coalesce(pmids, '') AS pmids, CASE WHEN n_rows > 1 THEN coalesce(merged_from, '') END AS merged_from FROM (SELECT id, count(*) AS n_rows, array_to_string(list_sort(list(DISTINCT source) FILTER (source IS NOT NULL)), '|') AS merged_from FROM graph_nodes WHERE id IS NOT NULL GROUP BY 1) LEFT JOIN l USING (id)""")
def list_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicate nodes merged: lists united in the order of their members, and where the rows came from."""
    pmids = F.transform("source_pmids", lambda p: N.strip(p))
    n = table(spark, sf, "graph_nodes").where("id IS NOT NULL").select("id", "row_id", "source", F.create_map(F.lit("pmids"), F.to_json(pmids)).alias("attributes"))
    n = n.select("id", "row_id", "source", F.col("id").alias("name"), F.map_filter("attributes", lambda k, v: v.isNotNull()).alias("attributes"))
    m = dedup.merge_groups(n, ["id"], order="row_id", text="name", attributes="attributes", lists=["pmids"], source="source")
    several = F.when(F.col("n_rows") > 1, F.coalesce(F.array_join("merged_from", "|"), F.lit("")))
    return m.select("id", "n_rows", F.coalesce(F.array_join(F.from_json(F.col("attributes")["pmids"], "array<string>"), "|"), F.lit("")).alias("pmids"), several.alias("merged_from"))


_NAMED = f"""n AS (SELECT 'Alternative' AS c, {S.graph_name('standard_name')} AS n, 'a' || alternative_id AS id FROM alternatives UNION ALL SELECT 'Tissue_Site', {S.graph_name('site_name')}, 's' || tissue_site_id FROM tissue_sites),
k AS (SELECT c, n, min(id) AS id FROM n WHERE n <> '' GROUP BY ALL)"""


@query(f"""WITH {_NAMED}, r AS (SELECT DISTINCT intervention_id AS i, {S.graph_name('intervention_target')} AS t FROM interventions),
h AS (SELECT i, 1 AS way, id FROM r JOIN k ON c = 'Alternative' AND n = t WHERE t <> '' UNION ALL SELECT i, 2, id FROM r JOIN k ON c = 'Tissue_Site' AND n = t WHERE t <> ''),
l AS (SELECT i, 3 AS way, id FROM r JOIN k ON c = 'Alternative' AND length(n) >= 3 AND (contains(n, t) OR contains(t, n)) WHERE length(t) >= 3 AND i NOT IN (SELECT i FROM h))
SELECT i AS intervention_id, arg_min(id, (way, id)) AS target_id, min(way) AS way FROM (FROM h UNION ALL FROM l) GROUP BY 1""")
def node_references(spark: SparkSession, sf: str) -> DataFrame:
    """Node that an intervention's target names: of its class by name, of a shared class, or by containment."""
    nodes = table(spark, sf, "alternatives").select(F.lit("Alternative").alias("label"), F.col("standard_name").alias("name"), F.concat(F.lit("a"), "alternative_id").alias("id"))
    nodes = nodes.unionByName(table(spark, sf, "tissue_sites").select(F.lit("Tissue_Site").alias("label"), F.col("site_name").alias("name"), F.concat(F.lit("s"), "tissue_site_id").alias("id")))
    r = table(spark, sf, "interventions").select("intervention_id", "intervention_target", F.lit("Alternative").alias("target")).distinct()
    return graph.detect_by_name(r, nodes, ident="intervention_id", text="intervention_target", target="target", global_types=["Tissue_Site"])


@query(r"""WITH e AS (SELECT 'd' || document_id AS id, min(evidence_text) AS x FROM alternatives WHERE evidence_text IS NOT NULL GROUP BY ALL), r AS (SELECT DISTINCT result_id, document_id, evidence_text FROM results)
SELECT 'd' || document_id AS source_id, 'r' || result_id AS target_id, 'reports' AS type, coalesce(CASE WHEN regexp_replace(evidence_text, '\s', '', 'g') <> '' THEN evidence_text END, x) AS evidence FROM r LEFT JOIN e ON e.id = 'd' || document_id""")
def source_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Edges from documents to results; an edge without evidence has that of its source."""
    e = table(spark, sf, "alternatives").where("evidence_text IS NOT NULL").groupBy(F.concat(F.lit("d"), "document_id").alias("id")).agg(F.min("evidence_text").alias("evidence"))
    r = table(spark, sf, "results").select("result_id", "document_id", "evidence_text").distinct()
    edges = r.select(F.concat(F.lit("d"), "document_id").alias("source_id"), F.concat(F.lit("r"), "result_id").alias("target_id"), F.lit("reports").alias("type"), F.col("evidence_text").alias("evidence"))
    return graph.with_source_evidence(edges, e)


@query(f"SELECT {S.global_id('alcl', 'Alternative_Class', 'site_category')} AS id, array_to_string(list_sort(list(DISTINCT document_id)), '|') AS source_pmids FROM tissue_sites WHERE {S.strip('site_category')} <> '' AND document_id IS NOT NULL GROUP BY 1")
def class_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in which each class has members."""
    return graph.class_documents(table(spark, sf, "tissue_sites"), "site_category", "document_id").withColumn("source_pmids", F.array_join("source_pmids", "|"))


@query(f"WITH ft AS ({SQL['find_targets']}) SELECT DISTINCT document_id, 'Intervention' AS source_type, intervention_id AS source_id, 'uses' AS relation, 'Alternative' AS target_type, alternative_id AS target_id, tier, substr(evidence_text, 1, 500) AS evidence FROM ft JOIN interventions USING (intervention_id)")
def relationships(spark: SparkSession, sf: str) -> DataFrame:
    """The relationship table by the cascaded lookup: references whose target is found, with evidence cut to 500 characters."""
    i = table(spark, sf, "interventions").select("intervention_id", "document_id", F.substring("evidence_text", 1, 500).alias("evidence")).distinct()
    out = lookups.find_targets(spark, sf).join(unplanned(i), "intervention_id")
    return out.select("document_id", F.lit("Intervention").alias("source_type"), F.col("intervention_id").alias("source_id"), F.lit("uses").alias("relation"), F.lit("Alternative").alias("target_type"), F.col("alternative_id").alias("target_id"), "tier", "evidence")


@query(f"SELECT document_id FROM articles WHERE document_id NOT IN (SELECT document_id FROM alternatives WHERE {S.strip('abbreviation')} <> '' AND document_id IS NOT NULL) ORDER BY document_id LIMIT 50")
def first_failures(spark: SparkSession, sf: str) -> DataFrame:
    """The first 50 documents that fail the gate, which is all that a summary lists of them."""
    return text.top_rows(graphs._gated(spark, sf)[1].select("document_id").withColumn("one", F.lit(1)), ["one"], [F.col("document_id")], 50).select("document_id")


@query(f"""WITH h AS (SELECT DISTINCT document_id, lower({S.strip('intervention_target')}) AS k FROM interventions WHERE {S.strip('intervention_target')} <> '')
SELECT alternative_id, EXISTS (FROM h WHERE h.document_id = a.document_id AND h.k IN (lower({S.strip('a.standard_name')}), lower({S.strip('a.abbreviation')}))) AS named FROM alternatives a""")
def orphan_warnings(spark: SparkSession, sf: str) -> DataFrame:
    """Every substance, and whether an intervention names it: the variant that warns and keeps all."""
    a = table(spark, sf, "alternatives").select("document_id", "alternative_id", "standard_name", "abbreviation")
    return lookup.marked(a, table(spark, sf, "interventions"), ["document_id"], "alternative_id", ["standard_name", "abbreviation"], "intervention_target").select("alternative_id", "named")


#: Class, table, id, name and attributes of the classes whose nodes are shared by all documents.
_CLASSES = (
    ("Alternative", "alternatives", "alternative_id", "standard_name", ("abbreviation", "cas_number", "source_organism")), ("Indicator", "indicators", "indicator_id", "abbreviation", ("standard_name", "unit", "measurement_method")),
    ("Tissue_Site", "tissue_sites", "tissue_site_id", "site_name", ("site_category",)),
)
_PREFIX = {"Alternative": "alte", "Indicator": "indi", "Tissue_Site": "tiss"}


def _nodes_sql(cls: str, name: str, ident: str, key: str, attributes: tuple[str, ...]) -> str:
    first = lambda a: f"coalesce(arg_min({a}, {ident}) FILTER ({S.strip(a)} <> ''), '')"
    props = " || '|' || ".join(first(a) for a in attributes)
    return f"SELECT {S.global_id(_PREFIX[cls], cls, key)} AS id, '{cls}' AS label, arg_min({key}, {ident}) AS name, {props} AS properties, array_to_string(list_sort(list(DISTINCT document_id)), '|') AS source_pmids FROM {name} WHERE {S.strip(key)} <> '' GROUP BY 1"


@query(" UNION ALL ".join(_nodes_sql(c, t, i, k, a) for c, t, i, k, a in _CLASSES))
def all_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of all shared classes: first stated properties, all documents."""
    parts = []
    for cls, name, ident, key, attributes in _CLASSES:
        attrs = F.map_filter(F.create_map(*(x for a in attributes for x in (F.lit(a), F.col(a)))), lambda k, v: v.isNotNull())
        parts.append(table(spark, sf, name).select("document_id", F.lit(cls).alias("cls"), F.col(key).alias("name"), attrs.alias("attributes"), F.col(ident).alias("ord")))
    mentions = parts[0].unionByName(parts[1]).unionByName(parts[2])
    n = graph.nodes(mentions, document="document_id", cls="cls", name="name", attributes="attributes", order="ord", global_types=[c[0] for c in _CLASSES])
    of = F.coalesce(*(F.when(F.col("label") == cls, F.concat_ws("|", *(F.coalesce(F.col("properties")[a], F.lit("")) for a in attributes))) for cls, _, _, _, attributes in _CLASSES))
    return n.select("id", "label", "name", of.alias("properties"), F.array_join("source_pmids", "|").alias("source_pmids"))


#: Table, id, class, field, target class and edge of every reference.
_REFERENCES = (
    ("results", "result_id", "Result", "indicator_abbreviation", "Indicator", "corresponds_to", "evidence_text"), ("results", "result_id", "Result", "tissue_site", "Tissue_Site", "measured_at", "evidence_text"),
    ("interventions", "intervention_id", "Intervention", "intervention_target", "Alternative", "uses", "evidence_text"), ("indicators", "indicator_id", "Indicator", "measured_in", "Tissue_Site", "measured_in", "NULL"),
)


def _edges_sql(name: str, ident: str, cls: str, field: str, target: str, edge: str, evidence: str) -> str:
    source = f"sha256('{cls}:' || {ident} || ':' || coalesce(document_id, ''))"
    return f"SELECT {source} AS source_id, {S.global_id(_PREFIX[target], target, field)} AS target_id, '{edge}' AS type, {evidence}::VARCHAR AS evidence, document_id, {ident} AS ord FROM {name} WHERE {S.strip(field)} <> ''"


@query(f"WITH r AS ({' UNION ALL '.join(_edges_sql(*r) for r in _REFERENCES)}) SELECT source_id, target_id, type, min(evidence) AS evidence, array_to_string(list_sort(list(DISTINCT document_id)), '|') AS source_pmids FROM r GROUP BY 1, 2, 3")
def all_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Edges of every reference field of every class."""
    parts = []
    shared = [c[0] for c in _CLASSES]
    for name, ident, cls, field, target, edge, evidence in _REFERENCES:
        source = F.sha2(F.concat(F.lit(f"{cls}:"), F.col(ident).cast("string"), F.lit(":"), F.coalesce("document_id", F.lit(""))), 256)
        reached = N.global_id(F.lit(target), F.col(field), F.lit(None).cast("string"), shared)
        said = F.lit(None).cast("string") if evidence == "NULL" else F.col(evidence)
        parts.append(table(spark, sf, name).where(N.nonblank(F.col(field)).isNotNull()).select(source.alias("s"), reached.alias("t"), F.lit(edge).alias("k"), said.alias("evidence"), "document_id", F.col(ident).alias("ord")))
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    # of a row delivered twice the first evidence in order may be either: the least is taken
    least = every.groupBy("s", "t", "k", "document_id", "ord").agg(F.min("evidence").alias("evidence"))
    e = graph.edges(least, source="s", target="t", kind="k", document="document_id", evidence="evidence", order="ord")
    return e.withColumn("source_pmids", F.array_join("source_pmids", "|"))


@query(r"""WITH d AS (SELECT DISTINCT a.alternative_id, lower(a.standard_name) AS m, lower(d.body_text) AS t FROM alternatives a JOIN articles d USING (document_id) WHERE regexp_matches(a.standard_name, '^[\x21-\x7e][\x20-\x7e]*[\x21-\x7e]$') AND d.body_text IS NOT NULL)
SELECT alternative_id, coalesce(min(p), -1) AS start_pos FROM (SELECT alternative_id, CASE WHEN regexp_matches(t, '(?s)^(.*?[^\p{L}])??' || regexp_escape(m) || '([^\p{L}]|$)') THEN length(regexp_extract(t, '(?s)^((?:.*?[^\p{L}])??)' || regexp_escape(m) || '(?:[^\p{L}]|$)', 1)) END AS p FROM d) GROUP BY 1""")
def word_align(spark: SparkSession, sf: str) -> DataFrame:
    """Where an article's body names a substance, any case, not inside a word: the first tier of alignment in the JVM."""
    a = table(spark, sf, "alternatives").where(F.col("standard_name").rlike(r"^[\x21-\x7e][\x20-\x7e]*[\x21-\x7e]$")).select("document_id", "alternative_id", "standard_name")
    d = table(spark, sf, "articles").where("body_text IS NOT NULL").select("document_id", "body_text")
    return a.join(d, "document_id").select("alternative_id", align.word_position(F.col("standard_name"), F.col("body_text")).cast("long").alias("start_pos")).distinct()


@query(f"WITH c AS ({SQL['conclusions']}) SELECT document_id, coalesce(nullif(title, ''), document_id) AS name, coalesce(doi, '') || '|' || coalesce(pmid, '') || '|' || coalesce(journal, '') || '|' || coalesce(publication_year, '') || '|' || coalesce(publication_date, '') || '|' || coalesce(conclusion, '') AS fields, 'front-matter:' || string_split(file_path, '/')[-1] AS source_location FROM articles LEFT JOIN c USING (document_id) WHERE coalesce(title, '') <> '' OR coalesce(doi, '') <> ''")
def literature(spark: SparkSession, sf: str) -> DataFrame:
    """What each article's front matter says of the article itself."""
    m = src.literature(table(spark, sf, "articles"))
    of = F.concat_ws("|", *(F.coalesce(F.col("attributes")[a], F.lit("")) for a in ("doi", "pmid", "journal", "publication_year", "publication_date", "abstract_conclusion")))
    return m.select("document_id", "name", of.alias("fields"), "source_location")


@query(f"""WITH RECURSIVE {graphs._NODES}, {graphs._STEPS}, e AS ({SQL['all_edges']})
SELECT DISTINCT coalesce(a.into_id, source_id) AS source_id, coalesce(b.into_id, target_id) AS target_id, type FROM e LEFT JOIN merged a ON a.id = source_id LEFT JOIN merged b ON b.id = target_id WHERE coalesce(a.into_id, source_id) <> coalesce(b.into_id, target_id)""")
def edges_after_merge(spark: SparkSession, sf: str) -> DataFrame:
    """All edges, their ends moved to the nodes that others were merged into."""
    return graph.remap(all_edges(spark, sf), graphs.merged_nodes(spark, sf)).select("source_id", "target_id", "type")


_IND, _SITE = S.global_id("indi", "Indicator", "abbreviation"), S.global_id("tiss", "Tissue_Site", "{}")


@query(f"""WITH n AS (SELECT {_IND} AS id FROM indicators WHERE {S.strip('abbreviation')} <> '' AND {S.strip('unit')} <> '' UNION SELECT {_SITE.format('site_name')} FROM tissue_sites WHERE {S.strip('site_name')} <> '' AND deleted_at IS NULL),
e AS (SELECT DISTINCT {_IND} AS source_id, {_SITE.format('measured_in')} AS target_id, 'measured_in' AS type FROM indicators WHERE {S.strip('abbreviation')} <> '' AND {S.strip('measured_in')} <> '')
SELECT *, source_id NOT IN (SELECT id FROM n) AS no_source, target_id NOT IN (SELECT id FROM n) AS no_target FROM e WHERE source_id NOT IN (SELECT id FROM n) OR target_id NOT IN (SELECT id FROM n)""")
def dangling_ends(spark: SparkSession, sf: str) -> DataFrame:
    """Edges from indicators to sites of which an end is no node, and which end."""
    gid = lambda cls, c: N.global_id(F.lit(cls), F.col(c), F.lit(None).cast("string"), ["Indicator", "Tissue_Site"])
    stated = lambda c: N.nonblank(F.col(c)).isNotNull()
    i, t = table(spark, sf, "indicators"), table(spark, sf, "tissue_sites")
    nodes = i.where(stated("abbreviation") & stated("unit")).select(gid("Indicator", "abbreviation").alias("id")).union(t.where(stated("site_name") & F.col("deleted_at").isNull()).select(gid("Tissue_Site", "site_name").alias("id"))).distinct()
    edges = i.where(stated("abbreviation") & stated("measured_in")).select(gid("Indicator", "abbreviation").alias("source_id"), gid("Tissue_Site", "measured_in").alias("target_id"), F.lit("measured_in").alias("type")).distinct()
    lost = graph.dangling_edges(edges, nodes)
    for end in ("source", "target"):
        lost = lost.join(nodes.select(F.col("id").alias(f"{end}_id"), F.lit(False).alias(f"no_{end}")), f"{end}_id", "left").withColumn(f"no_{end}", F.coalesce(f"no_{end}", F.lit(True)))
    return lost
