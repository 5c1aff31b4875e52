"""Vocabulary and entity lookups, references and their targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import coref, extract, lookup, vocabulary
from ..session import table
from . import query
from . import sqltext as S


def _vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary.load(table(spark, sf, "vocabulary"), "names", "alternative_class", "subclass")


@query(f"WITH {S.ENTRY} SELECT DISTINCT key, entry_class, entry_subclass FROM entries WHERE key <> ''")
def vocab_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of the vocabulary with class and subclass."""
    return _vocabulary(spark, sf)


@query(f"WITH {S.ENTRY} SELECT alternative_id, key, entry_class FROM alternatives JOIN entries ON lower({S.strip('standard_name')}) = key")
def vocab_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Names equal to a key in any case."""
    a = table(spark, sf, "alternatives").select("alternative_id", F.lower(N.strip(F.col("standard_name"))).alias("key"))
    return a.join(vocabulary.small(_vocabulary(spark, sf)), "key").select("alternative_id", "key", "entry_class")


_PAIR = f"""CASE WHEN n = key THEN 1 WHEN {S.vocab_name('n')} = {S.vocab_name('key')} THEN 2 WHEN length(key) >= 3 AND length(n) >= 3 AND (contains(n, key) OR contains(key, n)) THEN 3
 WHEN regexp_replace(n, '[^\\p{{L}}\\p{{N}}]', '', 'g') = regexp_replace(key, '[^\\p{{L}}\\p{{N}}]', '', 'g') THEN 4 WHEN length(key) >= 3 AND levenshtein(n, key) <= 3 THEN 5 END"""
_DIST = "CASE WHEN tier IN (1, 2, 4) THEN 0 WHEN levenshtein(n, key) <= 3 THEN levenshtein(n, key) ELSE 4 END"


@query(f"""WITH {S.ENTRY}, d AS (SELECT DISTINCT standard_name AS name FROM alternatives WHERE {S.strip('standard_name')} <> ''),
n AS (SELECT name, lower({S.strip('name')}) AS n, 0 AS part FROM d UNION ALL SELECT name, lower({S.strip('p')}), 1 FROM (SELECT name, unnest(string_split(name, ',')) AS p FROM d WHERE contains(name, ',')) WHERE {S.strip('p')} <> ''),
p AS (SELECT *, {_DIST} AS dist FROM (SELECT n.*, e.*, {_PAIR} AS tier FROM n, entries e) WHERE tier IS NOT NULL),
w AS (SELECT name, part, arg_min({{'t': tier, 'key': key, 'c': entry_class, 's': entry_subclass}}, (tier, dist, key)) AS b FROM p GROUP BY name, part),
f AS (SELECT name, CASE WHEN part = 1 THEN 6 ELSE b.t END AS tier, b.key AS key, b.c AS c, b.s AS s FROM w QUALIFY row_number() OVER (PARTITION BY name ORDER BY part) = 1)
SELECT name, tier, key, coalesce(c, 'Other') AS entry_class, s AS entry_subclass, CASE WHEN tier IS NULL THEN 'unmatched' WHEN tier = 1 THEN 'exact' ELSE 'fuzzy' END AS match_source FROM d LEFT JOIN f USING (name)""")
def vocab_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Best vocabulary entry of each name by the cascade of tiers."""
    return vocabulary.cascade(table(spark, sf, "alternatives"), "standard_name", _vocabulary(spark, sf))


@query(f"""WITH {S.ENTRY}, n AS (SELECT DISTINCT intervention_target FROM interventions)
SELECT intervention_target, arg_min(entry_class, (-length(key), key)) AS entry_class FROM n JOIN entries ON length(key) >= 3 AND (contains(lower({S.strip('intervention_target')}), key) OR (length({S.strip('intervention_target')}) >= 3 AND contains(key, lower({S.strip('intervention_target')})))) GROUP BY 1""")
def vocab_containment(spark: SparkSession, sf: str) -> DataFrame:
    """Class of the longest key that a target contains or lies in."""
    return vocabulary.second_pass(table(spark, sf, "interventions"), "intervention_target", _vocabulary(spark, sf))


@query(f"""WITH {S.ENTRY}, k AS (SELECT DISTINCT alternative_class, subclass, key FROM (SELECT alternative_class, subclass, lower({S.strip(r"regexp_replace(raw, '\s*\([^)]*\)\s*$', '')")}) AS key FROM (SELECT alternative_class, subclass, unnest(string_split(names, ',')) AS raw FROM vocabulary)) WHERE key <> '')
SELECT alternative_class, subclass, count(*) AS n_names, array_to_string(list_sort(list(key))[1:3], '; ') AS examples FROM k GROUP BY ALL""")
def vocab_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Number of names and first three examples per class and subclass."""
    return vocabulary.summary(table(spark, sf, "vocabulary"), "alternative_class", "subclass", "names")


@query(f"""SELECT alias, min(canonical) AS canonical FROM (SELECT {S.coref_name('raw')} AS canonical, {S.coref_name(r"regexp_extract(raw, '\(([^)]*)\)', 1)")} AS alias FROM (SELECT unnest(string_split(names, ',')) AS raw FROM vocabulary)) WHERE alias <> '' AND canonical <> '' GROUP BY 1""")
def vocab_synonyms(spark: SparkSession, sf: str) -> DataFrame:
    """Abbreviations in the vocabulary beside their names."""
    return vocabulary.synonyms(table(spark, sf, "vocabulary"), "names")


def _substances(spark: SparkSession, sf: str) -> DataFrame:
    attrs = F.map_filter(F.create_map(F.lit("abbreviation"), "abbreviation", F.lit("original_text"), "original_text"), lambda k, v: v.isNotNull())
    return table(spark, sf, "alternatives").select("document_id", "alternative_id", "standard_name", attrs.alias("attributes"))


@query(f"""SELECT document_id, key, min(alternative_id) AS alternative_id FROM (SELECT document_id, alternative_id, lower({S.strip('a')}) AS key FROM
 (SELECT document_id, alternative_id, unnest([standard_name, abbreviation, original_text]) AS a FROM alternatives)) WHERE key <> '' GROUP BY ALL""")
def entity_aliases(spark: SparkSession, sf: str) -> DataFrame:
    """Every text under which a substance may be named in its document."""
    return lookup.alias_table(_substances(spark, sf), scope=["document_id"], ident="alternative_id", text="standard_name", attributes="attributes")


_WORDS = "list_filter(string_split({}, ' '), lambda w: w <> '')"
_R, _N = S.relation_name("r"), S.relation_name("n")
_INITIALS = r"array_to_string(list_transform(list_filter(regexp_split_to_array(n, '\s+'), lambda w: w <> ''), lambda w: upper(substr(w, 1, 1))), '')"


@query(f"""WITH r AS (SELECT DISTINCT document_id, intervention_id, intervention_target AS r FROM interventions WHERE {S.strip('intervention_target')} <> ''),
e AS (SELECT DISTINCT document_id, alternative_id, standard_name AS n FROM alternatives WHERE {S.strip('standard_name')} <> ''),
p AS (SELECT intervention_id, alternative_id, CASE WHEN lower({S.strip('r')}) = lower({S.strip('n')}) THEN 1 WHEN x <> '' AND x = y THEN 2 WHEN length(x) >= 3 AND length(y) >= 3 AND (contains(x, y) OR contains(y, x)) THEN 3
 WHEN len(list_intersect({_WORDS.format('x')}, {_WORDS.format('y')})) >= 2 THEN 4 WHEN upper({S.strip('r')}) = {_INITIALS} AND length({S.strip('r')}) >= 2 THEN 5 END AS tier
 FROM (SELECT *, {_R} AS x, {_N} AS y FROM r JOIN e USING (document_id)))
SELECT intervention_id, arg_min(alternative_id, (tier, alternative_id)) AS alternative_id, min(tier) AS tier FROM p WHERE tier IS NOT NULL GROUP BY 1""")
def find_targets(spark: SparkSession, sf: str) -> DataFrame:
    """Substance that an intervention's target names, by five tiers within the document."""
    return lookup.find(table(spark, sf, "interventions"), table(spark, sf, "alternatives"), scope=["document_id"], ref_id="intervention_id", ref="intervention_target", ident="alternative_id", name="standard_name")


_LONG = r"list_distinct(list_filter(regexp_split_to_array(lower({}), '\W+'), lambda w: length(w) > 3))"


@query(f"""WITH r AS (SELECT DISTINCT document_id, intervention_id, evidence_text, duration, basal_diet, positive_control FROM interventions WHERE coalesce({S.strip('intervention_target')}, '') = ''),
t AS (SELECT DISTINCT document_id, alternative_id AS k, lower({S.strip('standard_name')}) AS key FROM alternatives WHERE {S.strip('standard_name')} <> ''),
own AS (SELECT document_id, intervention_id, 1 AS way, lower({S.strip('evidence_text')}) AS key FROM r UNION ALL SELECT document_id, intervention_id, 2, lower({S.strip('v')}) FROM (SELECT document_id, intervention_id, unnest([duration, basal_diet, positive_control]) AS v FROM r)),
hits AS (SELECT intervention_id, way, k FROM own JOIN t USING (document_id, key) UNION ALL
 SELECT intervention_id, 3, k FROM (SELECT document_id, intervention_id, unnest({_LONG.format('evidence_text')}) AS w FROM r) JOIN (SELECT document_id, k, unnest({_LONG.format('key')}) AS w FROM t) USING (document_id, w))
SELECT intervention_id, arg_min(k, (way, k)) AS alternative_id FROM hits GROUP BY 1""")
def detect_references(spark: SparkSession, sf: str) -> DataFrame:
    """Substance that an intervention without a target names in its evidence or another field."""
    i = table(spark, sf, "interventions").where(N.nonblank(F.col("intervention_target")).isNull())
    attrs = F.map_filter(F.create_map(*(x for c in ("duration", "basal_diet", "positive_control") for x in (F.lit(c), F.col(c)))), lambda k, v: v.isNotNull())
    return lookup.detect(i.withColumn("attributes", attrs), table(spark, sf, "alternatives"), scope=["document_id"], ident="intervention_id", text="evidence_text", attributes="attributes", target_key="alternative_id", target_name="standard_name")


@query(f"""WITH t AS (SELECT DISTINCT document_id, lower({S.strip('standard_name')}) AS t FROM alternatives WHERE {S.strip('standard_name')} <> '')
SELECT DISTINCT intervention_id FROM interventions i WHERE {S.strip('intervention_target')} <> '' AND NOT EXISTS (FROM t WHERE t.document_id = i.document_id AND (contains(lower({S.strip('intervention_target')}), t.t) OR contains(t.t, lower({S.strip('intervention_target')}))))""")
def dangling_references(spark: SparkSession, sf: str) -> DataFrame:
    """Interventions whose target no substance of the document answers."""
    return lookup.dangling(table(spark, sf, "interventions"), table(spark, sf, "alternatives"), ["document_id"], "intervention_target", "standard_name").select("intervention_id").distinct()


_KEPT = f"""kept AS (SELECT * FROM indicators i WHERE EXISTS (FROM results r WHERE r.document_id = i.document_id AND {S.strip('r.indicator_abbreviation')} <> '' AND lower({S.strip('r.indicator_abbreviation')}) IN (lower({S.strip('i.abbreviation')}), lower({S.strip('i.standard_name')}))))"""


@query(f"WITH {_KEPT} SELECT 'Indicator' AS cls, indicator_id AS id FROM kept UNION ALL SELECT 'Tissue_Site', tissue_site_id FROM tissue_sites t WHERE EXISTS (FROM kept k WHERE k.document_id = t.document_id AND lower({S.strip('k.measured_in')}) = lower({S.strip('t.site_name')}) AND {S.strip('k.measured_in')} <> '')")
def referenced_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Indicators that a result names, and sites that those indicators name: two semi-joins in a row."""
    kept = lookup.answered(table(spark, sf, "indicators").select("document_id", "indicator_id", "abbreviation", "standard_name", "measured_in"), table(spark, sf, "results"), ["document_id"], ["abbreviation", "standard_name"], "indicator_abbreviation")
    sites = lookup.answered(table(spark, sf, "tissue_sites").select("document_id", "tissue_site_id", "site_name"), kept, ["document_id"], ["site_name"], "measured_in")
    return kept.select(F.lit("Indicator").alias("cls"), F.col("indicator_id").alias("id")).unionByName(sites.select(F.lit("Tissue_Site").alias("cls"), F.col("tissue_site_id").alias("id")))


@query(f"SELECT alternative_id FROM alternatives a WHERE NOT EXISTS (FROM interventions i WHERE i.document_id = a.document_id AND lower({S.strip('i.intervention_target')}) IN (lower({S.strip('a.standard_name')}), lower({S.strip('a.abbreviation')})) AND {S.strip('i.intervention_target')} <> '')")
def orphan_substances(spark: SparkSession, sf: str) -> DataFrame:
    """Substances that no intervention names."""
    a = table(spark, sf, "alternatives").select("document_id", "alternative_id", "standard_name", "abbreviation")
    named = lookup.answered(a, table(spark, sf, "interventions"), ["document_id"], ["standard_name", "abbreviation"], "intervention_target")
    return a.join(named.select("alternative_id"), "alternative_id", "left_anti").select("alternative_id")


@query(f"""WITH n AS (SELECT document_id, lower({S.strip('indicator_abbreviation')}) AS key, arg_min(indicator_abbreviation, result_id) AS name FROM results WHERE {S.strip('indicator_abbreviation')} <> '' GROUP BY ALL)
SELECT document_id, key, name FROM n WHERE NOT EXISTS (FROM indicators i WHERE i.document_id = n.document_id AND key IN (lower({S.strip('i.abbreviation')}), lower({S.strip('i.standard_name')})))""")
def missing_indicators(spark: SparkSession, sf: str) -> DataFrame:
    """Indicators to create: named by results and absent from the document."""
    return lookup.missing_targets(table(spark, sf, "results"), table(spark, sf, "indicators"), ["document_id"], "indicator_abbreviation", ["abbreviation", "standard_name"], "result_id")


@query(f"""SELECT DISTINCT intervention_id FROM (SELECT intervention_id, {S.relation_name('intervention_target')} AS x, {S.relation_name('standard_name')} AS y FROM interventions JOIN alternatives USING (document_id))
WHERE x <> '' AND y <> '' AND (contains(x, y) OR contains(y, x) OR len(list_intersect(string_split(x, ' '), string_split(y, ' '))) >= 2)""")
def overlapping_targets(spark: SparkSession, sf: str) -> DataFrame:
    """Interventions whose target shares its words with a substance of the document."""
    return lookup.overlapping_names(table(spark, sf, "interventions"), table(spark, sf, "alternatives"), ["document_id"], "intervention_id", "intervention_target", "standard_name")


@query(f"""SELECT document_id, count(*) AS n_orphans FROM (SELECT DISTINCT document_id, result_id, indicator_abbreviation FROM results WHERE {S.strip('indicator_abbreviation')} <> '') r
WHERE NOT EXISTS (FROM indicators i WHERE i.document_id = r.document_id AND lower({S.strip('i.abbreviation')}) = lower({S.strip('r.indicator_abbreviation')})) GROUP BY 1""")
def orphan_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Results without their indicator, per document."""
    key = lambda c: F.lower(N.strip(F.col(c)))
    r = table(spark, sf, "results").select("document_id", "result_id", key("indicator_abbreviation").alias("k"), "indicator_abbreviation").where("k <> ''").distinct()
    i = table(spark, sf, "indicators").select("document_id", key("abbreviation").alias("k"))
    return r.join(i, ["document_id", "k"], "left_anti").groupBy("document_id").agg(F.count(F.lit(1)).alias("n_orphans"))


_ALIAS = f"""a AS (SELECT document_id, alias, arg_min(canonical, (length(canonical), canonical)) AS canonical FROM (SELECT document_id, {S.coref_name('abbreviation')} AS alias, {S.coref_name('standard_name')} AS canonical FROM indicators) WHERE alias <> '' AND canonical <> '' AND alias <> canonical GROUP BY ALL)"""


@query(f"WITH {_ALIAS} SELECT * FROM a")
def alias_map(spark: SparkSession, sf: str) -> DataFrame:
    """Abbreviations of a document's indicators beside their names."""
    return coref.alias_map(table(spark, sf, "indicators"), ["document_id"], "standard_name", "abbreviation")


@query(f"WITH {_ALIAS} SELECT DISTINCT result_id, coalesce(canonical, indicator_abbreviation) AS indicator FROM results LEFT JOIN a ON a.document_id = results.document_id AND a.alias = lower({S.strip('indicator_abbreviation')})")
def canonical_references(spark: SparkSession, sf: str) -> DataFrame:
    """Results with their indicator's abbreviation replaced by its name."""
    out = lookup.rewrite(table(spark, sf, "results").select("document_id", "result_id", "indicator_abbreviation"), alias_map(spark, sf), ["document_id"], "indicator_abbreviation")
    return out.select("result_id", F.col("indicator_abbreviation").alias("indicator")).distinct()


@query(f"""WITH n AS (SELECT DISTINCT document_id, {S.coref_name('standard_name')} AS n FROM alternatives), w AS (SELECT document_id, n, list_distinct(string_split(n, ' ')) AS w FROM n WHERE n <> '')
SELECT b.document_id, b.n AS alias, arg_min(a.n, (length(a.n), a.n)) AS canonical FROM w a JOIN w b ON a.document_id = b.document_id AND len(a.w) >= 2 AND len(a.w) < len(b.w) AND list_has_all(b.w, a.w) GROUP BY ALL""")
def subset_aliases(spark: SparkSession, sf: str) -> DataFrame:
    """Names of a document that have all the words of a shorter one."""
    return coref.subset_aliases(table(spark, sf, "alternatives"), ["document_id"], "standard_name")


@query()
def coreferences(spark: SparkSession, sf: str) -> DataFrame:
    """Group of each substance mention of a document by the greedy merge."""
    a = table(spark, sf, "alternatives").select("document_id", "alternative_id", "standard_name", "abbreviation")
    return coref.resolve(a, ["document_id"], order="alternative_id", text="standard_name", aliases=coref.alias_map(a, ["document_id"], "standard_name", "abbreviation")).select("alternative_id", "group_key")


@query(f"""SELECT document_id, min(c) AS component FROM (SELECT DISTINCT document_id, {S.strip('positive_control')} AS c FROM interventions) p WHERE length(c) >= 3 AND lower(c) NOT IN ('none', 'n/a')
AND NOT EXISTS (FROM alternatives a WHERE a.document_id = p.document_id AND lower({S.strip('a.standard_name')}) = lower(c)) GROUP BY document_id, lower(c)""")
def new_components(spark: SparkSession, sf: str) -> DataFrame:
    """Components of products that the document doesn't hold as substances yet."""
    i = table(spark, sf, "interventions").select("document_id", F.array("positive_control").alias("components"))
    return extract.new_components(i, table(spark, sf, "alternatives"), ["document_id"], "components", "standard_name")


@query("SELECT document_id, string_agg(t, '; ' ORDER BY o, t) AS context FROM (SELECT document_id, standard_name || ' (' || coalesce(abbreviation, '-') || ')' AS t, min(indicator_id) AS o FROM indicators WHERE standard_name IS NOT NULL GROUP BY ALL) GROUP BY 1")
def reference_context(spark: SparkSession, sf: str) -> DataFrame:
    """One text per document that names its indicators, for a later prompt."""
    i = table(spark, sf, "indicators").where("standard_name IS NOT NULL")
    return extract.context_line(i, ["document_id"], F.concat("standard_name", F.lit(" ("), F.coalesce("abbreviation", F.lit("-")), F.lit(")")), "indicator_id")
