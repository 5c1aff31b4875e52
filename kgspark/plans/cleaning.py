"""Names, values, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import casing as C
from ..functions import names as N
from ..functions import values as V
from ..operators import dedup, extract, similarity
from ..session import table
from . import query
from . import sqltext as S


@query(f"SELECT DISTINCT standard_name AS name, {S.graph_name('standard_name')} AS graph, {S.coref_name('standard_name')} AS coref, {S.dedup_name('standard_name')} AS dedup, {S.vocab_name('standard_name')} AS vocab, {S.relation_name('standard_name')} AS relation FROM alternatives WHERE standard_name IS NOT NULL")
def name_forms(spark: SparkSession, sf: str) -> DataFrame:
    """The five normal forms of a name."""
    n = table(spark, sf, "alternatives").select(F.col("standard_name").alias("name")).where("name IS NOT NULL").distinct()
    c = F.col("name")
    return n.select("name", N.graph_name(c).alias("graph"), N.coref_name(c).alias("coref"), N.dedup_name(c).alias("dedup"), N.vocab_name(c).alias("vocab"), N.relation_name(c).alias("relation"))


@query(f"""SELECT DISTINCT 'Alternative' AS cls, standard_name AS name, NULL AS document_id, {S.global_id('alte', 'Alternative', 'standard_name')} AS id FROM alternatives
UNION ALL SELECT DISTINCT 'Result', indicator_abbreviation, document_id, {S.global_id('resu', 'Result', 'indicator_abbreviation', 'document_id')} FROM results""")
def global_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Deterministic ids: one class shared by all documents, one within each document."""
    a = table(spark, sf, "alternatives").select(F.lit("Alternative").alias("cls"), F.col("standard_name").alias("name"), F.lit(None).cast("string").alias("document_id")).distinct()
    r = table(spark, sf, "results").select(F.lit("Result").alias("cls"), F.col("indicator_abbreviation").alias("name"), "document_id").distinct()
    return a.unionByName(r).withColumn("id", N.global_id(F.col("cls"), F.col("name"), F.col("document_id"), ["Alternative"]))


_IDENTITY = f"CASE WHEN {S.strip('abbreviation')} <> '' THEN abbreviation ELSE standard_name END"


@query(f"SELECT indicator_id, {S.coref_name(_IDENTITY)} AS identity FROM indicators")
def identity_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Identity of an indicator: its abbreviation if stated, else its name."""
    return table(spark, sf, "indicators").select("indicator_id", N.identity_key(F.col("abbreviation"), F.col("standard_name")).alias("identity"))


_NAMES = f"n AS (SELECT DISTINCT document_id, {S.coref_name('standard_name')} AS n FROM alternatives WHERE {S.coref_name('standard_name')} <> '')"


def _names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "alternatives").select("document_id", N.coref_name(F.col("standard_name")).alias("name"))


@query(f"WITH {_NAMES} SELECT x.document_id, x.n AS a, y.n AS b FROM n x JOIN n y ON x.document_id = y.document_id AND x.n < y.n WHERE abs(length(x.n) - length(y.n)) <= 4 AND levenshtein(x.n, y.n) <= 2")
def levenshtein_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Names of one document within two edits."""
    return similarity.near_pairs(_names(spark, sf), ["document_id"], "name", 2)


@query(f"WITH {_NAMES} SELECT x.document_id, x.n AS a, y.n AS b FROM n x JOIN n y ON x.document_id = y.document_id AND x.n < y.n WHERE (contains(x.n, y.n) OR contains(y.n, x.n)) AND least(length(x.n), length(y.n)) / greatest(length(x.n), length(y.n)) >= 0.6")
def contained_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Names of one document of which one lies in the other."""
    return similarity.contained_pairs(_names(spark, sf), ["document_id"], "name", 0.6)


_SHORT, _FULL = S.strip("abbreviation"), S.strip("standard_name")


@query(rf"""WITH i AS (SELECT indicator_id, abbreviation, standard_name, {_SHORT} AS s, {_FULL} AS f, list_filter(regexp_split_to_array({_FULL}, '\s+'), lambda w: w <> '') AS w FROM indicators),
j AS (SELECT *, array_to_string(list_transform(w, lambda x: upper(x[1])), '') AS ini FROM i WHERE length(s) BETWEEN 1 AND 5 AND length(f) > 5 AND regexp_matches(s, '\p{{L}}') AND (s = upper(s) OR regexp_matches(s, '^[^a-z]?[A-Z]?[^A-Z]*$')))
SELECT indicator_id, abbreviation, standard_name FROM j WHERE (s = upper(s) OR s = upper(s[1]) || lower(substr(s, 2))) AND (contains(lower(f), lower(s)) OR (len(w) >= length(s) AND (starts_with(ini, upper(s))
 OR regexp_matches(ini, '^.*' || array_to_string(list_transform(string_split(upper(s), ''), lambda c: CASE WHEN regexp_matches(c, '[A-Z0-9]') THEN c ELSE '[' || c || ']' END), '.*') || '.*$'))))""")
def abbreviation_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Indicators whose abbreviation stands for their name."""
    i = table(spark, sf, "indicators").select("indicator_id", "abbreviation", "standard_name")
    return i.where(N.abbreviates(F.col("abbreviation"), F.col("standard_name")))


_T = S.strip("coalesce(standard_name, '')")
_QUALITY = rf"""CASE WHEN t = '' THEN 0 ELSE (CASE WHEN length(t) BETWEEN 3 AND 80 THEN 30 WHEN length(t) < 3 THEN 10 ELSE 0 END)
 + (CASE WHEN regexp_matches(t, '^\d') THEN 0 ELSE 20 END) + (CASE WHEN regexp_matches(t, '^[\d\s.,;:!?\-–—()\[\]{{}}]+$') THEN 0 ELSE 20 END)
 + (CASE WHEN regexp_matches(t, '\d+\s*[×x]\s*\d+\s*(CFU|cfu)') THEN 0 ELSE 15 END) + (CASE WHEN regexp_matches(t, '^[{{\[]') THEN 0 ELSE 15 END) END"""


@query(f"SELECT DISTINCT t AS name, {_QUALITY} AS score FROM (SELECT {_T} AS t FROM alternatives)")
def quality_scores(spark: SparkSession, sf: str) -> DataFrame:
    """How much a name looks like one."""
    n = table(spark, sf, "alternatives").select(N.strip(F.coalesce("standard_name", F.lit(""))).alias("name")).distinct()
    return n.withColumn("score", N.name_quality(F.col("name")))


@query(rf"SELECT alternative_id FROM (SELECT alternative_id, {_T} AS t FROM alternatives) WHERE contains(t, '_') OR (len(list_filter(regexp_split_to_array(t, '\s+'), lambda w: w <> '')) > 4 AND t = lower(t))")
def synthetic_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names that read like made-up labels."""
    return table(spark, sf, "alternatives").where(N.looks_synthetic(F.col("standard_name"))).select("alternative_id")


@query(rf"SELECT DISTINCT original_text, regexp_replace({S.strip(S.spaced(r'''regexp_replace(original_text, '\(\s*\)|\[\s*\]', '', 'g')'''))}, '^[(\[]([^()\[\]]*)[)\]]$', '\1') AS cleaned FROM alternatives")
def clean_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Texts without control characters, doubled blanks and empty or wrapping brackets."""
    return table(spark, sf, "alternatives").select("original_text").distinct().withColumn("cleaned", V.clean_text(F.col("original_text")))


@query("SELECT doc_id, nfc_normalize(text) AS text FROM documents")
def composed_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Document texts in canonical composition."""
    return table(spark, sf, "documents").select("doc_id", V.nfc(F.col("text")).alias("text"))


def _any(x: str, values: tuple[str, ...]) -> str:
    return f"{x} IN ({', '.join(repr(v) for v in values)})"


_LIST = r"regexp_split_to_array(t, '\s+')"
_CAPITAL = "upper(substr(w, 1, 1)) || lower(substr(w, 2))"
_RULE = f"""CASE WHEN regexp_matches(t, '{"|".join(C.KEPT)}') THEN 'preserve' WHEN {_any('upper(t)', C.ACRONYMS)} AND length(t) <= 6 THEN 'preserve'
 WHEN l LIKE '% acid' AND NOT {_any('l', C.AMINO_ACIDS)} AND l NOT LIKE '%nucleic%' AND l NOT LIKE '%fatty%' THEN 'lowercase' WHEN (l LIKE '%ase' OR l LIKE '%zyme') AND length(t) > 5 THEN 'lowercase'
 WHEN regexp_matches(t, '^[A-Za-z]\\. [a-z]') THEN 'preserve' WHEN regexp_matches(l, '^({"|".join(C.SIGNALS)})') THEN 'lowercase' WHEN {_any('l', (*C.MEASURES, *C.COMPOUNDS))} THEN 'lowercase'
 WHEN {_any('l', (*C.AMINO_ACIDS, *C.MINERALS, *C.SITES))} THEN 'title' WHEN l LIKE 'vitamin %' OR {_any('l', C.VITAMINS)} THEN 'vitamin' WHEN len({_LIST}) = 2 THEN 'binomial'
 WHEN t = l AND regexp_matches(t, '\\p{{Ll}}') AND (contains(t, ' ') OR length(t) > 2) THEN 'title' ELSE 'preserve' END"""
_TITLE = f"""array_to_string(list_transform({_LIST}, lambda w, i: CASE WHEN i > 1 AND {_any('lower(w)', C.SMALL_WORDS)} THEN lower(w)
 WHEN i > 1 AND w = upper(w) AND regexp_matches(w, '\\p{{Lu}}') AND length(w) <= 3 THEN w ELSE {_CAPITAL} END), ' ')"""
_BINOMIAL = f"array_to_string(list_transform({_LIST}, lambda w, i: CASE WHEN i = 1 THEN {_CAPITAL} WHEN i = 2 THEN lower(w) ELSE w END), ' ')"
_GREEK = "CASE l " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in C.GREEK_FORMS.items()) + " END"


@query(f"""SELECT t AS name, r AS rule, CASE r WHEN 'lowercase' THEN l WHEN 'title' THEN {_TITLE} WHEN 'binomial' THEN {_BINOMIAL} WHEN 'vitamin' THEN coalesce({_GREEK}, CASE WHEN l LIKE 'vitamin %' THEN 'Vitamin ' || upper({S.strip('substr(l, 9)')}) ELSE {_TITLE} END) ELSE t END AS cased
FROM (SELECT t, l, {_RULE} AS r FROM (SELECT t, lower(t) AS l FROM (SELECT DISTINCT {S.strip('n')} AS t FROM (SELECT standard_name AS n FROM alternatives UNION ALL SELECT site_name FROM tissue_sites UNION ALL SELECT abbreviation FROM indicators UNION ALL SELECT standard_name FROM indicators) WHERE n IS NOT NULL)))""")
def case_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The case rule of each name, and the name by that rule."""
    n = None
    for t, c in (("alternatives", "standard_name"), ("tissue_sites", "site_name"), ("indicators", "abbreviation"), ("indicators", "standard_name")):
        part = table(spark, sf, t).select(N.strip(F.col(c)).alias("name"))
        n = part if n is None else n.unionByName(part)
    n = n.where("name IS NOT NULL").distinct()
    return n.select("name", C.case_rule(F.col("name")).alias("rule"), C.apply_case(F.col("name")).alias("cased"))


_P = r"""(SELECT raw, regexp_replace(regexp_replace(s, '^[pP]?\s*[<>=≈]*\s*', ''), '\*+$|\s*\(.*\)$', '', 'g') AS bare, s FROM (SELECT raw, {s} AS s FROM
 (SELECT DISTINCT p_value_original_text AS raw FROM results)))""".replace("{s}", S.strip("raw"))
_IS_NUM = r"regexp_matches({}, '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$')"


@query(f"SELECT raw, coalesce(CASE WHEN {_IS_NUM.format('s')} THEN TRY_CAST(s AS DOUBLE) END, CASE WHEN {_IS_NUM.format('bare')} THEN TRY_CAST(bare AS DOUBLE) END, TRY_CAST(nullif(regexp_extract(bare, '(\\d+\\.?\\d*)', 1), '') AS DOUBLE)) AS p FROM {_P}")
def p_values(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers in the p-values as written."""
    return table(spark, sf, "results").select(F.col("p_value_original_text").alias("raw")).distinct().withColumn("p", V.p_value(F.col("raw")))


def _case(col: str, m: dict[str, str]) -> str:
    return f"CASE lower({S.strip(col)}) " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in m.items()) + f" ELSE {col} END"


@query(f"SELECT {_case('direction', V.DIRECTIONS)} AS direction, {_case('relation_type', V.RELATIONS)} AS relation_type, count(*) AS n FROM results GROUP BY ALL")
def value_maps(spark: SparkSession, sf: str) -> DataFrame:
    """Results by direction and relation after mapping other words for them."""
    r = table(spark, sf, "results")
    return r.groupBy(V.mapped(F.col("direction"), V.DIRECTIONS).alias("direction"), V.mapped(F.col("relation_type"), V.RELATIONS).alias("relation_type")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT {_case('compared_to_group', V.CONTROLS)} AS control, count(*) AS n FROM results GROUP BY 1")
def control_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Results by control group after mapping other words for it."""
    return table(spark, sf, "results").groupBy(V.mapped(F.col("compared_to_group"), V.CONTROLS).alias("control")).agg(F.count(F.lit(1)).alias("n"))


_STARTS = ", ".join(f"'{w}'" for w in V.SENTENCE_STARTS)


@query(rf"""SELECT result_id, CASE WHEN f <> '' AND f = lower(f) AND regexp_matches(f, '\p{{Ll}}') AND length(f) <= 6 AND f NOT IN ({_STARTS}) THEN {S.strip('substr(t, length(f) + 2)')} ELSE t END AS evidence
FROM (SELECT result_id, t, regexp_extract(t, '^([^ ]+) ', 1) AS f FROM (SELECT DISTINCT result_id, {S.strip(S.spaced("coalesce(evidence_text, '')"))} AS t FROM results))""")
def clean_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence without a leading fragment of a word."""
    return table(spark, sf, "results").select("result_id", V.clean_evidence(F.col("evidence_text")).alias("evidence")).distinct()


@query(r"""SELECT result_id, CASE WHEN t <> '' THEN 'Table ' || t WHEN f <> '' THEN 'Figure ' || f END AS location FROM (
 SELECT DISTINCT result_id, regexp_extract(x, '(?i)\b(?:Table|Tab\.)\s*(\d+)', 1) AS t, regexp_extract(x, '(?i)\b(?:Figure|Fig\.)\s*(\d+)', 1) AS f FROM (SELECT result_id, concat_ws(' ', source_location, evidence_text) AS x FROM results))""")
def table_references(spark: SparkSession, sf: str) -> DataFrame:
    """Table or figure named in a result's location or evidence."""
    return table(spark, sf, "results").select("result_id", V.table_reference(F.concat_ws(" ", "source_location", "evidence_text")).alias("location")).distinct()


_MARKS = "|".join(V.CONCLUSIONS)


@query(rf"""WITH s AS (SELECT document_id, string_split(regexp_replace({S.strip('abstract_text')}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS a FROM articles),
t AS (SELECT document_id, a[greatest(len(a) - 2, 1):] AS tail FROM s)
SELECT document_id, {S.strip(f"coalesce(list_filter(tail, lambda x: regexp_matches(lower(x), '^({_MARKS})'))[-1], tail[-1])")} AS conclusion FROM t""")
def conclusions(spark: SparkSession, sf: str) -> DataFrame:
    """Concluding sentence of each abstract."""
    return table(spark, sf, "articles").select("document_id", V.conclusion(F.col("abstract_text")).alias("conclusion"))


@query("""SELECT document_id, CASE WHEN y IS NULL OR y = '' THEN NULL WHEN m IS NULL THEN y WHEN d IS NULL THEN y || '-' || lpad(m, 2, '0') ELSE y || '-' || lpad(m, 2, '0') || '-' || lpad(d, 2, '0') END AS date
FROM (SELECT document_id, p[1] AS y, p[2] AS m, p[3] AS d FROM (SELECT document_id, string_split(publication_date, '-') AS p FROM articles))""")
def publication_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates as precise as given, put together from their parts."""
    p = F.split("publication_date", "-")
    part = lambda i: F.try_element_at(p, F.lit(i))
    return table(spark, sf, "articles").select("document_id", V.publication_date(F.nullif(part(1), F.lit("")), part(2), part(3)).alias("date"))


@query(f"SELECT document_id, cls, k AS key, count(*) AS n_rows FROM (SELECT document_id, 'Alternative' AS cls, {S.dedup_name('standard_name')} AS k FROM alternatives UNION ALL SELECT document_id, 'Indicator', {S.dedup_name('abbreviation')} FROM indicators) GROUP BY ALL")
def dedup_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Mentions of one identity in one document."""
    a = table(spark, sf, "alternatives").select("document_id", F.lit("Alternative").alias("cls"), N.dedup_name(F.col("standard_name")).alias("key"))
    i = table(spark, sf, "indicators").select("document_id", F.lit("Indicator").alias("cls"), N.dedup_name(F.col("abbreviation")).alias("key"))
    return a.unionByName(i).groupBy("document_id", "cls", "key").agg(F.count(F.lit(1)).alias("n_rows"))


def _wide(e: str) -> str:
    w = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
    return f"regexp_replace({e}, '^{w}|{w}$', '', 'g')"


def _mentions(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "alternatives")
    attrs = F.map_filter(F.create_map(F.lit("abbreviation"), "abbreviation", F.lit("cas_number"), "cas_number", F.lit("source_organism"), "source_organism"), lambda k, v: v.isNotNull())
    return a.select("document_id", N.dedup_name(F.col("standard_name")).alias("key"), "alternative_id", "standard_name", "evidence_text", attrs.alias("attributes"))


def _merged(pick: str) -> str:
    cols = ", ".join(f"{pick.format(c=c)} AS {c}" for c in ("abbreviation", "cas_number", "source_organism"))
    return f"SELECT document_id, {S.dedup_name('standard_name')} AS key, min(alternative_id) AS alternative_id, count(*) AS n_rows, arg_max(standard_name, (length(standard_name), -alternative_id)) FILTER (standard_name IS NOT NULL) AS standard_name, {cols} FROM alternatives GROUP BY ALL"


@query(_merged("arg_max({c}, (length({c}), -alternative_id)) FILTER (trim({c}) <> '')"))
def dedup_merge(spark: SparkSession, sf: str) -> DataFrame:
    """One row per identity and document: longest text, of each attribute the longest value."""
    m = dedup.merge_groups(_mentions(spark, sf), ["document_id", "key"], order="alternative_id", text="standard_name", attributes="attributes")
    return m.select("document_id", "key", "alternative_id", "n_rows", "standard_name", *(F.col("attributes")[c].alias(c) for c in ("abbreviation", "cas_number", "source_organism")))


@query(_merged("arg_min({c}, alternative_id) FILTER (trim({c}) <> '')"))
def strict_merge(spark: SparkSession, sf: str) -> DataFrame:
    """As above, of each attribute the first stated value."""
    m = dedup.merge_groups(_mentions(spark, sf), ["document_id", "key"], order="alternative_id", text="standard_name", attributes="attributes", rule="first")
    return m.select("document_id", "key", "alternative_id", "n_rows", "standard_name", *(F.col("attributes")[c].alias(c) for c in ("abbreviation", "cas_number", "source_organism")))


@query(f"""WITH p AS (SELECT document_id, {S.dedup_name('standard_name')} AS key, {_wide('evidence_text')} AS e, min(alternative_id) AS o FROM alternatives WHERE {_wide('evidence_text')} <> '' GROUP BY ALL),
l AS (SELECT document_id, key, list(e ORDER BY o) AS l FROM p GROUP BY ALL)
SELECT document_id, key, coalesce(array_to_string(list_filter(l, lambda x: len(list_filter(l, lambda y: y <> x AND contains(y, x))) = 0), ' <|> '), '') AS evidence_text FROM (SELECT DISTINCT document_id, {S.dedup_name('standard_name')} AS key FROM alternatives) LEFT JOIN l USING (document_id, key)""")
def evidence_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence of an identity joined in order, without parts that others contain."""
    m = dedup.merge_groups(_mentions(spark, sf), ["document_id", "key"], order="alternative_id", text="standard_name", evidence="evidence_text", separator=" <|> ")
    return m.select("document_id", "key", "evidence_text")


@query(f"SELECT {S.dedup_name('standard_name')} AS key, arg_max(standard_name, (length(standard_name), -alternative_id)) AS standard_name, array_to_string(list_sort(list(DISTINCT document_id)), '|') AS documents FROM alternatives WHERE trim(standard_name) <> '' GROUP BY ALL")
def global_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """One row per identity over all documents."""
    m = _mentions(spark, sf).where("key <> ''")
    return dedup.across_documents(m, ["key"], "document_id", "standard_name", "alternative_id").select("key", "standard_name", F.array_join("documents", "|").alias("documents"))


@query(f"SELECT {S.graph_name('standard_name')} AS base, count(DISTINCT standard_name) AS n_spellings, string_agg(DISTINCT standard_name, ' | ' ORDER BY standard_name) AS spellings FROM alternatives WHERE trim(standard_name) <> '' GROUP BY ALL HAVING count(DISTINCT standard_name) > 1")
def case_consistency(spark: SparkSession, sf: str) -> DataFrame:
    """Names written in more than one way."""
    m = table(spark, sf, "alternatives").where("trim(standard_name) <> ''").withColumn("base", N.graph_name(F.col("standard_name")))
    return dedup.spellings(m, ["base"], "standard_name")


@query(r"""SELECT doc_id, pos, unnest(CASE WHEN a <> '' AND contains(a, ' ') AND contains(b, ' ') AND length(t) - length(replace(t, ' ', '')) > 4 AND length(t) <= 60 THEN [t, a, b] ELSE [t] END) AS part FROM (
 SELECT doc_id, pos, t, {a} AS a, {b} AS b FROM (SELECT doc_id, pos, {t} AS t FROM (SELECT doc_id, unnest(range(1, len(string_split(text, '.')) + 1)) - 1 AS pos, unnest(string_split(text, '.')) AS c FROM documents WHERE text IS NOT NULL)) WHERE t <> '')""".replace("{t}", _wide("c")).replace("{a}", _wide(r"regexp_extract(t, '(?i)^(.+?)\s+and\s+(.+)$', 1)")).replace("{b}", _wide(r"regexp_extract(t, '(?i)^(.+?)\s+and\s+(.+)$', 2)")))
def decompose_clauses(spark: SparkSession, sf: str) -> DataFrame:
    """Every clause of each document that isn't blank, and its two sides if it reads 'A and B'."""
    d = table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", F.posexplode(F.split("text", r"\.")).alias("pos", "c"))
    d = d.select("doc_id", F.col("pos").cast("long").alias("pos"), N.strip(F.col("c")).alias("t")).where("t <> ''")
    return d.select("doc_id", "pos", F.explode(extract.split_conjunction(F.col("t"), ())).alias("part"))


@query(f"""SELECT result_id, {_case('direction', V.DIRECTIONS)} AS direction, (CASE WHEN coalesce({_case('direction', V.DIRECTIONS)}, '') <> coalesce(direction, '') THEN 1 ELSE 0 END) + (CASE WHEN coalesce({_case('relation_type', V.RELATIONS)}, '') <> coalesce(relation_type, '') THEN 1 ELSE 0 END) AS n_changes FROM (SELECT DISTINCT result_id, direction, relation_type FROM results)""")
def repairs(spark: SparkSession, sf: str) -> DataFrame:
    """Results with repaired direction and the number of repaired fields."""
    r = table(spark, sf, "results").select("result_id", "direction", "relation_type").distinct()
    d, t = V.mapped(F.col("direction"), V.DIRECTIONS), V.mapped(F.col("relation_type"), V.RELATIONS)
    changed = lambda a, b: (F.coalesce(a, F.lit("")) != F.coalesce(b, F.lit(""))).cast("int")
    return r.select("result_id", d.alias("direction"), (changed(d, F.col("direction")) + changed(t, F.col("relation_type"))).alias("n_changes"))


_ONE_THING = r"mono.*and\s+di.*and\s+tri|fatty\s+acid|\d+,\s*\d+.*and|β-.*and\s+β-|villi\s+and\s+crypt|mortality\s+and\s+|health\s+and\s+\w+|growth\s+and\s+\w+|quality\s+and\s+\w+|combination|complex|blend|mixture|powder|fiber|protein.*and|and.*protein|acid.*and.*acid|enzyme|cells|leaves.*and.*branch|fruit.*and.*vegetable|oil|extract.*and.*extract"


@query(r"""SELECT pos, part, count(*) AS n FROM (SELECT pos, unnest(CASE WHEN a <> '' AND contains(a, ' ') AND contains(b, ' ') AND length(t) - length(replace(t, ' ', '')) > 4 AND length(t) <= 60 AND NOT regexp_matches(t, '{whole}', 'i') THEN [t, a, b] ELSE [t] END) AS part FROM (
 SELECT pos, t, {a} AS a, {b} AS b FROM (SELECT pos, {t} AS t FROM (SELECT unnest(range(1, len(string_split(text, '.')) + 1)) - 1 AS pos, unnest(string_split(text, '.')) AS c FROM documents WHERE text IS NOT NULL)) WHERE t <> '')) GROUP BY ALL""".replace("{t}", _wide("c")).replace("{a}", _wide(r"regexp_extract(t, '(?i)^(.+?)\s+and\s+(.+)$', 1)")).replace("{b}", _wide(r"regexp_extract(t, '(?i)^(.+?)\s+and\s+(.+)$', 2)")).replace("{whole}", _ONE_THING))
def decompose_things(spark: SparkSession, sf: str) -> DataFrame:
    """How often each clause and side occurs when names that are one thing stay whole."""
    d = table(spark, sf, "documents").where("text IS NOT NULL").select(F.posexplode(F.split("text", r"\.")).alias("pos", "c"))
    d = d.select(F.col("pos").cast("long").alias("pos"), N.strip(F.col("c")).alias("t")).where("t <> ''")
    return d.select("pos", F.explode(extract.split_conjunction(F.col("t"))).alias("part")).groupBy("pos", "part").agg(F.count(F.lit(1)).alias("n"))


@query(r"""SELECT DISTINCT e AS evidence FROM (SELECT {t} AS e FROM results WHERE evidence_text IS NOT NULL) WHERE contains(e, '_') OR (len(list_filter(regexp_split_to_array(e, '\s+'), lambda w: w <> '')) > 4 AND e = lower(e))
 OR regexp_matches(lower(e), '^(the study|this experiment|this research|our study|the paper|this paper|the trial|this trial)') OR regexp_matches(lower(e), '(the study|this experiment|this research|our study|the paper|this paper|the trial|this trial)$')""".replace("{t}", _wide("evidence_text")))
def framed_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence that reads like a made-up label or starts or ends with a framing phrase."""
    e = table(spark, sf, "results").where("evidence_text IS NOT NULL").select(N.strip(F.col("evidence_text")).alias("evidence"))
    return e.where(N.looks_synthetic(F.col("evidence"))).distinct()
