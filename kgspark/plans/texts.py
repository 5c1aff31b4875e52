"""Documents, chunks, alignment, extraction, sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import streaming
from ..functions import names as N
from ..operators import align, extract, text
from ..session import ensure_checkpoint_dir, table
from ..sources import articles as src
from . import SQL, query
from . import sqltext as S


@query("SELECT document_id, concat_ws(chr(10) || chr(10), nullif(abstract_text, ''), nullif(body_text, '')) AS text FROM articles")
def built_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Text of each article's document: abstract and body."""
    return src.to_documents(table(spark, sf, "articles")).select("document_id", "text")


_HAS = "list_filter(sections, lambda s: regexp_matches(lower(s.section_key), '{w}'))"
_TEXTS = "nullif(array_to_string(list_transform({s}, lambda s: s.section_text), chr(10) || chr(10)), '')"
_METHODS = _TEXTS.format(s=_HAS.format(w="|".join(src.PHASE_WORDS["methods"])))
_OTHERS = _TEXTS.format(s="list_filter(sections, lambda s: NOT regexp_matches(lower(s.section_key), '" + "|".join(src.NOT_METHODS) + "'))")
_RESULTS = _TEXTS.format(s=_HAS.format(w="|".join(src.PHASE_WORDS["results"])))


@query(f"""SELECT document_id, 'gate' AS phase, coalesce(nullif(abstract_text, ''), substr(body_text, 1, 2000), '') AS phase_text FROM articles
UNION ALL SELECT document_id, 'methods', coalesce({_METHODS}, {_OTHERS}, body_text, '') FROM articles UNION ALL SELECT document_id, 'results', coalesce({_RESULTS}, body_text, '') FROM articles""")
def phase_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Text that each phase of extraction reads."""
    a = table(spark, sf, "articles")
    out = None
    for phase in ("gate", "methods", "results"):
        p = src.phase_text(a, phase).select("document_id", F.lit(phase).alias("phase"), "phase_text")
        out = p if out is None else out.unionByName(p)
    return out


@query(r"SELECT doc_id, len(w) AS n_words, len(list_distinct(w)) AS n_distinct FROM (SELECT doc_id, list_transform(regexp_extract_all(text, '\p{L}+|\p{Nd}+'), lambda x: lower(x)) AS w FROM documents WHERE text IS NOT NULL)")
def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Words and distinct words of each document."""
    w = text.words(F.col("text"))
    return table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", F.size(w).alias("n_words"), F.size(F.array_distinct(w)).alias("n_distinct"))


@query(r"SELECT CASE WHEN length(w) > 3 AND right(w, 1) = 's' AND right(w, 2) <> 'ss' THEN left(w, length(w) - 1) ELSE w END AS stem, count(*) AS n FROM (SELECT lower(unnest(regexp_extract_all(text, '\p{L}+|\p{Nd}+'))) AS w FROM documents) GROUP BY 1")
def stem_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How often each stem occurs."""
    w = table(spark, sf, "documents").select(F.explode(text.words(F.col("text"))).alias("w"))
    return w.groupBy(text.stem(F.col("w")).alias("stem")).agg(F.count(F.lit(1)).alias("n"))


# a token is a run of characters of one group: letters and marks (joiners are among them), digits, or one same symbol
_GROUPS = r"""CASE WHEN regexp_matches(c, '^\p{Nd}$') THEN 'N' WHEN regexp_matches(c, '^(\p{L}|\p{M}|\p{Nl}|[\x{200c}\x{200d}])$') THEN 'W'
 WHEN regexp_matches(c, '^[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]$') THEN NULL ELSE 'S' || c END"""


@query(f"""WITH d AS (SELECT doc_id, regexp_extract_all(text, '(?s).') AS cs FROM documents WHERE text IS NOT NULL),
k AS (SELECT doc_id, pos, c, {_GROUPS} AS g FROM (SELECT doc_id, unnest(range(0, len(cs))) AS pos, unnest(cs) AS c FROM d)),
b AS (SELECT *, CASE WHEN pos > 0 AND g IS NOT DISTINCT FROM lag(g) OVER w THEN 0 ELSE 1 END AS fresh, count_if(c IN (chr(10), chr(13))) OVER w AS lines FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM b),
t AS (SELECT doc_id, run, min(pos) AS s, max(pos) + 1 AS e, any_value(g) AS g, min(lines) AS lines, string_agg(c, '' ORDER BY pos) AS token FROM r WHERE g IS NOT NULL GROUP BY ALL)
SELECT doc_id, row_number() OVER w - 1 AS token_idx, CASE g WHEN 'W' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS token_type, s AS start_pos, e AS end_pos, lines > coalesce(lag(lines) OVER w, 0) AS after_newline, token FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY s)""")
def tokens(spark: SparkSession, sf: str) -> DataFrame:
    """All tokens of the documents with their places."""
    return text.tokenize(table(spark, sf, "documents"), ["doc_id"], "text")


@query()
def graphemes(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens by user-perceived character, of the documents."""
    return text.graphemes(table(spark, sf, "documents"), ["doc_id"], "text")


_ABBREVIATIONS = "'Mr.', 'Mrs.', 'Ms.', 'Dr.', 'Prof.', 'St.'"


@query(f"""WITH t AS ({SQL['tokens']}), u AS (SELECT *, lag(token) OVER w AS before, lead(token) OVER w AS after, token_type = 2 AND token IN ('.', '?', '!', '。', '！', '？', '।') AS closing FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY token_idx)),
v AS (SELECT *, closing AND NOT (token = '.' AND coalesce(before || '.', '') IN ({_ABBREVIATIONS})) AS ends, NOT closing AND after_newline AND regexp_matches(coalesce(after[1], ''), '^\\p{{Lu}}$') AS breaks FROM u),
s AS (SELECT *, CASE WHEN token_idx = 0 OR breaks OR lag(ends OR breaks) OVER (PARTITION BY doc_id ORDER BY token_idx) THEN 1 ELSE 0 END AS first FROM v),
n AS (SELECT *, sum(first) OVER (PARTITION BY doc_id ORDER BY token_idx) - 1 AS i FROM s)
SELECT doc_id, i::BIGINT AS sentence_idx, min(token_idx) AS token_start, max(token_idx) + 1 AS token_end, min(start_pos) AS start_pos, max(end_pos) AS end_pos, substr(any_value(text), min(start_pos) + 1, max(end_pos) - min(start_pos)) AS sentence FROM n JOIN documents USING (doc_id) GROUP BY doc_id, i""")
def sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences of the documents."""
    return text.split_sentences(table(spark, sf, "documents"), ["doc_id"], "text")


@query()
def chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of at most 1000 characters of the articles' bodies."""
    return text.chunk(table(spark, sf, "articles"), ["document_id"], "body_text", 1000)


_SECTIONS = "s AS (SELECT document_id, pos - 1 AS pos, sections[pos].section_text AS section_text FROM (SELECT document_id, sections, unnest(range(1, len(sections) + 1)) AS pos FROM articles))"


def _sections(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "articles").select("document_id", F.posexplode("sections").alias("pos", "s")).select("document_id", F.col("pos").cast("long").alias("pos"), F.col("s.section_text").alias("section_text"))


@query(f"WITH {_SECTIONS}, l AS (SELECT document_id, pos, lag(section_text) OVER (PARTITION BY document_id ORDER BY pos) AS b FROM s) SELECT document_id, pos, CASE WHEN b IS NULL THEN '' ELSE '[Previous text]: ...' || right(b, 50) END AS prompt_context FROM l")
def previous_context(spark: SparkSession, sf: str) -> DataFrame:
    """End of the section before, as context of the next prompt."""
    return text.previous_context(_sections(spark, sf), "document_id", "pos", "section_text", 50).select("document_id", "pos", "prompt_context")


@query(f"WITH {_SECTIONS} SELECT document_id, pos, ((row_number() OVER (PARTITION BY document_id ORDER BY pos) - 1) // 2)::BIGINT AS batch_idx FROM s")
def batching(spark: SparkSession, sf: str) -> DataFrame:
    """Sections in batches of two."""
    return text.batches(_sections(spark, sf), ["document_id"], ["pos"], 2).select("document_id", "pos", "batch_idx")


@query("SELECT doc_id, CASE WHEN topic <> '' THEN strpos(lower(text), lower(topic)) - 1 ELSE -1 END AS start_pos FROM documents")
def exact_align(spark: SparkSession, sf: str) -> DataFrame:
    """Where a document names its topic, any case, in the JVM."""
    return table(spark, sf, "documents").select("doc_id", align.exact_position(F.col("topic"), F.col("text")).cast("long").alias("start_pos"))


@query("SELECT doc_id, CASE WHEN p > 0 THEN substr(text, greatest(p - 300, 1), p + length(topic) + 299 - greatest(p - 300, 1) + 1) ELSE '' END AS evidence FROM (SELECT doc_id, text, topic, CASE WHEN topic <> '' THEN strpos(lower(text), lower(topic)) END AS p FROM documents)")
def raw_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """The 300 characters around that place."""
    d = table(spark, sf, "documents").select("doc_id", "text", "topic", align.exact_position(F.col("topic"), F.col("text")).alias("p"))
    start = F.when(F.col("p") >= 0, F.col("p"))
    return d.select("doc_id", align.raw_evidence(F.col("text"), start, start + F.char_length("topic")).alias("evidence"))


@query()
def alignments(spark: SparkSession, sf: str) -> DataFrame:
    """Substance mentions aligned to their article by the cascade, with evidence and location."""
    docs = src.to_documents(table(spark, sf, "articles"))
    return align.align(table(spark, sf, "alternatives"), docs, document="document_id", mention="standard_name", text="text", keep=["alternative_id"])


_IV = "iv AS (SELECT indicator_id, document_id, indicator_id % 50 AS s, indicator_id % 50 + coalesce(length(abbreviation), 0) + 2 AS e FROM indicators)"


@query(f"WITH {_IV} SELECT indicator_id FROM iv a WHERE indicator_id % 2 = 0 OR NOT EXISTS (FROM iv b WHERE b.indicator_id % 2 = 0 AND a.document_id = b.document_id AND a.s < b.e AND b.s < a.e)")
def merged_passes(spark: SparkSession, sf: str) -> DataFrame:
    """Union of two passes: rows of the second that overlap one of the first are left out."""
    i = table(spark, sf, "indicators").select("indicator_id", "document_id", (F.col("indicator_id") % 50).alias("s"))
    i = i.join(table(spark, sf, "indicators").select("indicator_id", (F.coalesce(F.char_length("abbreviation"), F.lit(0)) + 2).alias("n")), "indicator_id").withColumn("e", F.col("s") + F.col("n"))
    return align.merge_passes([i.where("indicator_id % 2 = 0"), i.where("indicator_id % 2 <> 0")], "document_id", "indicator_id", "s", "e").select("indicator_id")


@query("SELECT DISTINCT result_id, indicator_abbreviation AS mention, direction, relation_type FROM results WHERE indicator_abbreviation IS NOT NULL")
def parsed_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Model outputs in fences, behind a thought, parsed in the JVM."""
    item = F.struct(F.col("indicator_abbreviation").alias("Result"), F.struct("direction", "relation_type").alias("Result_attributes"))
    output = F.concat(F.lit("<think>so</think>\n```json\n"), F.to_json(F.struct(F.array(item).alias("extractions"))), F.lit("\n```"))
    r = table(spark, sf, "results").select("result_id", "indicator_abbreviation", "direction", "relation_type").distinct()
    found = r.select("result_id", F.explode(extract.resolve_simple(output, "Result")).alias("m"))
    return found.select("result_id", F.col("m.text").alias("mention"), F.col("m.attributes")["direction"].alias("direction"), F.col("m.attributes")["relation_type"].alias("relation_type"))


def _dictionary(names: DataFrame, most: int = 10_000) -> list[str]:
    """The distinct names that aren't blank, sorted; more than ``most`` are refused."""
    out = [r["s"] for r in names.where("s <> ''").distinct().orderBy("s").limit(most + 1).collect()]
    if len(out) > most:
        raise ValueError(f"more than {most} names")
    return out


@query()
def extracted(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks through an offline extractor, its answers parsed and resolved."""
    names = _dictionary(table(spark, sf, "tissue_sites").select(F.lower(N.strip(F.col("site_name"))).alias("s")))
    asked = extract.extract(chunks(spark, sf), ["document_id", "chunk_idx"], "chunk_text", lambda: extract.DictionaryExtractor({"Tissue_Site": names}))
    return extract.resolve_outputs(asked, ["document_id", "chunk_idx"], "output").where("extraction_class IS NOT NULL").select("document_id", "chunk_idx", "ext_ord", "extraction_class", "extraction_text")


@query("SELECT doc_id, substr(sha256(concat_ws('|', 'offline', 'extract', text, 't=0')), 1, 16) AS cache_key FROM documents")
def cache_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Key of each prompt's cached answer."""
    return table(spark, sf, "documents").select("doc_id", extract.cache_key(F.lit("offline"), F.lit("extract"), F.col("text"), F.lit("t=0")).alias("cache_key"))


@query("SELECT document_id FROM articles WHERE document_id NOT IN (SELECT document_id FROM alternatives WHERE document_id IS NOT NULL)")
def unprocessed(spark: SparkSession, sf: str) -> DataFrame:
    """Articles still to process: those without a result of an earlier run."""
    return src.unprocessed(table(spark, sf, "articles").select("document_id"), table(spark, sf, "alternatives").where("document_id IS NOT NULL"))


@query(f"""SELECT document_id, lower({S.strip('standard_name')}) AS k FROM alternatives WHERE {S.strip('standard_name')} <> '' INTERSECT SELECT document_id, lower({S.strip('intervention_target')}) FROM interventions""")
def shared_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names that are both a substance and a target in a document."""
    key = lambda c: F.lower(N.strip(F.col(c))).alias("k")
    a = table(spark, sf, "alternatives").select("document_id", key("standard_name")).where("k <> ''")
    return a.intersect(table(spark, sf, "interventions").select("document_id", key("intervention_target")))


@query("SELECT event_type, strftime(ts, '%Y-%m-%d %H') AS hour, count(*) AS n FROM (SELECT DISTINCT event_id, event_type, ts FROM events) GROUP BY ALL")
def streamed_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Events counted per hour and type from a stream of files, micro-batch by micro-batch."""
    import uuid

    ensure_checkpoint_dir(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    once = streaming.once_each(stream.withColumn("ts", F.col("ts").cast("timestamp")), "event_id", "ts", "3650 days")
    count = lambda df: df.groupBy("event_type", F.date_format("ts", "yyyy-MM-dd HH").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    streaming.run_batches(once, count, f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("event_type", "hour").agg(F.sum("n").alias("n"))
