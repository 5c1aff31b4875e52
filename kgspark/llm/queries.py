"""The queries of the llm problems over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import HOT_ROWS, hot_keys
from ..session import checkpointed, table
from . import lists
from .canonical import map_to_canonical
from .components import group_matches
from .lookalikes import bigram_scores, consistent_forms, look_alike_classes, look_alike_pairs
from .mixing import marginals, mix, shares
from .packing import fill_report, pack
from .splitting import oversized_items, split_items
from .survivors import choose_bundles, stated
from .tokens import with_token_counts

# Fields of a node that depend on one another and are taken from one row together.
BUNDLES = {
    "standard_name": "identity", "abbreviation": "identity", "cas_number": "identity", "source_organism": "identity",
    "dose_value": "dose", "dose_unit_original": "dose", "site_name": "site", "site_category": "site",
    "unit": "measure", "measurement_method": "measure", "method_name": "method", "description": "method",
}
#: In one node the abbreviation fixes the unit, and the class what is known of its origin.
DEPENDENCIES = (("abbreviation", "unit"), ("standard_name", "classification"))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Group of every record linked to another by matches."""
    return group_matches(table(spark, sf, "match_pairs"), "left_id", "right_id", scope="entity_type")


def p1_group_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """How many groups there are of each size."""
    sizes = p1_found(spark, sf).groupBy("entity_type", "group_id").agg(F.count(F.lit(1)).alias("n_records"))
    return sizes.groupBy("entity_type", "n_records").agg(F.count(F.lit(1)).alias("n_groups"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Entry of each freely typed direction, relation type and substance name."""
    matchers, entries = lists.value_matchers(table(spark, sf, "canonical_values"))
    matchers["standard_name"], entries["standard_name"] = lists.vocabulary_matcher(table(spark, sf, "vocabulary"))
    fields = F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in ("direction", "relation_type"))))
    typed = table(spark, sf, "results").select(F.col("result_id").alias("id"), fields.alias("v")).select("id", "v.field_name", "v.value")
    names = table(spark, sf, "alternatives").select(F.col("alternative_id").alias("id"), F.lit("standard_name").alias("field_name"), F.col("standard_name").alias("value"))
    return map_to_canonical(typed.unionByName(names), record="id", field="field_name", value="value", matchers=matchers, entries=entries)


def p2_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """How many values of each field have an entry and how many have none."""
    return p2_found(spark, sf).groupBy("field_name", (F.col("entry") == "UNMATCHED").alias("unmatched")).agg(F.count(F.lit(1)).alias("n_records"))


def _met(rows: DataFrame, hot: DataFrame | None) -> DataFrame:
    """The rows of an id in one partition.

    Of a ``hot`` id's rows that state the same properties, are trusted alike and have as many sources, only the last can
    be chosen, so the others stay where they are, but for the least and greatest row id, which tell whether there are
    several.
    """
    rows = rows.where("id IS NOT NULL AND row_id IS NOT NULL")
    if hot is None:
        return rows.repartition("id")
    hot = F.broadcast(hot)
    alike = rows.join(hot, "id", "left_semi").groupBy("id", "trust", F.array_sort("names").alias("names"), "n").agg(F.max(F.struct("updated_at", "row_id")).alias("last"), F.min("row_id").alias("low"), F.max("row_id").alias("high"))
    row = lambda r, at, names, n: F.struct(F.col(r).alias("row_id"), at.alias("updated_at"), names.cast("array<string>").alias("names"), n.cast("int").alias("n"))
    bare = (row(r, F.when(F.lit(False), F.col("last.updated_at")), F.lit(None), F.lit(0)) for r in ("low", "high"))
    few = alike.select("id", "trust", F.explode(F.array(row("last.row_id", F.col("last.updated_at"), F.col("names"), F.col("n")), *bare)).alias("r")).select("id", "trust", "r.*")
    return rows.join(hot, "id", "left_anti").unionByName(few).repartition("id")


def _offers(spark: SparkSession, sf: str, bundles: dict[str, str] | None, hot_rows: int = HOT_ROWS // 10) -> DataFrame:
    """(id, row_id, bundle, m0..m3, vals): what each row offers of each bundle, in one pass over the nodes.

    source_pmids is a bundle too; a list of sources counts by its length first, anything else by trust, then by
    completeness. A null bundle stands for the row itself. Without ``bundles`` an id's rows share a partition; an id
    with ``hot_rows`` rows or more offers only what can be chosen.
    """
    # trust is a fixed table of a few rows
    trust = table(spark, sf, "source_trust").groupBy("source").agg((-F.min("trust_rank")).alias("trust"))
    base = table(spark, sf, "graph_nodes").select("id", "row_id", "source", "updated_at", "properties", "source_pmids").join(F.broadcast(trust), "source", "left")
    pmids = F.coalesce(F.size(F.array_distinct(F.filter(F.transform("source_pmids", lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", "")), lambda p: p != ""))), F.lit(0))
    given = F.map_filter("properties", lambda k, v: stated(v))
    offer = lambda b, m0, m2, vals: F.struct(b.alias("bundle"), m0.cast("int").alias("m0"), m2.cast("int").alias("m2"), vals.cast("map<string,string>").alias("vals"))
    none = F.lit(None)
    if bundles is None:
        props = F.transform("names", lambda k: offer(F.concat(F.lit("="), k), F.lit(0), F.lit(0), none))
    else:
        of = F.create_map(*(F.lit(x) for kv in bundles.items() for x in kv))
        named = lambda k: F.coalesce(F.element_at(of, k), k)
        fields = lambda b: F.map_filter("given", lambda k, v: named(k) == b)
        props = F.transform(F.array_distinct(F.transform(F.map_keys("given"), named)), lambda b: offer(F.concat(F.lit("="), b), F.lit(0), F.size(fields(b)), fields(b)))
    lists_ = F.when(F.col("n") > 0, F.array(offer(F.lit("source_pmids"), F.col("n"), F.lit(0), none)))
    row = F.array(offer(none.cast("string"), F.lit(0), F.lit(0), none))
    empty = F.filter(row, lambda x: F.lit(False))
    rows = base.withColumns({"given": given, "n": pmids})
    if bundles is None:  # rows meet by id before they are spread over bundles
        rows = _met(rows.select("id", "row_id", "trust", "updated_at", F.map_keys("given").alias("names"), "n"), hot_keys(table(spark, sf, "graph_nodes"), ["id"], hot_rows))
    long = rows.select("id", "row_id", "trust", "updated_at", F.explode(F.concat(row, F.coalesce(props, empty), F.coalesce(lists_, empty))).alias("o"))
    return long.select("id", "row_id", "o.bundle", "o.vals", "o.m0", F.col("trust").alias("m1"), "o.m2", F.col("updated_at").alias("m3"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Row that supplies each property of a node given by several rows; every property is a bundle of its own."""
    chosen = choose_bundles(_offers(spark, sf, None), group="id", row="row_id", bundle="bundle", merit=["m0", "m1", "m2", "m3"], several=True)
    return chosen.select("id", F.regexp_replace("bundle", "^=", "").alias("property_name"), "row_id")


def p3_bundles(spark: SparkSession, sf: str) -> DataFrame:
    """Surviving nodes with dependent fields taken from one row together, under the dependencies between bundles."""
    chosen = choose_bundles(_offers(spark, sf, BUNDLES), group="id", row="row_id", bundle="bundle", merit=["m0", "m1", "m2", "m3"], values="vals", dependencies=DEPENDENCIES, several=True)
    return chosen.select("id", F.regexp_replace("bundle", "^=", "").alias("bundle"), "row_id")


def _items(spark: SparkSession, sf: str) -> dict:
    articles, limits = table(spark, sf, "articles"), table(spark, sf, "size_limits")
    body = articles.select("document_id", F.lit("articles.body_text").alias("item_kind"), F.lit(-1).cast("long").alias("item_pos"), F.col("body_text").alias("text"))
    parts = articles.select("document_id", F.lit("articles.sections").alias("item_kind"), F.posexplode("sections").alias("p", "s"))
    parts = parts.select("document_id", "item_kind", F.col("p").cast("long").alias("item_pos"), F.col("s.section_text").alias("text"))
    # the limits are a fixed table of a few rows
    items = body.unionByName(parts).where("text IS NOT NULL").join(F.broadcast(limits.select("item_kind", "max_size", "overlap_size").dropDuplicates(["item_kind"])), "item_kind")
    return {"items": items, "keys": ["document_id", "item_kind", "item_pos"], "text": "text", "limit": F.col("max_size"), "overlap": F.col("overlap_size")}


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Items above their limit and whether a stretch without a boundary forces a cut."""
    return oversized_items(**_items(spark, sf)).select("document_id", "item_kind", "item_pos", "cut_kind")


def p5_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """All pieces of the items above their limit, with their texts."""
    return split_items(**_items(spark, sf))


def _sized(spark: SparkSession, sf: str, keep: list[str]) -> DataFrame:
    """Documents' sizes in tokens, counted once and kept."""
    return checkpointed(with_token_counts(table(spark, sf, "documents"), "text", keep))


def _capacity(spark: SparkSession, sf: str) -> int:
    return table(spark, sf, "size_limits").where("item_kind = 'documents.text'").select("max_size").first()["max_size"]


def p6_packed(spark: SparkSession, sf: str) -> DataFrame:
    """Training sequence and place of every document or part of one."""
    docs = _sized(spark, sf, ["doc_id"])
    return pack(docs, key="doc_id", size="n_tokens", capacity=_capacity(spark, sf))


def p6_fill(spark: SparkSession, sf: str) -> DataFrame:
    """How full the sequences are."""
    return fill_report(p6_packed(spark, sf), _capacity(spark, sf))


def p7_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of the mixture and how often each is in it."""
    docs = _sized(spark, sf, ["doc_id", "source", "lang", "topic"])
    return mix(docs, table(spark, sf, "mix_targets"), key="doc_id", size="n_tokens", others=["lang", "topic"]).where("copies > 0")


def p7_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target and reached share of each source."""
    docs, targets = _sized(spark, sf, ["doc_id", "source", "lang", "topic"]), table(spark, sf, "mix_targets")
    return shares(mix(docs, targets, key="doc_id", size="n_tokens", others=["lang", "topic"]), targets, "n_tokens")


def p7_marginals(spark: SparkSession, sf: str) -> DataFrame:
    """Wanted and reached share of each language and topic."""
    docs = _sized(spark, sf, ["doc_id", "source", "lang", "topic"])
    mixture = mix(docs, table(spark, sf, "mix_targets"), key="doc_id", size="n_tokens", others=["lang", "topic"])
    return marginals(mixture, docs, "doc_id", "n_tokens", ["lang", "topic"])


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of documents whose different texts look the same."""
    pairs = look_alike_pairs(table(spark, sf, "documents"), "doc_id", "text")
    return pairs.select(F.col("a").alias("doc_id_a"), F.col("b").alias("doc_id_b"))


def p8_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Class of every document whose look another document has in different characters, and how many have."""
    return look_alike_classes(table(spark, sf, "documents"), "doc_id", "text").select(F.col("k").alias("doc_id"), "class_id", "n_links")


def p8_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's text in its consistent form."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return consistent_forms(docs, "text", "form", bigram_scores(docs, "text")).select("doc_id", "form", (F.col("form") != F.col("text")).alias("changed"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_group_sizes, p2_found, p2_unmatched, p3_found, p3_bundles, p5_found, p5_pieces, p6_packed, p6_fill, p7_mixture, p7_shares, p7_marginals, p8_found, p8_classes, p8_forms)}
