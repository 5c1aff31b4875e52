"""Building the property graph: nodes, class nodes, merged nodes, edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import global_id, graph_name, nonblank
from ..session import checkpointed
from .similarity import contains_join


def nodes(mentions: DataFrame, *, document: str, cls: str, name: str, attributes: str, order: str, global_types: Sequence[str], key: str | None = None) -> DataFrame:
    """(id, label, name, properties, source_pmids): one node per identity, which is ``key`` (else the name).

    Every property is the first stated value in order; documents are a sorted set. Properties are picked by (id, key),
    so no node's mentions are gathered in one task. Mentions with a blank name make no node.
    """
    m = mentions.where(nonblank(F.col(name)).isNotNull()).withColumn("id", global_id(F.col(cls), F.col(key or name), F.col(document), global_types))
    head = m.groupBy("id").agg(F.min_by(F.col(cls), F.col(order)).alias("label"), F.min_by(F.col(name), F.col(order)).alias("name"))
    one = m.select("id", F.col(order).alias("o"), F.explode(attributes).alias("k", "v")).where(nonblank(F.col("v")).isNotNull()).groupBy("id", "k").agg(F.min_by("v", "o").alias("v"))
    props = one.groupBy("id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("properties"))
    docs = m.select("id", document).where(F.col(document).isNotNull()).distinct().groupBy("id").agg(F.array_sort(F.collect_list(document)).alias("source_pmids"))
    return head.join(props, "id", "left").join(docs, "id", "left")


def edges(references: DataFrame, *, source: str, target: str, kind: str, document: str, evidence: str, order: str) -> DataFrame:
    """(source_id, target_id, type, evidence, source_pmids): one edge per pair and type; first evidence, all documents."""
    r = references.where(F.col(source).isNotNull() & F.col(target).isNotNull())
    keys = [F.col(source).alias("source_id"), F.col(target).alias("target_id"), F.col(kind).alias("type")]
    first = r.groupBy(*keys).agg(F.min_by(F.col(evidence), F.when(F.col(evidence).isNotNull(), F.col(order))).alias("evidence"))
    docs = r.select(*keys, F.col(document).alias("d")).where("d IS NOT NULL").distinct().groupBy("source_id", "target_id", "type").agg(F.array_sort(F.collect_list("d")).alias("source_pmids"))
    return first.join(docs, ["source_id", "target_id", "type"], "left")


def _class_id(name: str) -> Column:
    return global_id(F.lit("Alternative_Class"), F.col(name), F.lit(None).cast("string"), ["Alternative_Class"])


def class_nodes(rows: DataFrame, cls: str, subclass: str) -> DataFrame:
    """One node per class, with its first subclass in alphabetical order."""
    r = rows.where(nonblank(F.col(cls)).isNotNull())
    return r.groupBy(F.col(cls).alias("name")).agg(F.min(subclass).alias("subclass")).select(_class_id("name").alias("id"), F.lit("Alternative_Class").alias("label"), "name", "subclass")


def class_documents(members: DataFrame, cls: str, document: str) -> DataFrame:
    """(id, source_pmids): the documents in which each class has members, as a sorted set."""
    r = members.where(nonblank(F.col(cls)).isNotNull() & F.col(document).isNotNull()).select(_class_id(cls).alias("id"), F.col(document).alias("d")).distinct()
    return r.groupBy("id").agg(F.array_sort(F.collect_list("d")).alias("source_pmids"))


def belongs_to(members: DataFrame, *, ident: str, cls: str) -> DataFrame:
    """Edges from members to their class nodes."""
    return members.where(nonblank(F.col(cls)).isNotNull()).select(F.col(ident).alias("source_id"), _class_id(cls).alias("target_id"), F.lit("belongs_to").alias("type")).distinct()


def merge_map(graph_nodes: DataFrame, *, ident: str, label: str, name: str, abbreviation: str, full: str) -> DataFrame:
    """(id, into): nodes whose name is another node's abbreviation, else its full name, and the root they go to.

    A node may be merged into one that is itself merged, or two into each other; the map is closed by following it in
    doubling steps, and a cycle goes to its least id. Each step is a self-join of the map, which holds merged nodes only.
    """
    n = graph_nodes.select(F.col(ident).alias("id"), F.col(label).alias("l"), graph_name(F.col(name)).alias("n"), graph_name(F.col(abbreviation)).alias("a"), graph_name(F.col(full)).alias("f"))
    keys = n.select("l", F.col("id").alias("into"), F.explode(F.array(F.struct(F.lit(0).alias("way"), F.col("a").alias("n")), F.struct(F.lit(1).alias("way"), F.col("f").alias("n")))).alias("k"))
    keys = keys.select("l", "into", "k.way", "k.n").where("n <> ''").groupBy("l", "n").agg(F.min(F.struct("way", "into")).alias("b"))
    step = n.where("n <> ''").join(keys, ["l", "n"]).select("id", F.col("b.into").alias("into")).where("id <> into")
    state = checkpointed(step.withColumn("least", F.least("id", "into")))
    while True:
        far = state.select(F.col("id").alias("into"), F.col("into").alias("next"), F.col("least").alias("least2"))
        new = checkpointed(state.join(far, "into", "left").select("id", F.coalesce("next", "into").alias("into"), F.least("least", F.coalesce("least2", "least")).alias("least")))
        changed = new.join(state.select("id", F.col("into").alias("i2"), F.col("least").alias("l2")), "id").where("into <> i2 OR least <> l2")
        cyclic = new.join(new.select(F.col("id").alias("into")), "into", "left_semi").select("id")
        if changed.where("least <> l2").isEmpty() and (cyclic.isEmpty() or changed.isEmpty() or changed.join(cyclic, "id", "left_anti").isEmpty()):
            break
        state = new
    loops = cyclic.withColumn("c", F.lit(True))
    return new.join(loops, "id", "left").select("id", F.when(F.col("c"), F.col("least")).otherwise(F.col("into")).alias("into")).where("id <> into")


def merge_nodes(graph_nodes: DataFrame, merged: DataFrame) -> DataFrame:
    """The nodes that stay (id, label, name, properties, source_pmids): what they lack is filled from the nodes merged
    into them, the one with the least id first, and the documents of all are theirs."""
    n = graph_nodes.join(merged, "id", "left").withColumn("root", F.coalesce("into", "id"))
    given = n.select("root", (F.col("id") != F.col("root")).alias("other"), "id", F.explode("properties").alias("k", "v")).where(nonblank(F.col("v")).isNotNull())
    one = given.groupBy("root", "k").agg(F.min_by("v", F.struct("other", "id")).alias("v"))
    props = one.groupBy("root").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("properties"))
    docs = n.select("root", F.explode("source_pmids").alias("d")).distinct().groupBy("root").agg(F.array_sort(F.collect_list("d")).alias("source_pmids"))
    stay = n.where("into IS NULL").select("root", "label", "name")
    return stay.join(props, "root", "left").join(docs, "root", "left").withColumnRenamed("root", "id").select("id", "label", "name", "properties", "source_pmids")


def detect_by_name(records: DataFrame, graph_nodes: DataFrame, *, ident: str, text: str, target: str, label: str = "label", name: str = "name", node: str = "id", global_types: Sequence[str] = ()) -> DataFrame:
    """(ident, node, way): the node that a record's text names: 1 a node of the class ``target`` by name, 2 of any class
    of ``global_types``, 3 a node of ``target`` whose name contains the text or lies in it (3 letters at least); of the
    best way the least id. All are equi-joins, on names and on grams."""
    r = records.select(F.col(ident).alias("__i"), F.col(target).alias("__c"), graph_name(F.col(text)).alias("__t")).where("__t <> ''")
    n = graph_nodes.select(F.col(label).alias("__c"), graph_name(F.col(name)).alias("__n"), F.col(node).alias("__id")).where("__n <> ''")
    keyed = n.groupBy("__c", "__n").agg(F.min("__id").alias("__id"))
    typed = r.join(keyed.withColumnRenamed("__n", "__t"), ["__c", "__t"]).select("__i", F.lit(1).alias("way"), "__id")
    shared = keyed.where(F.col("__c").isin(*global_types)).groupBy(F.col("__n").alias("__t")).agg(F.min("__id").alias("__id"))
    cross = r.join(shared, "__t").select("__i", F.lit(2).alias("way"), "__id")
    left = r.join(typed.unionByName(cross).select("__i"), "__i", "left_anti").where(F.char_length("__t") >= 3)
    inside = contains_join(left, keyed.where(F.char_length("__n") >= 3), ["__c"], "__t", "__n").select("__i", F.lit(3).alias("way"), "__id")
    hits = typed.unionByName(cross).unionByName(inside).groupBy("__i").agg(F.min(F.struct("way", "__id")).alias("b"))
    return hits.select(F.col("__i").alias(ident), F.col("b.__id").alias("target_id"), "b.way")


def with_source_evidence(graph_edges: DataFrame, evidence: DataFrame) -> DataFrame:
    """Edges whose missing evidence is that of their source node; ``evidence`` is (id, evidence), one row per node."""
    e = evidence.select(F.col("id").alias("source_id"), F.col("evidence").alias("__e"))
    return graph_edges.join(e, "source_id", "left").withColumn("evidence", F.coalesce(nonblank(F.col("evidence")), "__e")).drop("__e").select(*graph_edges.columns)


def remap(graph_edges: DataFrame, merged: DataFrame) -> DataFrame:
    """Edges between the nodes that stay: ends replaced, self-loops dropped, equal edges once."""
    a = merged.select(F.col("id").alias("source_id"), F.col("into").alias("__s"))
    b = merged.select(F.col("id").alias("target_id"), F.col("into").alias("__t"))
    out = graph_edges.join(a, "source_id", "left").join(b, "target_id", "left")
    out = out.select(F.coalesce("__s", "source_id").alias("source_id"), F.coalesce("__t", "target_id").alias("target_id"), "type", *[c for c in graph_edges.columns if c not in ("source_id", "target_id", "type")])
    return out.where("source_id <> target_id").dropDuplicates(["source_id", "target_id", "type"])


def dangling_edges(graph_edges: DataFrame, graph_nodes: DataFrame, ident: str = "id") -> DataFrame:
    """Edges with an end that is no node."""
    n = graph_nodes.select(ident)
    ok = graph_edges.join(n.withColumnRenamed(ident, "source_id"), "source_id", "left_semi").join(n.withColumnRenamed(ident, "target_id"), "target_id", "left_semi")
    return graph_edges.join(ok.select("source_id", "target_id", "type").distinct(), ["source_id", "target_id", "type"], "left_anti")

