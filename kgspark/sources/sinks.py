"""Writers and the tables they write: review tables, graph files, manifest, report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_line(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+", " ")


def review_table(mentions: DataFrame, fixed: Sequence[str], attributes: str, fields: Sequence[str]) -> DataFrame:
    """Fixed columns, the schema's attributes in its order, then the other attributes as one JSON column."""
    extra = F.map_filter(attributes, lambda k, v: ~k.isin(*fields))
    return mentions.select(*fixed, *(one_line(F.col(attributes)[f]).alias(f) for f in fields), F.when(F.size(extra) > 0, F.to_json(extra)).alias("other_attributes"))


def neo4j_nodes(nodes: DataFrame, properties: Sequence[str]) -> DataFrame:
    return nodes.select(F.col("id").alias("entity_id:ID"), F.col("label").alias("entity_type:LABEL"), "name", *(one_line(F.col("properties")[p]).alias(p) for p in properties), F.array_join("source_pmids", "|").alias("source_pmids"))


def neo4j_edges(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("source_id").alias(":START_ID"), F.col("target_id").alias(":END_ID"), F.col("type").alias(":TYPE"), one_line(F.col("evidence")).alias("evidence"), F.array_join("source_pmids", "|").alias("source_pmids"))


def property_names(nodes: DataFrame, most: int = 1000) -> list[str]:
    """The properties that occur, sorted; their number is that of the schema, and more than ``most`` are refused."""
    names = [r["k"] for r in nodes.select(F.explode(F.map_keys("properties")).alias("k")).distinct().orderBy("k").limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} properties")
    return names


def manifest(documents: DataFrame, literature: DataFrame, document: str, order: str, fields: Sequence[str]) -> DataFrame:
    """One row per document with the scalar fields of its first literature row."""
    first = literature.groupBy(document).agg(F.min_by(F.struct(*fields), order).alias("l"))
    return documents.join(first, document, "left").select(document, *(F.col(f"l.{f}").alias(f) for f in fields))


def summary(passed: DataFrame, failed: DataFrame, mentions: DataFrame, document: str, cls: str) -> DataFrame:
    """(item, n): documents passed, failed and in all, and mentions per class of those passed."""
    count = lambda df, name: df.agg(F.lit(name).alias("item"), F.count(F.lit(1)).alias("n"))
    per = mentions.join(passed.select(document), document, "left_semi").groupBy(F.concat(F.lit("class:"), F.col(cls)).alias("item")).agg(F.count(F.lit(1)).alias("n"))
    return count(passed, "passed").unionByName(count(failed, "failed")).unionByName(count(passed.select(document).unionByName(failed.select(document)), "total")).unionByName(per)


def report(audit: DataFrame, phase: str, kind: str) -> DataFrame:
    """Changes, warnings, drops and merges per phase, with a grand total (phase null)."""
    return audit.rollup(phase).agg(*(F.count_if(F.col(kind) == k).alias(f"n_{k}") for k in ("changed", "warning", "dropped", "merged")))


def all_entities(mentions: DataFrame, fixed: Sequence[str], attributes: str) -> DataFrame:
    """All mentions of all classes in one table: fixed columns, and all attributes as one JSON column."""
    return mentions.select(*fixed, F.when(F.size(attributes) > 0, F.to_json(attributes)).alias("attributes"))


def write_csv(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """A CSV folder, sorted over all files by ``order``; files are as many as partitions, so a large table isn't pulled
    into one task."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)
