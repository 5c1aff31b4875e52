"""Vocabularies, review tables, and stored stages."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated vocabulary with quoted cells of several lines, all columns text."""
    return spark.read.options(sep="\t", header=True, multiLine=True, quote='"', escape='"').csv(path)


def read_review(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Review tables, one per class, as one table: entity_class, source_doc (else pmid), all columns text."""
    parts = [spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(p).withColumn("entity_class", F.lit(c)) for c, p in paths.items()]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    doc = [F.col(c) for c in ("source_doc", "pmid") if c in out.columns]
    return out.withColumn("source_doc", F.coalesce(*doc))


def read_stage(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored stage, or None if there is none."""
    try:
        return spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """``df`` stored and read back: the commit is atomic, so a stage is there whole or not at all."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
