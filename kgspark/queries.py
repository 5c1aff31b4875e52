"""All core queries over the test tables: those of the problem of missing records, and the catalogue in kgspark.plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import plans
from .operators.orphans import Reference, Source, find_orphans, orphan_summary
from .session import table

DIRECT = (
    Reference("results", "indicator_abbreviation", "indicators", "abbreviation"),
    Reference("results", "tissue_site", "tissue_sites", "site_name"),
    Reference("interventions", "intervention_target", "alternatives", "standard_name"),
)
CASCADE = (*DIRECT, Reference("indicators", "measured_in", "tissue_sites", "site_name"))


def _sources(spark: SparkSession, sf: str) -> dict[str, Source]:
    t = lambda name: table(spark, sf, name)
    return {
        "results": Source(t("results"), "result_id"),
        "interventions": Source(t("interventions"), "intervention_id"),
        "indicators": Source(t("indicators"), "indicator_id", deleted="deleted_at"),
        "tissue_sites": Source(t("tissue_sites"), "tissue_site_id", deleted="deleted_at"),
        "alternatives": Source(t("alternatives"), "alternative_id", deleted="deleted_at"),
    }


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Direct orphan references of results and interventions, out of the cascade over the whole foreign-key graph."""
    direct = find_orphans(_sources(spark, sf), CASCADE).where(F.col("kind") == "direct").where(F.col("ref_table").isin(*(r.table for r in DIRECT)))
    return direct.select("ref_table", "ref_field", "record_id", "ref_month", "reason")


def p4_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Direct and inherited orphans per table, field, month, reason and kind, indicators' own references included."""
    return orphan_summary(find_orphans(_sources(spark, sf), CASCADE))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return plans.load()[0] | {f.__name__: f for f in (p4_found, p4_cascade)}
