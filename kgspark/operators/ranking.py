"""Global ranks and running totals over a distributed order, without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed


def ordered_totals(df: DataFrame, order: Sequence[Column], totals: dict[str, Column], within: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Adds, for each name in ``totals``, the sum of its expression over all earlier rows of the same ``within`` group.

    ``order`` must be total (ties end in a unique column). The rows are range-sorted by (within, order), so even one
    group with a third of all rows spreads over many partitions; each partition sums its own rows, the partitions' sums
    per group (as many rows as partitions, plus one per group) are added up, and the offsets are joined back. The sorted
    rows are written once: the ranges come from a sample, so computing them twice could give two orders.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    within = list(within)
    keyed = df.withColumns({f"__v_{k}": e for k, e in totals.items()}).withColumns({f"__w_{i}": F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for i, c in enumerate(within)})
    cols = [F.col(f"__w_{i}") for i in range(len(within))]
    ranged = keyed.repartitionByRange(n, *cols, *order).withColumn("__p", F.spark_partition_id())
    local = Window.partitionBy("__p", *cols).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    done = checkpointed(ranged)
    groups = ["__p", *(f"__w_{i}" for i in range(len(within)))]
    sums = done.groupBy(*groups).agg(*(F.sum(f"__v_{k}").alias(f"__s_{k}") for k in totals))
    before = Window.partitionBy(*groups[1:]).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1) if within else Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*groups, *(F.coalesce(F.sum(f"__s_{k}").over(before), F.lit(0)).alias(f"__o_{k}") for k in totals))
    # a group is split only at the edges of partitions: at most one row for each partition has an offset other than nought
    offsets = offsets.where(" OR ".join(f"__o_{k} <> 0" for k in totals))
    out = done.select("*", *(F.coalesce(F.sum(f"__v_{k}").over(local), F.lit(0)).alias(f"__l_{k}") for k in totals))
    out = out.join(F.broadcast(offsets), groups, "left")
    return out.select(*df.columns, *((F.col(f"__l_{k}") + F.coalesce(F.col(f"__o_{k}"), F.lit(0))).alias(k) for k in totals))
