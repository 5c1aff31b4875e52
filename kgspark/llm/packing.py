"""Filling fixed-capacity containers by bulk-synchronous best fit."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import ordered_totals
from ..session import checkpointed

#: Beyond this capacity the counts of sizes, and the moves made of them, are refused as too many for a task to hold.
MAX_CAPACITY = 4_000_000
#: Numbers of ranges that a round's sweeps work in, finest first; the last sweep sees what is left of all ranges.
RANGES = (64, 8, 1)

_STATE = "kind string, size long, first long, n long, box long, place long, per long"


def sweep(items: Sequence[tuple[int, int, int]], gaps: Sequence[tuple[int, int, int, int]]) -> tuple[list, list, list]:
    """Best fit within one range: (moves, items left, gaps left).

    ``items`` are (size, first rank, count), ``gaps`` (gap, first container, count, items inside). From the largest size
    down every item takes its successor among the gaps, the smallest that holds it, and a container filled again and
    again takes its copies at once. Where several items or containers are alike ranks decide: the k-th item takes the
    k-th place. What remains of a gap is met again when the sweep comes down to it. A move is (size, first rank, count,
    first container, items inside, copies for each container).
    """
    waiting = [(-g, first, n, inside) for g, first, n, inside in gaps]
    heapq.heapify(waiting)
    open_: list[tuple[int, int, int, int]] = []  # gaps that hold the current size, the smallest last
    moves, left = [], []
    for size, rank, n in sorted(items, reverse=True):
        while n:
            while waiting and -waiting[0][0] >= size:
                g, first, m, inside = heapq.heappop(waiting)
                open_.append((-g, first, m, inside))
            if not open_:
                break
            g, first, m, inside = open_.pop()
            per = g // size
            full = min(m, n // per)
            if full:
                moves.append((size, rank, full * per, first, inside, per))
                if g > size * per:
                    heapq.heappush(waiting, (size * per - g, first, full, inside + per))
                rank, n = rank + full * per, n - full * per
            if full < m:  # the items end here: one container takes the last of them
                if m - full > 1 or not n:
                    open_.append((g, first + full + (n > 0), m - full - (n > 0), inside))
                if n:
                    moves.append((size, rank, n, first + full, inside, n))
                    heapq.heappush(waiting, (size * n - g, first + full, 1, inside + n))
                    rank, n = rank + n, 0
        if n:
            left.append((size, rank, n))
    return moves, left, open_ + [(-g, first, m, inside) for g, first, m, inside in waiting]


def _swept(state: DataFrame, capacity: int, ranges: int) -> DataFrame:
    """Moves, items and gaps after one sweep in each of the ranges of sizes."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        i, g = pdf[pdf["kind"] == "item"], pdf[pdf["kind"] == "gap"].sort_values(["size", "box"])
        moves, left, gaps = sweep(list(zip(*(i[c].tolist() for c in ("size", "first", "n")))), list(zip(*(g[c].tolist() for c in ("size", "box", "n", "place")))))
        rows = [("move", *m) for m in moves] + [("item", s, r, n, 0, 0, 0) for s, r, n in left] + [("gap", g, 0, n, b, inside, 0) for g, b, n, inside in gaps]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _STATE.split(", ")])

    return state.groupBy(F.floor((F.col("size") - 1) * ranges / capacity).alias("r")).applyInPandas(run, _STATE)


def _placed(classes: DataFrame, capacity: int) -> DataFrame:
    """The moves (see ``sweep``) that place all items; ``classes`` are (size, n).

    Rounds: as many containers are opened as the items left need at least, the largest items going into one each by
    rank; then sweeps in parallel match items and gaps range by range, each leaving what it can't match to a sweep over
    coarser ranges, until nothing fits. The state of a round is a table of runs: items of one size, and containers with
    one gap, are alike. Its rows grow with the number of different sizes and of sweeps, not with the number of items.
    """
    state = checkpointed(classes.select(F.lit("item").alias("kind"), "size", F.lit(0).cast("long").alias("first"), "n", *(F.lit(0).cast("long").alias(c) for c in ("box", "place", "per"))))
    moves, opened = [], 0
    while True:
        items = state.where("kind = 'item'")
        r = items.agg(F.sum(F.col("size") * F.col("n")).alias("total"), F.sum("n").alias("n"), F.sum(F.when(2 * F.col("size") > capacity, F.col("n"))).alias("over")).first()
        if not r["n"]:
            break
        need = min(max(-(-r["total"] // capacity), r["over"] or 0, 1), r["n"])
        # one row for each size: the window is bounded by the capacity
        ahead = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ranked = items.withColumn("ahead", ahead).withColumn("take", F.least(F.greatest(F.lit(need) - F.col("ahead"), F.lit(0)), F.col("n")))
        zero = F.lit(0).cast("long")
        first = F.struct(F.lit("move").alias("kind"), "size", "first", F.col("take").alias("n"), (F.col("ahead") + opened).alias("box"), zero.alias("place"), F.lit(1).cast("long").alias("per"))
        gap = F.struct(F.lit("gap").alias("kind"), (capacity - F.col("size")).alias("size"), zero.alias("first"), F.col("take").alias("n"), (F.col("ahead") + opened).alias("box"), F.lit(1).cast("long").alias("place"), zero.alias("per"))
        rest = F.struct(F.lit("item").alias("kind"), "size", (F.col("first") + F.col("take")).alias("first"), (F.col("n") - F.col("take")).alias("n"), zero.alias("box"), zero.alias("place"), zero.alias("per"))
        state = ranked.select(F.explode(F.array(first, gap, rest)).alias("x")).select("x.*").where("n > 0 AND size > 0").unionByName(state.where("kind = 'gap'"))
        opened += need
        for ranges in RANGES:
            moved = state.where("kind = 'move'")
            state = checkpointed(_swept(state.where("kind <> 'move'"), capacity, ranges).unionByName(moved))
            if state.where("kind = 'item'").isEmpty():
                break
        moves.append(state.where("kind = 'move'"))
        state = state.where("kind <> 'move'")
    return reduce(DataFrame.unionByName, moves) if moves else state.where("kind = 'move'")


def pack(items: DataFrame, *, key: str, size: str, capacity: int) -> DataFrame:
    """(sequence_id, position, key, part_no, part_start, part_size): every item placed in containers of ``capacity``.

    An item larger than the capacity is cut into full parts, each alone in a container, and a rest; no other item is
    divided. Items of size 0 or null are kept with a null sequence_id. Items are range-sorted by (size, key) and ranked
    over the whole cluster; the rounds of ``_placed`` run in the cluster on runs of alike items and gaps, and their
    outcome, ranges of ranks beside ranges of containers, of which there are as few, is broadcast, so each item looks its
    place up where it lies: items are sorted once and never regrouped, and a size that a third of all items share is
    spread over many partitions. Repeated keys are packed each time they occur; the result depends only on keys and
    sizes (ties of both are alike); an empty table gives an empty result.
    """
    if not 1 <= capacity <= MAX_CAPACITY:
        raise ValueError(f"the capacity must lie between 1 and {MAX_CAPACITY}")
    sized = items.select(F.col(key).alias("key"), F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("size"))
    none = sized.where("size = 0")
    parts = sized.where("size > 0").select("key", "size", F.explode(F.sequence(F.lit(0), ((F.col("size") - 1) / capacity).cast("long"))).alias("part_no"))
    parts = parts.select("key", "part_no", (F.col("part_no") * capacity).alias("part_start"), F.least(F.col("size") - F.col("part_no") * capacity, F.lit(capacity)).alias("part_size"))
    ranked = checkpointed(ordered_totals(parts, [F.col("part_size"), F.col("key"), F.col("part_no")], {"rank": F.lit(1).cast("long")}, within=["part_size"]))
    moves = _placed(ranked.groupBy(F.col("part_size").cast("long").alias("size")).agg(F.count(F.lit(1)).alias("n")), capacity)
    table = moves.select("size", "first", "box", "place", "per").orderBy("size", "first").toPandas().to_numpy(np.int64).reshape(-1, 5)
    plan = items.sparkSession.sparkContext.broadcast((table[:, 0] << 40 | table[:, 1], table))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, rows = plan.value
        for pdf in batches:
            rank = pdf["rank"].to_numpy()
            m = rows[np.searchsorted(codes, pdf["part_size"].to_numpy() << 40 | rank, side="right") - 1]
            out = pdf.drop(columns="rank")
            box, copy = np.divmod(rank - m[:, 1], m[:, 4])
            out.insert(0, "position", m[:, 3] + copy)
            out.insert(0, "sequence_id", m[:, 2] + box)
            yield out

    kind = items.schema[key].dataType.simpleString()
    placed = ranked.select("key", "part_no", "part_start", "part_size", "rank").mapInPandas(place, f"sequence_id long, position long, key {kind}, part_no long, part_start long, part_size long")
    unplaced = none.select(F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("position"), "key", F.lit(0).cast("long").alias("part_no"), F.lit(0).cast("long").alias("part_start"), F.lit(0).cast("long").alias("part_size"))
    return placed.unionByName(unplaced).withColumnRenamed("key", key)


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: sequences, tokens, the fewest sequences that could hold them, and the share of capacity used."""
    r = packed.where("sequence_id IS NOT NULL").agg(F.count_distinct("sequence_id").alias("n_sequences"), F.coalesce(F.sum("part_size"), F.lit(0)).alias("n_tokens"))
    return r.withColumns({"least_sequences": F.ceil(F.col("n_tokens") / capacity), "share_used": F.col("n_tokens") / (F.col("n_sequences") * capacity)})
