"""Mixing sources to target weights by iterative proportional fitting."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import ordered_totals
from ..operators.skew import lookup_join
from ..session import checkpointed

#: Weights are whole millionths, so that running totals are exact in any order of addition.
UNIT = 1_000_000


#: Up to so many cells are raked on the driver, where a round costs microseconds; more are raked by aggregates, by the same rule.
CELLS = 200_000


def rake(cells: DataFrame, sources: DataFrame, others: Sequence[str], tolerance: float = 0.001, still: float = 1e-7) -> DataFrame:
    """``cells`` (source, others, tokens) with ``weight``, the copies each document of a cell should have on average.

    Iterative proportional fitting: weights start from what gives each source its target (``sources``: source, target,
    cap) and are scaled to the marginals of each of ``others`` (the shares its values have among all tokens that can be
    mixed) and of the sources in turn, never above the source's cap. It goes on until no value's uncapped cells miss its
    marginal by more than ``tolerance``, or a round moves less than the part ``still`` of the mixture's tokens (caps can
    make the marginals impossible together); the number of rounds has no limit, and an end of the second kind is warned
    of with the greatest miss (``marginals`` reports them all). The source comes last in each round: its share is the one
    demanded, and in the end each source is scaled to it as nearly as its cap lets it. The cells, whose number doesn't
    depend on that of the documents, are raked on the driver if they are few (``CELLS``).
    """
    state = checkpointed(cells.join(F.broadcast(sources.withColumn("cap", F.coalesce("cap", F.lit(float("inf"))))), "source").withColumn("weight", F.lit(0.0)))
    totals = state.groupBy("source").agg(F.first("target").alias("target"), F.sum("tokens").alias("have")).collect()  # one row for each listed source
    mass, everything = sum(r["target"] or 0.0 for r in totals), sum(r["have"] for r in totals)
    if not mass:
        return state
    rows = state.orderBy("source", *others).limit(CELLS + 1).toPandas()
    if len(rows) <= CELLS:
        rows["weight"], miss = _rake_rows(rows, others, mass / everything, tolerance, still)
        state = state.sparkSession.createDataFrame(rows, state.schema)
    else:
        state, miss = _rake_cells(state, others, mass / everything, tolerance, still * mass)
    if miss > tolerance:
        warnings.warn(f"caps keep the mixture from meeting all marginals; the greatest miss is {miss:.2%}", stacklevel=2)
    return state


def _rake_rows(rows: pd.DataFrame, others: Sequence[str], part: float, tolerance: float, still: float) -> tuple[np.ndarray, float]:
    tokens, cap, target = (rows[c].to_numpy(float) for c in ("tokens", "cap", "target"))
    dims = []
    for c in [*others, "source"]:
        code, values = pd.factorize(rows[c])
        want = np.bincount(code, tokens, len(values)) * part
        if c == "source":
            want[code] = target
        dims.append((c, code, want))
    _, code, want = dims[-1]
    w = np.minimum(cap, (want / np.bincount(code, tokens, len(want)))[code])
    while True:
        before, miss = w, 0.0
        for c, code, want in dims:
            now = np.bincount(code, tokens * w, len(want))
            f = np.divide(want, now, out=np.ones(len(want)), where=now > 0)[code]
            w = np.minimum(cap, w * f)
            if c != "source":
                miss = max(miss, np.abs(f - 1)[w < cap].max(initial=0.0))
        if miss <= tolerance or (tokens * np.abs(w - before)).sum() <= still * want.sum():
            break
    _, code, want = dims[-1]
    for k, t in enumerate(want):
        own = np.flatnonzero(code == k)
        w[own] = np.minimum(cap[own], w[own] * _factor(tokens[own], w[own], cap[own], t))
    return w, miss


def _factor(tokens: np.ndarray, w: np.ndarray, cap: np.ndarray, target: float) -> float:
    """The factor at which the tokens of cells, each weighed up to its cap, add up to the target; all caps if none is enough.

    Between the factors at which a cell meets its cap the sum is a straight line, so it is solved on the line it is on.
    """
    meets = np.divide(cap, w, out=np.full(len(w), np.inf), where=w > 0)
    order = np.argsort(meets, kind="stable")
    with np.errstate(invalid="ignore"):
        capped = np.concatenate([[0.0], np.cumsum(np.where(np.isfinite(meets[order]), tokens[order] * cap[order], 0.0))])
    free = np.concatenate([np.cumsum((tokens * w)[order][::-1])[::-1], [0.0]])
    for i in range(len(order)):
        if free[i] > 0 and (f := (target - capped[i]) / free[i]) <= meets[order[i]]:
            return max(f, 0.0)
    return float(meets[np.isfinite(meets)].max(initial=1.0))


def _rake_cells(state: DataFrame, others: Sequence[str], part: float, tolerance: float, least: float) -> tuple[DataFrame, float]:
    first = state.groupBy("source").agg(F.first("target").alias("want"), F.sum("tokens").cast("double").alias("now"))
    state = checkpointed(_scale(state.withColumn("weight", F.lit(1.0)), F.broadcast(first), "source").drop("f"))
    while True:
        state = state.withColumn("miss", F.lit(0.0)).withColumn("before", F.col("weight"))
        for dim in others:
            now = state.groupBy(dim).agg((F.sum("tokens") * F.lit(part)).alias("want"), F.sum(F.col("tokens") * F.col("weight")).alias("now"))
            state = _scale(state, now, dim).withColumn("miss", F.when(F.col("weight") < F.col("cap"), F.greatest("miss", F.abs(F.col("f") - 1))).otherwise(F.col("miss"))).drop("f")
        now = state.groupBy("source").agg(F.first("target").alias("want"), F.sum(F.col("tokens") * F.col("weight")).alias("now"))
        state = checkpointed(_scale(state, F.broadcast(now), "source").drop("f"))
        r = state.agg(F.max("miss").alias("miss"), F.sum(F.col("tokens") * F.abs(F.col("weight") - F.col("before"))).alias("moved")).first()
        state = state.drop("miss", "before")
        if (r["miss"] or 0.0) <= tolerance or r["moved"] <= least:
            return _reach(state), r["miss"] or 0.0


def _reach(state: DataFrame, steps: int = 64, exact: float = 1e-9) -> DataFrame:
    """Weights scaled so that each source reaches its target under its cap, as nearly as it can, by aggregates.

    The factor lies between target / sum, at which no cap would bind, and the factor at which the last cell meets its cap;
    one aggregate gives the sums for a geometric grid between them, and the grid is refined until it is ``exact``. There
    is one bracket per listed source.
    """
    spark = state.sparkSession
    meets = F.max(F.when((F.col("weight") > 0) & (F.col("cap") < float("inf")), F.col("cap") / F.col("weight")))
    ends = state.groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("tokens") * F.col("weight")).alias("n"), meets.alias("hi")).where("n > 0 AND t > 0")
    bracket = {r["source"]: (r["t"] / r["n"], max(r["hi"] or 0.0, r["t"] / r["n"]), r["t"]) for r in ends.collect()}
    grid = lambda k: F.col("lo") * F.pow(F.col("hi") / F.col("lo"), F.lit(k / (steps - 1)))
    while any(hi > lo * (1 + exact) for lo, hi, _ in bracket.values()):
        rows = spark.createDataFrame([(s, lo, hi) for s, (lo, hi, _) in bracket.items()], "source string, lo double, hi double")
        sums = state.join(F.broadcast(rows), "source").groupBy("source").agg(*(F.sum(F.col("tokens") * F.least(F.col("cap"), F.col("weight") * grid(k))).alias(f"s{k}") for k in range(steps)))
        for r in sums.collect():
            lo, hi, want = bracket[r["source"]]
            at = lambda k: lo * (hi / lo) ** (k / (steps - 1))  # noqa: B023, E731
            k = next((k for k in range(steps) if r[f"s{k}"] >= want), None)
            bracket[r["source"]] = (hi, hi, want) if k is None else (at(max(k - 1, 0)), at(k), want)
    rows = spark.createDataFrame([(s, hi) for s, (_, hi, _) in bracket.items()], "source string, f double")
    return checkpointed(state.join(F.broadcast(rows), "source", "left").withColumn("weight", F.least("cap", F.col("weight") * F.coalesce("f", F.lit(1.0)))).drop("f"))


def _label(name: str) -> Column:
    """A label's cell: lower case without blanks at the ends, null apart from all; one longer than 64 characters by its hash."""
    x = F.lower(F.trim(name))
    return F.coalesce(F.concat(F.lit("="), F.when(F.char_length(x) <= 64, x).otherwise(F.sha2(x, 256))), F.lit(""))


def _start(summed: DataFrame, tries: int = 32) -> DataFrame:
    """(source, start): of evenly spread starting points of the systematic sample the one that brings the tokens drawn
    nearest to those expected; one aggregate tries them all."""
    at = [k * UNIT // tries for k in range(tries)]
    drawn = lambda u: F.expr(f"(before + w + {u}) div {UNIT} - (before + {u}) div {UNIT}")
    off = summed.groupBy("source").agg(*(F.abs(F.sum(F.col("tokens") * (drawn(u) * UNIT - F.col("w")))).alias(f"e{k}") for k, u in enumerate(at)))
    best = F.array_min(F.array(*(F.struct(F.col(f"e{k}").alias("e"), F.lit(u).alias("u")) for k, u in enumerate(at))))
    return off.select("source", best["u"].alias("start"))


def _scale(state: DataFrame, now: DataFrame, dim: str) -> DataFrame:
    f = F.when(F.col("now") > 0, F.col("want") / F.col("now")).otherwise(F.lit(1.0)).alias("f")
    return state.join(now.select(dim, f), dim).withColumn("weight", F.least("cap", F.col("weight") * F.col("f")))


def mix(docs: DataFrame, targets: DataFrame, *, key: str, size: str, source: str = "source", others: Sequence[str] = (), share: str = "target_share", repeats: str = "max_repeats", total: float | None = None) -> DataFrame:
    """(key, source, size, weight, copies): every document of a listed source and how often the mixture holds it.

    The mixture's size is ``total``, or the most at which every source can reach its target share within its number
    of repeats. Weights are calibrated over (source, others) cells by ``rake``; then copies are drawn with those
    expectations by systematic sampling: documents of a source are range-sorted by cell, size and a hash of the key,
    weights are added up along that order over the whole cluster, and a document has as many copies as its stretch holds
    whole numbers; of 32 starting points the one nearest to the source's target is taken. So every cell has its number of
    copies but for one, a document's copies are its weight rounded up or down and never more than ``max_repeats``, and
    no draw depends on the partitioning. Cells are joined back by a skew-safe lookup.

    Sources not listed, and null ones, aren't part of the mixture; documents without tokens have no copies; null and
    differently written labels in ``others`` are values of their own (null is one value); a source listed twice counts
    by the sum of its shares; a listed source without tokens can't be reached, which the shares report. An empty table
    gives an empty result; columns not named are ignored; a repeated key is drawn each time it occurs.
    """
    t = targets.where(F.col(source).isNotNull()).groupBy(F.col(source).alias("source")).agg(F.sum(share).alias("share"), F.min(repeats).alias("cap"))
    labels = [f"l{i}" for i in range(len(others))]
    base = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("tokens"), *(_label(c).alias(n) for c, n in zip(others, labels)))
    base = base.join(F.broadcast(t.select("source")), "source", "left_semi")
    cells = checkpointed(base.where("tokens > 0").groupBy("source", *labels).agg(F.sum("tokens").alias("tokens")))
    have = cells.groupBy("source").agg(F.sum("tokens").alias("have")).join(F.broadcast(t), "source").where("share > 0 AND cap > 0")
    most = have.agg(F.min(F.col("cap") * F.col("have") / F.col("share")).alias("m")).first()["m"]
    mass = 0.0 if most is None else most if total is None else total
    sources = t.select("source", (F.col("share") * F.lit(float(mass))).alias("target"), F.col("cap").cast("double").alias("cap"))
    weights = rake(cells, sources, labels).select("source", *labels, "weight")
    weighed = lookup_join(base.where("tokens > 0"), weights, ["source", *labels], "inner")
    weighed = weighed.select("key", "source", "tokens", *labels, F.floor(F.col("weight") * UNIT + F.lit(1e-6)).cast("long").alias("w"))
    summed = checkpointed(ordered_totals(weighed, [*(F.col(c) for c in reversed(labels)), F.desc("tokens"), F.xxhash64("key"), F.col("key")], {"before": F.col("w")}, within=["source"]))
    summed = summed.join(F.broadcast(_start(summed)), "source").withColumn("b", F.col("before") + F.col("start"))
    copies = F.expr(f"(b + w) div {UNIT} - b div {UNIT}")
    drawn = summed.select("key", "source", "tokens", (F.col("w") / UNIT).alias("weight"), copies.alias("copies"))
    empty = base.where("tokens <= 0").select("key", "source", "tokens", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("copies"))
    out = drawn.unionByName(empty)
    return out.select(F.col("key").alias(key), "source", F.col("tokens").alias(size), "weight", "copies")


def shares(mixture: DataFrame, targets: DataFrame, size: str, share: str = "target_share", repeats: str = "max_repeats") -> DataFrame:
    """One row per listed source: target and reached share, tokens there and used, the most copies of one document."""
    got = mixture.groupBy("source").agg(F.sum(size).alias("tokens_there"), F.sum(F.col(size) * F.col("copies")).alias("tokens_used"), F.max("copies").alias("most_copies"))
    whole = got.agg(F.sum("tokens_used").alias("whole"))
    out = targets.join(F.broadcast(got), "source", "left").crossJoin(F.broadcast(whole))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.select("source", share, repeats, zero("tokens_there").alias("tokens_there"), zero("tokens_used").alias("tokens_used"), zero("most_copies").alias("most_copies"), (zero("tokens_used") / F.col("whole")).alias("actual_share"))


def marginals(mixture: DataFrame, docs: DataFrame, key: str, size: str, others: Sequence[str]) -> DataFrame:
    """(dimension, value, wanted_share, expected_share, reached_share) of every value of ``others``: its share among the
    tokens that can be mixed, by the weights, and in the mixture drawn. ``mixture`` is all rows of ``mix`` over ``docs``."""
    label = lambda c: F.lower(F.trim(c)).alias(c)
    m = mixture.join(docs.select(key, *(label(c) for c in others)), key)
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value")) for c in others))).alias("v")
    got = m.select(size, "weight", "copies", each).groupBy("v.dimension", "v.value").agg(F.sum(size).alias("n"), F.sum(F.col(size) * F.col("weight")).alias("e"), F.sum(F.col(size) * F.col("copies")).alias("c"))
    whole = got.groupBy("dimension").agg(*(F.sum(x).alias(f"all_{x}") for x in "nec"))
    return got.join(F.broadcast(whole), "dimension").select("dimension", "value", *((F.col(x) / F.col(f"all_{x}")).alias(n) for x, n in (("n", "wanted_share"), ("e", "expected_share"), ("c", "reached_share"))))
