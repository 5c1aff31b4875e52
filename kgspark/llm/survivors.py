"""Best representative of each duplicate group, chosen bundle by bundle."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence
from fractions import Fraction
from functools import reduce
from operator import add

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed

#: Values that only say that nothing is known, in lower case and without blanks at the ends.
PLACEHOLDERS = ("", "n/a", "na", "none", "unknown", "unspecified", "not reported", "-", "?")

#: Bundles without dependencies that are searched together; any number gives the same choice.
TOGETHER = 64


def stated(value: Column) -> Column:
    """Whether a value says something: not null, not blank and no placeholder."""
    return value.isNotNull() & ~F.lower(F.regexp_replace(value, r"(?U)^\s+|\s+$", "")).isin(*PLACEHOLDERS)


def choose_bundles(candidates: DataFrame, *, group: str, row: str, bundle: str, merit: Sequence[str], values: str | None = None, dependencies: Sequence[tuple[str, str]] = (), width: int = 16, several: bool = False) -> DataFrame:
    """For each group and bundle the candidate row that the surviving record takes it from.

    ``candidates`` has one row per (group, row, bundle). ``merit`` names columns compared in order, larger first, null
    last; the row id breaks ties. ``values`` is a map of the bundle's fields. ``dependencies`` are pairs of fields
    (x, y): in the surviving record a value of x must come with the y that the group's best row stating both gives it.

    Branch and bound. Merits of a record add up bundle by bundle, the number of null ones first, and compare from the
    first merit on. A branch is cut if its merit plus the best of the bundles still open can't beat the record found so
    far. Without dependencies a group's offers are sorted, best first, and stream through the search, up to
    ``TOGETHER`` bundles at a time with their best ``width`` candidates and the one that bounds the rest. With
    dependencies a group falls into subproblems that share none: the bundles that state a field of one are searched
    together, any other bundle by itself; their number of bundles doesn't grow with the group. Candidates of a bundle
    with equal values in the dependencies' fields are dominated by the best of them, which one aggregate finds, combined
    on the map side. Of those the best ``width`` go into the search; a subproblem whose optimum could lie among
    candidates left out is searched again with four times as many, until the bound proves it. So no task holds an
    unbounded group and no candidate is lost.

    Null groups or rows give nothing; a null bundle offers nothing but counts as a row of its group, which matters if
    only groups of ``several`` different rows are wanted; equal candidates are decided by the row id; if no choice keeps
    all dependencies, the best one that breaks fewest is taken. Columns not named are ignored.
    """
    fields = sorted({f for d in dependencies for f in d})
    of = {f: i for i, f in enumerate(fields)}
    f_cols = [f"f_{i}" for i in range(len(fields))]
    whole = all(isinstance(candidates.schema[m].dataType, T.IntegralType | T.TimestampType) for m in merit)
    number = "long" if whole else "double"
    worth = lambda m: F.unix_micros(m) if isinstance(candidates.schema[m].dataType, T.TimestampType) else F.col(m).cast(number)
    score = F.struct(*(worth(m).alias(f"m{i}") for i, m in enumerate(merit)), F.col(row).cast("long").alias("row"))
    base = candidates.where(F.col(group).isNotNull() & F.col(row).isNotNull())
    kind = base.schema[group].dataType.simpleString()
    ms = [f"m{i}" for i in range(len(merit))]
    if not dependencies:
        offers = base.select(F.col(group).alias("g"), F.col(bundle).alias("b"), *(worth(m).alias(c) for m, c in zip(merit, ms)), F.col(row).cast("long").alias("row"))
        place = F.row_number().over(Window.partitionBy("g").orderBy("b", *(F.desc(c) for c in (*ms, "row"))))
        found = _streamed(offers.select("g", "b", *ms, "row", place.alias("place")), width, several, kind)
        return found.select(F.col("g").alias(group), F.col("b").alias(bundle), F.col("row").cast(base.schema[row].dataType).alias(row))
    keyed = base.select(F.col(group).alias("g"), F.col(bundle).alias("b"), score.alias("s"), *(F.lower(F.trim(F.col(values)[f])).alias(c) for f, c in zip(fields, f_cols)))
    kept = keyed.groupBy("g", "b", *f_cols).agg(F.max("s").alias("s"), F.min("s.row").alias("r0"), F.max("s.row").alias("r1"))
    if several:
        own = Window.partitionBy("g")
        kept = kept.withColumns({"r0": F.min("r0").over(own), "r1": F.max("r1").over(own)}).where("r0 < r1")
    kept = kept.where("b IS NOT NULL").select("g", "b", *f_cols, "s")
    merits = F.flatten(F.array(*(F.array(F.when(F.col(f"s.m{i}").isNull(), -1).otherwise(0).cast(number), F.coalesce(F.col(f"s.m{i}"), F.lit(0)).cast(number)) for i in range(len(merit)))))
    offer = F.struct("b", F.col("s.row").alias("row"), merits.alias("merit"), F.array(*f_cols).alias("vals"))
    kept = checkpointed(kept)
    states = F.coalesce(*f_cols).isNotNull()
    tied = kept.where(states).select("g", "b").distinct().withColumn("tied", F.lit(True))
    kept = checkpointed(kept.join(tied, ["g", "b"], "left").withColumn("tied", F.col("tied").isNotNull()))
    rules = checkpointed(_rules(candidates, group, values, dependencies, score))
    deps = [(of[x], of[y]) for x, y in dependencies]
    free = kept.where("NOT tied").select("g", "b", *(F.col(f"s.{c}") for c in ms), F.col("s.row"), F.lit(1).alias("place"))
    chosen = [_streamed(free, width, False, kind)]
    todo = kept.where("tied").select("g").distinct()
    rank = F.row_number().over(Window.partitionBy("g", "b").orderBy(F.desc("s")))
    while True:
        near = kept.where("tied").join(todo, "g", "left_semi").withColumn("k", rank).where(F.col("k") <= width + 1)
        offers = near.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("k", offer.alias("o")))).alias("offers")).withColumn("offers", F.transform("offers", lambda x: x["o"]))
        # of the rules only those on candidates in the search can bind
        seen = near.select("g", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f_cols[x]).alias("x")) for k, (x, _) in enumerate(deps)))).alias("v")).select("g", "v.k", "v.x").where("x IS NOT NULL").distinct()
        binding = rules.join(seen, ["g", "k", "x"], "left_semi").groupBy("g").agg(F.collect_list(F.struct("k", "x", F.col("need").alias("y"))).alias("rules"))
        found = checkpointed(_solved(offers.join(binding, "g", "left"), deps, width, kind))
        chosen.append(found.where("proved"))
        todo = found.where("NOT proved").select("g").distinct()
        if todo.isEmpty():
            break
        width *= 4
    return reduce(DataFrame.unionByName, chosen).select(F.col("g").alias(group), F.col("b").alias(bundle), F.col("row").cast(base.schema[row].dataType).alias(row))


def _rules(candidates: DataFrame, group: str, values: str, dependencies: Sequence[tuple[str, str]], score: Column) -> DataFrame:
    """(g, k, x, need): by dependency k, the y that the best row stating both x and y gives to x in group g.

    x and y may lie in different bundles of one row, so a row's maps are put together first; only rows with a field of a
    dependency are.
    """
    fields = sorted({f for d in dependencies for f in d})
    of = {f: i for i, f in enumerate(fields)}
    stating = candidates.select(F.col(group).alias("g"), score.alias("s"), *(F.lower(F.trim(F.col(values)[f])).alias(f"v_{i}") for i, f in enumerate(fields))).where(F.coalesce(*(f"v_{i}" for i in range(len(fields)))).isNotNull())
    per_row = stating.groupBy("g", F.col("s.row").alias("r")).agg(*(F.max(f"v_{i}").alias(f"v_{i}") for i in range(len(fields))), F.max("s").alias("s"))
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"v_{of[x]}").alias("x"), F.col(f"v_{of[y]}").alias("y")) for k, (x, y) in enumerate(dependencies)))).alias("d")
    return per_row.select("g", "s", each).select("g", "d.k", "d.x", "d.y", "s").where("g IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL").groupBy("g", "k", "x").agg(F.max_by("y", "s").alias("need"))


def _streamed(offers: DataFrame, width: int, several: bool, kind: str) -> DataFrame:
    """(g, b, row, proved) of groups without dependencies; the offers (g, b, merits, row, place) lie group by group, each
    group's first at place 1, by bundle and best first."""
    return offers.mapInArrow(lambda batches: stream(batches, width, several), f"g {kind}, b string, row long, proved boolean")


def _parts(merit: pa.Array) -> list[list]:
    """A merit in whole or exact numbers that can be added up and compared in order: how often it is null, if not whole
    also how often not a number or infinite, and its value."""
    nulls = pc.negate(merit.is_null().cast(pa.int8())).to_numpy().tolist()
    known = merit.fill_null(0).to_numpy().tolist()
    if not pa.types.is_floating(merit.type):
        return [nulls, known]
    return [nulls, [int(math.isnan(x)) for x in known], [int(x == math.inf) for x in known], [-int(x == -math.inf) for x in known], [Fraction(x) if math.isfinite(x) else 0 for x in known]]


def stream(batches: Iterable[pa.RecordBatch], width: int, several: bool) -> Iterator[pa.RecordBatch]:
    """The choice of each group in a stream of offers, by branch and bound; see ``_streamed``.

    Held are the ``width`` + 1 best candidates of up to ``TOGETHER`` bundles, and if only groups of ``several`` rows are
    wanted, the picks of a group of which one row has been seen so far.
    """
    bundles: dict[str, list] = {}
    picked: list[tuple[str, int]] = []  # of the group at hand
    group = low = high = last = None
    out: list[tuple] = []

    def settle() -> None:
        if bundles:
            picks, proved = search(bundles, (), {}, width)
            assert proved  # the best of all bundles together is always found
            picked.extend(picks.items())
            bundles.clear()
        if not several or low != high:
            out.extend((group, b, r, True) for b, r in picked)
            picked.clear()

    kind = None
    for batch in batches:
        kind = batch["g"].type
        merits = [part for name in batch.schema.names[2:-2] for part in _parts(batch[name])]
        coded = batch["b"].dictionary_encode()  # most offers are of a few bundles
        names = [*coded.dictionary.to_pylist(), None]
        rows, places, codes = (x.to_numpy().tolist() for x in (batch["row"], batch["place"], coded.indices.fill_null(-1)))
        for i, (place, code, r, merit) in enumerate(zip(places, codes, rows, zip(*merits, rows))):
            if place == 1:
                if not several or low != high:
                    settle()
                bundles.clear()
                picked.clear()
                group, low, high, last = batch["g"][i].as_py(), r, r, None
            elif r < low:
                low = r
            elif r > high:
                high = r
            b = names[code]
            if b is None:
                continue
            if b != last:
                if len(bundles) == TOGETHER:
                    settle()
                last, own = b, bundles.setdefault(b, [])
            if len(own) <= width:
                own.append((merit, r, (), len(own) + 1))
        if out:
            yield _record(out, kind)
            out.clear()
    if not several or low != high:
        settle()
    if out:
        yield _record(out, kind)


def _record(found: Sequence[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (kind, pa.string(), pa.int64(), pa.bool_()))], names=["g", "b", "row", "proved"])


def _solved(problems: DataFrame, deps: Sequence[tuple[int, int]], width: int, kind: str) -> DataFrame:
    """(g, b, row, proved) of each subproblem (g, offers best first, rules), by branch and bound."""
    deps = list(deps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for group, listed, rules in zip(batch["g"], batch["offers"].to_pylist(), batch["rules"].to_pylist()):
                bundles: dict[str, list] = {}
                for o in listed:
                    b = bundles.setdefault(o["b"], [])
                    b.append(((*o["merit"], o["row"]), o["row"], tuple(o["vals"]), len(b) + 1))
                picks, proved = search(bundles, deps, {(r["k"], r["x"]): r["y"] for r in rules or ()}, width)
                out += [(group.as_py(), b, r, proved) for b, r in picks.items()]
            if out:
                yield _record(out, batch["g"].type)

    return problems.select("g", "offers", "rules").mapInArrow(run, f"g {kind}, b string, row long, proved boolean")


def _plus(a: tuple, b: tuple) -> tuple:
    return tuple(map(add, a, b))


def search(bundles: Mapping[str, list], deps: Sequence[tuple[int, int]], rules: Mapping[tuple[int, str], str], width: int) -> tuple[dict, bool]:
    """Branch and bound over one group: bundle -> row, and whether no candidate beyond the first ``width`` can win.

    Candidates are (merit, row, values of the dependencies' fields, rank), best first. A record's worth is minus the
    number of dependencies it breaks, then the merits added up.
    """
    names = sorted(bundles, key=lambda b: (len(bundles[b]), b))
    zero = tuple(0 for _ in bundles[names[0]][0][0])
    tops = [bundles[b][0][0] for b in names]
    rest = [zero] * (len(names) + 1)
    for i in range(len(names) - 1, -1, -1):
        rest[i] = _plus(tops[i], rest[i + 1])
    best: list = [None, None]

    def breaks(vals: dict) -> int:
        return sum(1 for k, (x, y) in enumerate(deps) if x in vals and y in vals and (k, vals[x]) in rules and rules[k, vals[x]] != vals[y])

    def go(i: int, vals: dict, worth: tuple, picks: tuple) -> None:
        bad = breaks(vals) if deps else 0
        if i == len(names):
            if best[0] is None or (-bad, worth) > best[0]:
                best[:] = [(-bad, worth), dict(zip(names, picks))]
            return
        for merit, row, v, _ in bundles[names[i]][:width]:
            more = _plus(worth, merit)
            if best[0] is not None and (-bad, _plus(more, rest[i + 1])) <= best[0]:
                return  # nor can any candidate after it: none is better or mends what is broken
            go(i + 1, vals | {f: x for f, x in enumerate(v) if x is not None} if v else vals, more, (*picks, row))

    go(0, {}, zero, ())
    proved = True
    for i, b in enumerate(names):
        if len(bundles[b]) > width:  # the best of those not searched, all else at its best
            bound = zero
            for j, _ in enumerate(names):
                bound = _plus(bound, bundles[b][width][0] if j == i else tops[j])
            proved = proved and (0, bound) <= best[0]
    return best[1], proved
