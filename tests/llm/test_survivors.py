"""Bundles chosen against exhaustive search."""

import itertools
import random

import pytest

from kgspark.llm import survivors
from kgspark.llm.survivors import choose_bundles, search, stated

SCHEMA = "id string, row_id long, bundle string, m0 int, m1 int, vals map<string,string>, s string, g string"


def pick(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    out = choose_bundles(df, group="id", row="row_id", bundle="bundle", merit=["m0", "m1"], **kw)
    return sorted((r["id"], r["bundle"], r["row_id"]) for r in out.collect())


def test_best_rows(spark):
    rows = [("a", 1, "p", -1, None, None), ("a", 2, "p", -1, 5, None), ("a", 3, "p", -1, 5, None), ("a", 4, "p", None, 9, None), ("a", 1, "q", -3, 1, None), ("b", 9, "p", None, None, None), (None, 1, "p", 1, 1, None), ("c", None, "p", 1, 1, None), ("a", 3, "p", -1, 5, None)]
    assert pick(spark, rows) == [("a", "p", 3), ("a", "q", 1), ("b", "p", 9)]
    assert pick(spark, []) == []


def brute(bundles, deps, rules):
    best = None
    names = sorted(bundles)
    for combo in itertools.product(*(bundles[b] for b in names)):
        vals = {f: x for c in combo for f, x in enumerate(c[2]) if x is not None}
        bad = sum(1 for k, (x, y) in enumerate(deps) if x in vals and y in vals and (k, vals[x]) in rules and rules[k, vals[x]] != vals[y])
        worth = tuple(map(sum, zip(*(c[0] for c in combo))))
        if best is None or (-bad, worth) > best:
            best = (-bad, worth)
    return best


@pytest.mark.parametrize("width", [2, 3, 50])
def test_search_is_exact_when_proved(width):
    random.seed(width)
    proofs = 0
    for _ in range(300):
        bundles = {}
        row = 0
        for b, f in (("p", 0), ("q", 1), ("r", None)):
            c = []
            for _ in range(random.randint(1, 5)):
                row += 1
                vals = [None, None]
                if f is not None and random.random() < 0.9:
                    vals[f] = random.choice("xyz")
                c.append(((float(random.randint(0, 3)), float(row)), row, tuple(vals)))
            c.sort(reverse=True)
            bundles[b] = [(*x, i + 1) for i, x in enumerate(c)]
        rules = {(0, x): random.choice("xyz") for x in "xyz"}
        picks, proved = search(bundles, [(0, 1)], rules, width)
        if proved:
            proofs += 1
            chosen = [next(x for x in bundles[b] if x[1] == r) for b, r in picks.items()]
            vals = {f: x for c in chosen for f, x in enumerate(c[2]) if x is not None}
            bad = int(0 in vals and 1 in vals and rules[0, vals[0]] != vals[1])
            assert (-bad, tuple(map(sum, zip(*(c[0] for c in chosen))))) == brute(bundles, [(0, 1)], rules)
    assert proofs > 50


def test_dependencies(spark):
    rows = [
        ("a", 1, "name", 3, 0, {"n": "zinc"}), ("a", 2, "cas", 9, 0, {"c": "77"}), ("a", 1, "cas", 1, 0, {"c": "11"}), ("a", 2, "name", 2, 0, {"n": "iron"}),
        ("b", 5, "name", 1, 0, {"n": "zinc"}), ("b", 6, "cas", 1, 0, {"c": "11"}),
    ]
    deps = [("n", "c")]
    free = pick(spark, rows, values="vals")
    assert ("a", "name", 1) in free and ("a", "cas", 2) in free
    held = pick(spark, rows, values="vals", dependencies=deps)
    assert ("a", "name", 2) in held and ("a", "cas", 2) in held and ("b", "name", 5) in held
    assert pick(spark, rows, values="vals", dependencies=deps, width=1) == held


def test_wide_group_needs_more_rounds(spark):
    rows = [("h", i, "name", 1000 - i, 0, {"n": f"n{i}"}) for i in range(120)] + [("h", i, "cas", 1000 - i, 0, {"c": f"c{i}"}) for i in range(120)]
    rows += [("h", 200 + i, "name", -10, 0, {"n": f"n{i}"}) for i in range(120)]
    rows.append(("h", 500, "cas", 5000, 0, {"c": "c90"}))
    held = pick(spark, rows, values="vals", dependencies=[("n", "c")], width=2)
    assert held == pick(spark, rows, values="vals", dependencies=[("n", "c")], width=500)


def test_stated(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(x,) for x in ("v", " N/A ", "", "\t", None, "Not Reported", "-", "?", "nonesuch", "x" * 9000)], "v string")
    assert [r["v"][:8] for r in df.where(stated(F.col("v"))).collect()] == ["v", "nonesuch", "xxxxxxxx"]


def test_null_merit_hides_nothing(spark):
    """A bundle without any trust leaves the others' trust to decide."""
    zinc, iron = {"n": "zinc"}, {"n": "iron"}
    rows = [
        ("a", 1, "name", -1, 0, zinc), ("a", 2, "name", -3, 0, iron), ("a", 3, "cas", None, 9, {"c": "77"}), ("a", 4, "cas", None, 5, {"c": "11"}),
        ("a", 5, "name", -9, 0, zinc), ("a", 5, "cas", None, 0, {"c": "11"}), ("a", 6, "name", -9, 0, iron), ("a", 6, "cas", None, 0, {"c": "77"}),
    ]
    held = pick(spark, rows, values="vals", dependencies=[("n", "c")])
    assert held == [("a", "cas", 4), ("a", "name", 1)]


def test_rows_without_offers_count(spark):
    rows = [("a", 1, "p", 1, 1, None), ("a", 2, None, None, None, None), ("b", 3, "p", 1, 1, None), ("b", 3, None, None, None, None), ("c", 4, None, 1, 1, None), ("c", 5, None, 1, 1, None)]
    assert pick(spark, rows, several=True) == [("a", "p", 1)]
    assert pick(spark, rows) == [("a", "p", 1), ("b", "p", 3)]


def test_all_nodes_against_exhaustive_search(spark):
    """p3_bundles over the whole smallest table: no choice of whole bundles is worth more, for any id."""
    from collections import defaultdict

    from kgspark.llm.queries import BUNDLES, DEPENDENCIES, p3_bundles
    from kgspark.llm.survivors import PLACEHOLDERS

    from ..oracle import SF

    trust = {r["source"]: -r["trust_rank"] for r in spark.read.parquet(f"{SF}/source_trust.parquet").collect()}
    fields = sorted({f for d in DEPENDENCIES for f in d})
    groups = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/graph_nodes.parquet").selectExpr("*", "unix_micros(updated_at) AS t").collect():
        groups[r["id"]].append(r)
    got = defaultdict(dict)
    for r in p3_bundles(spark, SF).collect():
        got[r["id"]][r["bundle"]] = r["row_id"]
    several = 0
    nulls = lambda *m: tuple(x for v in m for x in (-(v is None), v or 0))
    for g, rows in groups.items():
        if len({r["row_id"] for r in rows}) < 2:
            assert g not in got
            continue
        offers, rules = defaultdict(dict), {}
        for r in rows:
            given = {k: v for k, v in (r["properties"] or {}).items() if v is not None and v.strip().lower() not in PLACEHOLDERS}
            bundles = defaultdict(dict)
            for k, v in given.items():
                bundles[BUNDLES.get(k, k)][k] = v.strip().lower()
            of = trust.get(r["source"])
            for b, vals in bundles.items():
                offers[b][r["row_id"]] = ((*nulls(0, of, len(vals), r["t"]), r["row_id"]), {f: vals[f] for f in fields if f in vals})
            mine = {f: v.strip().lower() for f, v in given.items() if f in fields}
            best = max((offers[b][r["row_id"]][0] for b in bundles if offers[b][r["row_id"]][1]), default=None)
            for k, (x, y) in enumerate(DEPENDENCIES):
                if x in mine and y in mine and ((k, mine[x]) not in rules or rules[k, mine[x]][0] < best):
                    rules[k, mine[x]] = (best, mine[y])
        n = {r["row_id"]: len({p.strip() for p in r["source_pmids"] or [] if p and p.strip()}) for r in rows}
        top = max(((*nulls(n[r["row_id"]], trust.get(r["source"]), 0, r["t"]), r["row_id"]) for r in rows if n[r["row_id"]]), default=None)
        assert got[g].pop("source_pmids", None) == (top and top[-1])
        assert set(got[g]) == set(offers)

        def worth(picks, offers=offers, rules=rules):
            vals = {f: v for b, row in picks.items() for f, v in offers[b][row][1].items()}
            bad = sum(1 for k, (x, y) in enumerate(DEPENDENCIES) if x in vals and y in vals and (k, vals[x]) in rules and rules[k, vals[x]][1] != vals[y])
            return (-bad, tuple(map(sum, zip(*(offers[b][row][0] for b, row in picks.items())))))

        tied = [b for b in offers if any(v for _, v in offers[b].values())]
        for b in set(offers) - set(tied):
            assert got[g][b] == max(offers[b], key=lambda row: offers[b][row][0])
        if tied:
            several += len(tied) > 1
            # candidates that agree in all fields that count are dominated by the best of them
            best = {b: {tuple(sorted(v.items())): row for row, (_, v) in sorted(offers[b].items(), key=lambda x: x[1][0])} for b in tied}
            most = max(worth(dict(zip(tied, c))) for c in itertools.product(*(best[b].values() for b in tied)))
            assert worth({b: got[g][b] for b in tied}) == most
    assert several > 5


def test_nodes_come_out_of_the_search(spark):
    """p3_found has no aggregate that picks the winners beforehand."""
    from kgspark.llm.queries import p3_found

    from ..oracle import SF

    plan = p3_found(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "max(" not in plan


def stream_of(offers, size):
    """Offers (g, b, m0, row) as a stream of batches of ``size`` rows."""
    import pyarrow as pa

    offers = sorted(offers, key=lambda o: (o[0], o[1] or "", o[2] is None, -(o[2] or 0), -o[3]))
    rows = [(*o, 1 + sum(1 for p in offers[:i] if p[0] == o[0])) for i, o in enumerate(offers)]
    schema = pa.schema([("g", pa.string()), ("b", pa.string()), ("m0", pa.int64()), ("row", pa.int64()), ("place", pa.int32())])
    return [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows[i : i + size]], schema) for i in range(0, len(rows), size)]


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_search_sees_bundles_and_rivals(monkeypatch, size):
    """Without dependencies too, a group's bundles are searched together, each with its best candidates and no more."""
    random.seed(size)
    seen = []
    monkeypatch.setattr(survivors, "search", lambda b, *x: seen.append({k: len(v) for k, v in b.items()}) or search(b, *x))
    monkeypatch.setattr(survivors, "TOGETHER", 3)
    offers = [("a", b, random.choice([None, *range(4)]), r) for b in "pqrst" for r in range(9)]
    offers += [("b", "p", 1, 5), ("b", "q", 1, 5), ("c", None, None, 1), ("c", "p", 2, 2), ("d", "p", None, 7), ("d", "p", 0, 6)]
    offers += [("e", b, 0, 1) for b in "pqrst"] + [("e", "t", None, 2)]
    got = [(r["g"], r["b"], r["row"]) for batch in survivors.stream(stream_of(offers, size), 2, True) for r in batch.to_pylist()]
    best = {}
    for g, b, m, r in offers:
        if b is not None and g != "b":
            best[g, b] = max(best.get((g, b), (-1, 0, 0)), (-(m is None), m or 0, r))
    assert sorted(got) == sorted((g, b, x[2]) for (g, b), x in best.items())
    assert seen == [{"p": 3, "q": 3, "r": 3}, {"s": 3, "t": 3}, {"p": 1}, {"p": 2}, {"p": 1, "q": 1, "r": 1}, {"s": 1, "t": 2}]


def test_merits_that_hide_no_others(spark):
    """Not-a-numbers, infinities and great numbers leave the other bundles' merits to decide."""
    nan, inf = float("nan"), float("inf")
    rows = [("p", nan), ("p", inf), ("p", 1e300), ("q", 1.0), ("q", 2.0), ("r", -inf), ("r", None), ("s", inf), ("s", 3.0), ("t", 0.5), ("t", 0.25)]
    df = spark.createDataFrame([("a", b, m, i, 10 - i) for i, (b, m) in enumerate(rows)], "id string, bundle string, m double, row_id long, later int")
    out = choose_bundles(df, group="id", row="row_id", bundle="bundle", merit=["m", "later"])
    assert {r["bundle"]: r["row_id"] for r in out.collect()} == {"p": 0, "q": 4, "r": 5, "s": 7, "t": 9}


def test_many_bundles(spark):
    rows = [("a", r, f"b{b:03}", (r * b) % 5, None, None) for r in range(1, 4) for b in range(150)]
    want = {f"b{b:03}": max(range(1, 4), key=lambda r, b=b: ((r * b) % 5, r)) for b in range(150)}
    assert pick(spark, rows, several=True) == [("a", b, r) for b, r in sorted(want.items())]


def test_ids_of_very_many_rows(spark, tmp_path):
    """Rows of a hot id that can't be chosen are left out, but count as rows."""
    from pyspark.sql import functions as F

    from kgspark.llm.queries import _offers, p3_found

    random.seed(5)
    rows = []
    for i in range(1500):
        names = random.sample("abc", random.randint(0, 3))
        props = None if random.random() < 0.05 else {k: random.choice(["x", "N/A", None]) for k in names}
        at = None if random.random() < 0.1 else f"2024-01-{random.randint(1, 9):02}"
        rows.append((random.choice([None, "h", "h", "h", "i", f"j{i // 4}"]), None if i % 50 == 0 else i, props, random.choice([None, ["p"], ["p", "q", " "]]), random.choice(["s", "t", "u", None]), at))
    rows += [("same", 5000 + i % 2, {"a": "x"}, None, "s", "2024-01-01") for i in range(200)] + [("one", 6000, {"a": "x"}, ["p"], "s", "2024-01-01")] * 200
    nodes = spark.createDataFrame(rows, "id string, row_id long, properties map<string,string>, source_pmids array<string>, source string, at string")
    nodes.withColumn("updated_at", F.to_timestamp("at")).drop("at").write.parquet(f"{tmp_path}/graph_nodes.parquet")
    spark.createDataFrame([("s", 1), ("t", 2)], "source string, trust_rank int").write.parquet(f"{tmp_path}/source_trust.parquet")
    want = sorted(tuple(r) for r in p3_found(spark, str(tmp_path)).collect())
    offers = _offers(spark, str(tmp_path), None, hot_rows=100)
    got = choose_bundles(offers, group="id", row="row_id", bundle="bundle", merit=["m0", "m1", "m2", "m3"], several=True)
    assert sorted((r["id"], r["bundle"].lstrip("="), r["row_id"]) for r in got.collect()) == want
    assert ("same", "a", 5001) in want and "one" not in {r[0] for r in want}
    assert offers.where("id = 'same'").count() < 20 and offers.count() < _offers(spark, str(tmp_path), None).count() / 2
