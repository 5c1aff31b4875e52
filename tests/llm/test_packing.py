"""Packings are valid, whole and tight."""

import random
from collections import defaultdict

import pytest

from kgspark.llm.packing import fill_report, pack, sweep
from kgspark.llm.tokens import DEFAULT_PATH, counter, with_token_counts


def check(rows, sizes, capacity):
    load, parts, places = defaultdict(int), defaultdict(list), set()
    for r in rows:
        if r["sequence_id"] is None:
            assert sizes[r["key"]] <= 0
            continue
        load[r["sequence_id"]] += r["part_size"]
        parts[r["key"]].append((r["part_start"], r["part_size"]))
        assert (r["sequence_id"], r["position"]) not in places
        places.add((r["sequence_id"], r["position"]))
    assert all(v <= capacity for v in load.values())
    assert sorted(load) == list(range(len(load)))
    for k, s in sizes.items():
        at = 0
        for b, n in sorted(parts[k]):
            assert b == at
            at += n
        assert at == max(s, 0)
        assert len(parts[k]) == -(-max(s, 0) // capacity)
    return len(load)


def by_hand(items, gaps):
    """Best fit item by item: the gaps that remain (which of equal ones an item takes doesn't matter), the items left."""
    room = sorted([g, b + i] for g, b, n, _ in gaps for i in range(n))
    left = []
    for s in sorted((s for s, _, n in items for _ in range(n)), reverse=True):
        hit = next((r for r in room if r[0] >= s), None)
        if hit:
            hit[0] -= s
            room.sort()
        else:
            left.append(s)
    return sorted(g for g, _ in room if g), sorted(left)


def test_sweep_is_best_fit():
    random.seed(4)
    for _ in range(500):
        cap = random.randint(4, 60)
        items = [(s, random.randint(0, 5), random.randint(1, 9)) for s in random.sample(range(1, cap + 1), random.randint(1, 4))]
        gaps, at = [], 0
        for g in random.sample(range(1, cap + 1), random.randint(0, 4)):
            n = random.randint(1, 4)
            gaps.append((g, at, n, 1))
            at += n
        moves, left, rest = sweep(items, gaps)
        load, seen, places = defaultdict(list), [], set()
        for s, first, n, box, place, per in moves:
            for i in range(n):
                load[box + i // per].append(s)
                seen.append((s, first + i))
                assert (box + i // per, place + i % per) not in places
                places.add((box + i // per, place + i % per))
        seen += [(s, r + i) for s, r, n in left for i in range(n)]
        assert sorted(seen) == sorted((s, r + i) for s, r, n in items for i in range(n))
        room = {b + i: g for g, b, n, _ in gaps for i in range(n)}
        assert sorted((room[b + i] - sum(load[b + i]), b + i) for b, n in ((b, n) for _, b, n, _ in gaps) for i in range(n) if room[b + i] > sum(load[b + i])) == sorted((g, b + i) for g, b, n, _ in rest for i in range(n))
        assert all(s > max((g for g, _, n, _ in rest if n), default=0) for s, _, _ in left)
        assert (sorted(g for g, _, n, _ in rest for _ in range(n)), sorted(s for s, _, n in left for _ in range(n))) == by_hand(items, gaps)
    assert sweep([], []) == ([], [], [])


def test_large_capacity(spark):
    df = spark.range(3000).selectExpr("id AS key", "1 + (id * 7919) % 131072 AS size")
    rows = pack(df, key="key", size="size", capacity=131_072).collect()
    sizes = {i: 1 + i * 7919 % 131072 for i in range(3000)}
    assert check(rows, sizes, 131_072) <= 1.01 * sum(sizes.values()) / 131_072 + 1


def test_frame(spark):
    random.seed(6)
    sizes = {i: random.choice([0, 7, 7, 7, 7, random.randint(1, 99), random.randint(100, 450)]) for i in range(400)}
    df = spark.createDataFrame([(k, s, k) for k, s in sizes.items()], "key long, size long, rank long").repartition(5)
    rows = pack(df, key="key", size="size", capacity=100).collect()
    used = check(rows, sizes, 100)
    assert used <= 1.05 * sum(sizes.values()) / 100 + 1
    again = pack(df.repartition(3), key="key", size="size", capacity=100).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    rep = fill_report(pack(df, key="key", size="size", capacity=100), 100).first()
    assert rep["n_sequences"] == used and rep["n_tokens"] == sum(sizes.values())


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (3, -4), (4, 100), (5, 201)], "key long, size long")
    check(pack(df, key="key", size="size", capacity=100).collect(), {1: 0, 2: 0, 3: 0, 4: 100, 5: 201}, 100)
    assert pack(df.limit(0), key="key", size="size", capacity=10).count() == 0
    with pytest.raises(ValueError):
        pack(df, key="key", size="size", capacity=0)


def test_tokens(spark):
    df = spark.createDataFrame([(1, "thymol raised ADG. " * 4000), (2, ""), (3, None), (4, "é 采集 <|endoftext|>")], "id long, t string")
    got = {r["id"]: r["n_tokens"] for r in with_token_counts(df, "t", ["id"]).collect()}
    assert got[2] == got[3] == 0 and got[1] == counter(DEFAULT_PATH)(["thymol raised ADG. " * 4000])[0] > 16000
    other = DEFAULT_PATH.replace("byte_bpe_50k.tiktoken", "byte_bpe_50k.json")
    texts = ["Pigs' ADG rose by 3.5 %;\n\n then  fell.", "é 采集 <|endoftext|>"]
    assert counter(DEFAULT_PATH)(texts) == counter(other)(texts)
    assert all(n > 0 for n in counter(DEFAULT_PATH.replace("byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))(texts))
