"""Pieces against one-by-one cutting, and their properties."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kgspark.llm.splitting import boundaries, cuts, split_items, successors


def one_by_one(t, limit, overlap):
    pos, kind, _ = boundaries(t, limit - overlap)
    nxt = successors(pos, kind, pos - overlap, limit)
    i, out = int(successors(pos, kind, np.zeros(1, dtype=np.int64), limit)[0]), []
    while True:
        out.append(int(pos[i]))
        if i == len(pos) - 1:
            return out
        i = int(nxt[i])


@settings(max_examples=400, deadline=None)
@given(st.text("abc. \n。!", min_size=40, max_size=400) | st.text("abcdef", min_size=40, max_size=300), st.integers(6, 39), st.data())
def test_pieces(t, limit, data):
    overlap = data.draw(st.integers(0, limit // 2))
    pieces, _ = cuts(t, limit, overlap)
    assert [e for _, e, _ in pieces] == one_by_one(t, limit, overlap)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(t)
    assert all(0 < e - b <= limit for b, e, _ in pieces)
    assert all(y[0] == x[1] - overlap and y[1] > x[1] for x, y in zip(pieces, pieces[1:]))
    assert t == t[: pieces[0][1]] + "".join(t[x[1] : y[1]] for x, y in zip(pieces, pieces[1:]))


def test_prefers_natural_boundaries():
    t = "First paragraph here.\n\nSecond one. It goes on and on."
    got = [t[b:e] for b, e, _ in cuts(t, 30, 0)[0]]
    assert got[0] == "First paragraph here.\n\n"
    t = "One sentence is here. Another sentence follows it"
    assert [t[b:e] for b, e, _ in cuts(t, 30, 0)[0]][0] == "One sentence is here. "


def test_frame(spark):
    rows = [("a", "word " * 30, 40, 5), ("b", None, 40, 5), ("c", "", 40, 5), ("d", "x" * 90, 40, 5), ("e", "short", 40, 5), ("f", "x" * 40, 40, 5), ("g", "y" * 90, None, 5), ("h", "é😀" * 40, 40, 0), ("a", "word " * 30, 40, 5)]
    df = spark.createDataFrame(rows, "piece_text string, t string, lim int, ov int")
    items = df.withColumnRenamed("piece_text", "k")
    out = split_items(items, keys=["k"], text="t", limit=F.col("lim"), overlap=F.col("ov")).collect()
    kinds = {r["k"]: r["cut_kind"] for r in out}
    assert kinds == {"a": "natural", "d": "forced", "h": "forced"}
    assert all(len(r["piece_text"]) <= 40 for r in out) and sum(r["piece_no"] == 0 for r in out if r["k"] == "a") == 2
    assert split_items(items.limit(0), keys=["k"], text="t", limit=F.col("lim"), overlap=F.col("ov")).count() == 0
    with pytest.raises(Exception, match="overlap"):
        split_items(items, keys=["k"], text="t", limit=F.lit(5), overlap=F.lit(5)).collect()


def test_very_long_text():
    t = "lorem ipsum dolor. " * 60_000
    pieces, _ = cuts(t, 1000, 100)
    assert len(pieces) > 1200 and pieces[-1][1] == len(t)
