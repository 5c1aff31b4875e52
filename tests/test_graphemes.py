"""Graphemes over stretches of texts against one text at a time; rows leave a worker in small parts."""

import random

import pandas as pd
import pytest

from kgspark.operators import text

PARTS = ["a", "b1", " ", "\n", "\r\n", "́", "é", "‍", "👍🏽", "👩‍👩‍👧", "🇩🇪", "🇫", "한", "한", "中文", "क्षि", "नी", "я", ".", " ", "　", "؀", "٣", "²", " ", "\t", "\x00", "﻿", "𝟘", "_"]


@pytest.mark.parametrize("size", [1 << 19, 40, 7])
def test_graphemes(spark, size):
    random.seed(5)
    texts = ["".join(random.choice(PARTS) for _ in range(random.randint(0, 60))) for _ in range(300)] + ["", None, "\n", " ́x", "a" * 50 + "\n\n" + "b" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = sorted(tuple(r) for r in text.graphemes(df, ["i"], "t", size).collect())
    assert got == sorted((i, n, k, b, e, f, t[b:e]) for i, t in enumerate(texts) if t for n, (k, b, e, f) in enumerate(text.grapheme_tokens(t)))


def test_rows_leave_in_parts(spark):
    class Held:
        """Stands for a frame's mapInPandas: what the function yields, without Spark."""
        schema = spark.createDataFrame([(1, "a")], "i long, t string").schema

        def select(self, *_):
            return self

        def mapInPandas(self, run, _):  # noqa: N802
            return list(run(iter([pd.DataFrame({"i": range(400), "t": ["a b " * 100] * 400})])))

    sizes = [len(f) for f in text.tokenize(Held(), ["i"], "t")]
    assert sum(sizes) == 400 * 200 and max(sizes) <= text.ROWS_OUT
