"""The engine's functions under SQL: table functions for texts, and scalar functions that Spark lacks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf, udtf

from ..operators import text as T


def register(spark: SparkSession) -> list[str]:
    """Registers the functions and gives their names.

    ``kg_tokens(text)``, ``kg_sentences(text)`` and ``kg_chunks(text, limit)`` are table functions for LATERAL joins;
    ``kg_nfc(text)`` composes characters. Null texts give no rows, or null.
    """

    class Tokens:
        def eval(self, text: str) -> Iterator[tuple]:
            for i, (k, b, e, f) in enumerate(T.regex_tokens(text or "")):
                yield i, k, b, e, f, text[b:e]

    class Sentences:
        def eval(self, text: str) -> Iterator[tuple]:
            tok = T.regex_tokens(text or "")
            for i, (a, b) in enumerate(T.sentences(text or "", tok)):
                yield i, tok[a][1], tok[b - 1][2], T.slice_text(text, tok, a, b)

    class Chunks:
        def eval(self, text: str, limit: int) -> Iterator[tuple]:
            tok = T.regex_tokens(text or "")
            for i, (a, b) in enumerate(T.chunks(text or "", tok, limit)):
                yield i, tok[a][1], tok[b - 1][2], T.slice_text(text, tok, a, b)

    def compose(texts: pd.Series) -> pd.Series:
        import unicodedata

        return texts.map(lambda t: t if t is None else unicodedata.normalize("NFC", t))

    tables = {
        "kg_tokens": udtf(Tokens, returnType="token_idx int, token_type int, start_pos int, end_pos int, after_newline boolean, token string"),
        "kg_sentences": udtf(Sentences, returnType="sentence_idx int, start_pos int, end_pos int, sentence string"),
        "kg_chunks": udtf(Chunks, returnType="chunk_idx int, start_pos int, end_pos int, chunk_text string"),
    }
    for name, f in tables.items():
        spark.udtf.register(name, f)
    spark.udf.register("kg_nfc", pandas_udf(compose, "string"))
    return [*tables, "kg_nfc"]
