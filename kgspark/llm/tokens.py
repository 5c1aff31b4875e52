"""Text sizes in tokens of a public tokenizer, whose file is given by path."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The split pattern that the byte-level vocabularies were published with.
DEFAULT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_LOADED: dict[tuple[str, str], Callable[[list[str]], list[int]]] = {}


def counter(path: str, pattern: str = DEFAULT_PATTERN) -> Callable[[list[str]], list[int]]:
    """A function from texts to token counts; the file is read once per worker process."""
    if (path, pattern) not in _LOADED:
        if path.endswith(".tiktoken"):
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            enc = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            _LOADED[path, pattern] = lambda texts: [len(enc.encode_ordinary(t)) for t in texts]
        elif path.endswith(".model"):
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            _LOADED[path, pattern] = lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            tok.encode_special_tokens = True
            _LOADED[path, pattern] = lambda texts: [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    return _LOADED[path, pattern]


def with_token_counts(docs: DataFrame, text: str, keep: list[str], path: str = DEFAULT_PATH, pattern: str = DEFAULT_PATTERN) -> DataFrame:
    """The columns ``keep`` and n_tokens of the whole text; null texts count 0. Texts themselves don't go on."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        n = counter(path, pattern)
        for s in batches:
            yield pd.Series(n([t or "" for t in s]), index=s.index, dtype="int64")

    return docs.select(*keep, count(F.col(text)).alias("n_tokens"))
