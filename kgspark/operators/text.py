"""Tokens, sentences and chunks of documents, and windows over chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TOKEN = regex.compile(r"[^\W\d_]+|\d+|([^\w\s]|_)\1*")
_GRAPHEME = regex.compile(r"\X")
# Two characters that both break on either side (or are controls) never share a grapheme; only what else there is, with its neighbours, needs a look.
_JOINING = regex.compile(r"(?s)(?:.?[^\p{GCB=Other}\x00-\x1f\x7f]++)+.?")
_SAFE_CUT = regex.compile(r"(?<=\p{GCB=Other})\p{GCB=Other}")
#: Characters looked at together, and rows made of texts that go out together: what a Python worker holds.
PIECE, ROWS_OUT = 1 << 19, 1 << 15
# Single marks that end a sentence, and words whose point does not.
ENDS = (".", "?", "!", "。", "！", "？", "।")
ABBREVIATIONS = ("Mr.", "Mrs.", "Ms.", "Dr.", "Prof.", "St.")
WORD, NUMBER, PUNCTUATION = 0, 1, 2

Token = tuple[int, int, int, bool]
TokenizeFn = Callable[[str], list[Token]]


def _kind(text: str, start: int) -> int:
    return NUMBER if text[start].isdigit() else WORD if text[start].isalpha() else PUNCTUATION


def regex_tokens(text: str) -> list[Token]:
    """(kind, start, end, after_newline): runs of letters, of digits, and of one same symbol."""
    out, last = [], 0
    for m in _TOKEN.finditer(text):
        b, e = m.span()
        first = text[b]
        kind = PUNCTUATION if m.group(1) else NUMBER if first.isdecimal() else WORD
        gap = text[last:b]
        out.append((kind, b, e, "\n" in gap or "\r" in gap))
        last = e
    return out


def grapheme_tokens(text: str) -> list[Token]:
    """One token per user-perceived character that isn't white space."""
    out, last = [], 0
    for m in _GRAPHEME.finditer(text):
        if not m.group().isspace():
            b, e = m.span()
            gap = text[last:b]
            out.append((_kind(text, b), b, e, "\n" in gap or "\r" in gap))
            last = e
    return out


def sentence_end(text: str, tokens: Sequence[Token], start: int, abbreviations: frozenset[str] = frozenset(ABBREVIATIONS)) -> int:
    """The index after the last token of the sentence that starts at token ``start``.

    A sentence ends with a single closing mark, unless that is the point of a known abbreviation, or before a token on
    a new line that is followed by a capital; so it can be empty.
    """
    for i in range(start, len(tokens)):
        kind, b, e, fresh = tokens[i]
        if kind == PUNCTUATION and text[b:e] in ENDS:
            before = text[tokens[i - 1][1] : tokens[i - 1][2]] if i else ""
            if not (text[b:e] == "." and before + "." in abbreviations):
                return i + 1
        elif fresh and i + 1 < len(tokens) and text[tokens[i + 1][1]].isupper():
            return i
    return len(tokens)


def sentences(text: str, tokens: Sequence[Token]) -> Iterator[tuple[int, int]]:
    """Token ranges of the sentences; one that would be empty takes one token, so that there is progress."""
    at = 0
    while at < len(tokens):
        end = max(sentence_end(text, tokens, at), at + 1)
        yield at, end
        at = end


def chunks(text: str, tokens: Sequence[Token], limit: int) -> Iterator[tuple[int, int]]:
    """Token ranges that pack whole sentences into at most ``limit`` characters.

    A sentence over the limit stands alone: it is split at line breaks if it has any, and a first token that is itself
    over the limit becomes a chunk of its own; what can't be split is given whole.
    """
    width = lambda a, b: tokens[b - 1][2] - tokens[a][1]
    todo: list[tuple[int, int]] = list(sentences(text, tokens))[::-1]
    held: tuple[int, int] | None = None
    while todo:
        a, b = todo.pop()
        if held is not None:
            if width(held[0], b) <= limit:
                held = (held[0], b)
                continue
            yield held
            held = None
        if width(a, b) <= limit:
            held = (a, b)
        elif width(a, a + 1) > limit:
            if a + 1 < b:
                todo.append((a + 1, b))
            yield a, a + 1
        else:
            cuts = [a, *(i for i in range(a + 1, b) if tokens[i][3]), b]
            if len(cuts) == 2:
                yield a, b
            else:
                todo += list(zip(cuts, cuts[1:]))[::-1]
    if held is not None:
        yield held


def slice_text(text: str, tokens: Sequence[Token], start: int, end: int) -> str:
    """The text from token ``start`` to before token ``end``; '' for an empty range, ValueError outside the tokens."""
    if not 0 <= start <= end <= len(tokens):
        raise ValueError(f"tokens {start} to {end} of {len(tokens)}")
    return text[tokens[start][1] : tokens[end - 1][2]] if start < end else ""


def char_range(tokens: Sequence[Token], start: int, end: int) -> tuple[int, int]:
    """The character range of a range of tokens; ValueError if it is empty or outside the tokens."""
    if not 0 <= start < end <= len(tokens):
        raise ValueError(f"tokens {start} to {end} of {len(tokens)}")
    return tokens[start][1], tokens[end - 1][2]


def _mapped(df: DataFrame, keep: list[str], text: str, schema: str, rows_of: Callable[[str], Iterable[tuple]]) -> DataFrame:
    """One output row per tuple that ``rows_of`` makes of a text, with the kept columns; nulls and blanks give none."""
    kept = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = ((*r[:-1], *x) for r in pdf.itertuples(index=False, name=None) if r[-1] for x in rows_of(r[-1]))
            while rows := list(islice(made, ROWS_OUT)):
                yield pd.DataFrame(rows, columns=[*keep, *names])

    return df.select(*keep, F.col(text).alias("__text")).mapInPandas(run, f"{kept}, {schema}")


def tokenize(df: DataFrame, keep: list[str], text: str, tokens_of: TokenizeFn = regex_tokens) -> DataFrame:
    """Long form: token_idx, token_type (0 word, 1 number, 2 punctuation), start_pos, end_pos, after_newline, token."""
    rows = lambda t: ((i, k, b, e, f, t[b:e]) for i, (k, b, e, f) in enumerate(tokens_of(t)))
    return _mapped(df, keep, text, "token_idx int, token_type int, start_pos int, end_pos int, after_newline boolean, token string", rows)


def _pieces(text: str, size: int) -> Iterator[tuple[int, str]]:
    """A text cut between graphemes, about ``size`` characters each, with the place of each."""
    at = 0
    while at < len(text):
        cut = _SAFE_CUT.search(text, at + size) if len(text) - at > size else None
        end = cut.start() if cut else len(text)
        yield at, text[at:end]
        at = end


def graphemes(df: DataFrame, keep: list[str], text: str, size: int = PIECE) -> DataFrame:
    """``tokenize`` by user-perceived character (``grapheme_tokens``), over whole stretches of texts at a time."""
    kept = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    names = ["token_idx", "token_type", "start_pos", "end_pos", "after_newline", "token"]

    def rows(parts: list[tuple[int, int, int, int, bool, str]]) -> tuple[np.ndarray, list[pa.Array], np.ndarray]:
        """Of pieces (row, place in the text, first index, -, new line pending, text), joined by new lines that no piece holds:
        the number of the piece of each token, its columns, and whether each piece ends with a new line pending."""
        whole = "\n".join(p[-1] for p in parts)
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        start = np.ones(len(codes) + 1, bool)
        for m in _JOINING.finditer(whole):
            start[m.start() + 1 : m.end()] = False
            start[[g.start() for g in _GRAPHEME.finditer(whole, m.start(), m.end())]] = True
        used, of = np.unique(codes, return_inverse=True)
        chars = [chr(c) for c in used]
        space = np.array([c.isspace() for c in chars], bool)[of]
        kind = np.array([NUMBER if c.isdigit() else WORD if c.isalpha() else PUNCTUATION for c in chars], np.int32)[of]
        begins = np.flatnonzero(start)
        b, e = begins[:-1], begins[1:]
        real = ~space[b] | (e - b > 1)
        b, e = b[real], e[real]
        sizes = np.array([len(p[-1]) for p in parts])
        first = np.cumsum(sizes + 1) - sizes - 1
        piece = np.searchsorted(first, b, "right") - 1
        lines = np.concatenate(([0], np.cumsum((codes == 10) | (codes == 13))))
        one = np.concatenate(([True], piece[1:] != piece[:-1])) if len(b) else np.zeros(0, bool)
        since = np.where(one, first[piece], np.concatenate(([0], e[:-1]))) if len(b) else b
        fresh = lines[b] > lines[since]
        fresh[one] |= np.array([p[4] for p in parts], bool)[piece[one]]
        ends = first + sizes
        last = first.copy()
        np.maximum.at(last, piece, e)
        had = np.zeros(len(parts), bool)
        had[piece] = True
        pending = (lines[ends] > lines[last]) | (~had & np.array([p[4] for p in parts], bool))
        count = np.bincount(piece, minlength=len(parts))
        index = np.arange(len(b)) - (np.cumsum(count) - count)[piece] + np.array([p[2] for p in parts])[piece]
        place = (np.array([p[1] for p in parts]) - first)[piece]
        width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        inside = np.zeros(len(codes) + 1, np.int8)
        inside[b] += 1
        inside[e] -= 1
        held = np.cumsum(inside[:-1]) > 0
        data = codes[held].tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        upto = np.concatenate(([0], np.cumsum(width)))
        offsets = np.concatenate(([0], np.cumsum(upto[e] - upto[b]))).astype(np.int32)
        tokens = pa.StringArray.from_buffers(len(b), pa.py_buffer(offsets), pa.py_buffer(data))
        columns = [pa.array(index.astype(np.int32)), pa.array(kind[b]), pa.array((b + place).astype(np.int32)), pa.array((e + place).astype(np.int32)), pa.array(fresh), tokens]
        return piece, columns, np.stack([count, pending])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            def made(parts: list[tuple]) -> pa.RecordBatch:
                piece, columns, _ = rows(parts)
                at = pa.array(np.array([p[0] for p in parts])[piece])
                return pa.RecordBatch.from_arrays([*(batch[c].take(at) for c in keep), *columns], names=[*keep, *names])

            parts, held = [], 0
            for i, cell in enumerate(batch["__text"]):
                if not (t := cell.as_py()):
                    continue
                if len(t) > size:  # by itself, piece by piece
                    index, pending = 0, False
                    for at, x in _pieces(t, size):
                        piece, columns, after = rows([(i, at, index, 0, pending, x)])
                        index, pending = index + int(after[0, 0]), bool(after[1, 0])
                        yield pa.RecordBatch.from_arrays([*(batch[c].take(pa.array(np.full(len(piece), i))) for c in keep), *columns], names=[*keep, *names])
                    continue
                parts.append((i, 0, 0, 0, False, t))
                held += len(t)
                if held > size:
                    yield made(parts)
                    parts, held = [], 0
            if parts:
                yield made(parts)

    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, f"{kept}, token_idx int, token_type int, start_pos int, end_pos int, after_newline boolean, token string")


def words(text: Column) -> Column:
    """Runs of letters or digits, lower case, without leaving the JVM (no offsets)."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"\p{L}+|\p{Nd}+"), F.lit(0)), F.lower)


def stem(token: Column) -> Column:
    """A light plural stem: a final s goes from words of more than three letters, unless it is doubled."""
    t = F.lower(token)
    return F.when((F.char_length(t) > 3) & t.endswith("s") & ~t.endswith("ss"), t.substr(F.lit(1), F.char_length(t) - 1)).otherwise(t)


def split_sentences(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    """Long form: sentence_idx, token range, start_pos, end_pos, sentence."""
    def rows(t: str) -> list[tuple]:
        tok = regex_tokens(t)
        return [(i, a, b, tok[a][1], tok[b - 1][2], t[tok[a][1] : tok[b - 1][2]]) for i, (a, b) in enumerate(sentences(t, tok))]
    return _mapped(df, keep, text, "sentence_idx int, token_start int, token_end int, start_pos int, end_pos int, sentence string", rows)


def chunk(df: DataFrame, keep: list[str], text: str, limit: int = 16000, tokens_of: TokenizeFn = regex_tokens) -> DataFrame:
    """Long form: chunk_idx, token range, start_pos, end_pos, chunk_text."""
    def rows(t: str) -> list[tuple]:
        tok = tokens_of(t)
        return [(i, a, b, tok[a][1], tok[b - 1][2], t[tok[a][1] : tok[b - 1][2]]) for i, (a, b) in enumerate(chunks(t, tok, limit))]
    return _mapped(df, keep, text, "chunk_idx int, token_start int, token_end int, start_pos int, end_pos int, chunk_text string", rows)


def previous_context(df: DataFrame, document: str, order: str, text: str, size: int) -> DataFrame:
    """Adds prompt_context: the last ``size`` characters of the document's chunk before, marked as such; '' for the first."""
    before = F.lag(text).over(Window.partitionBy(document).orderBy(order))
    return df.withColumn("prompt_context", F.when(before.isNull(), "").otherwise(F.concat(F.lit("[Previous text]: ..."), F.right(before, F.lit(size)))))


def batches(df: DataFrame, group: list[str], order: list[str], size: int) -> DataFrame:
    """Adds batch_idx: rows of a group in their order, ``size`` to a batch."""
    return df.withColumn("batch_idx", F.floor((F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1) / size).cast("long"))


def top_rows(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group: a report's truncation. Spark limits each task's groups before the shuffle."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("__n") <= k).drop("__n")
