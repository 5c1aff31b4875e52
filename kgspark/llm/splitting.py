"""Splitting oversized items at natural boundaries by pointer doubling."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARAGRAPH, SENTENCE, WORD, MARK, FORCED = 0, 1, 2, 3, 4
CUTS = ("paragraph", "sentence", "word", "mark", "forced", "end")
_MARKS = ".!?。！？"
_CLOSERS = "\"'”’)]）】»"
_TOP = 0xFF20


def _members(test) -> np.ndarray:
    """A table of the code points below _TOP that pass a test; all others fail it."""
    return np.array([test(chr(c)) for c in range(_TOP)] + [False])


_SPACE, _MARK = _members(str.isspace), _members(lambda c: c in _MARKS)
_WIDE, _CLOSER = _members(lambda c: c in "。！？"), _members(lambda c: c in _CLOSERS)


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def boundaries(text: str, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions after which a text may be cut, the kind of each, and the length of the stretch it lies inside, if any.

    A boundary lies after a run of white space (paragraph: the run holds a blank line; sentence: it follows . ! ? or
    their wide forms; else word) and after such a mark itself. A stretch longer than ``step`` gets forced boundaries
    every ``step`` characters.
    """
    n = len(text)
    full = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    code = np.minimum(full, _TOP)
    space, mark = _SPACE[code], _MARK[code]
    b, e = _runs(space)
    mb, me = _runs(mark)
    lines = np.concatenate([[0], np.cumsum(code == 10) + 2 * np.cumsum(code == 0x2029)])
    before = np.maximum(b - 1, 0)
    before = np.where(_CLOSER[code[before]] & (b > 1), before - 1, before)
    kind = np.where(lines[e] - lines[b] >= 2, PARAGRAPH, np.where(mark[before] & (b > 0), SENTENCE, WORD))
    pos = np.concatenate([me, e])
    kinds = np.concatenate([np.where(_WIDE[code[me - 1]], SENTENCE, MARK), kind])
    starts = np.concatenate([mb, b])
    order = np.argsort(pos, kind="stable")
    pos, kinds, starts = pos[order], kinds[order], starts[order]
    ends, opens = np.concatenate([[0], pos]), np.concatenate([starts, [n]])
    within = np.zeros(len(pos), dtype=np.int64)
    stops = np.concatenate([pos, [n]])
    wide = np.flatnonzero(stops - ends > step)  # to the boundary itself: it lies behind the white space
    if len(wide):
        more = [np.arange(ends[i] + step, stops[i], step) for i in wide]
        # a cut in the white space behind a stretch isn't inside it
        long = np.concatenate([np.where(m < opens[i], opens[i] - ends[i], 0) for i, m in zip(wide, more)])
        more = np.concatenate(more)
        pos, kinds, within = np.concatenate([pos, more]), np.concatenate([kinds, np.full(len(more), FORCED)]), np.concatenate([within, long])
        order = np.argsort(pos, kind="stable")
        pos, kinds, within = pos[order], kinds[order], within[order]
    inside = pos < n
    pos, kinds, within = np.concatenate([pos[inside], [n]]), np.concatenate([kinds[inside], [PARAGRAPH]]), np.concatenate([within[inside], [0]])
    return pos.astype(np.int64), kinds.astype(np.int8), within.astype(np.int64)


def successors(pos: np.ndarray, kind: np.ndarray, start: np.ndarray, limit: int) -> np.ndarray:
    """For each end of a piece, given where the next piece starts, the index of the next end.

    The next end is the farthest boundary of the best kind within ``limit`` of the start. A kind is passed over for a
    lesser one while its farthest boundary leaves more than half of the limit unused, so that pieces don't get tiny.
    """
    n = len(pos)
    reach = np.searchsorted(pos, start + limit, side="right") - 1
    floor = np.arange(1, n + 1) if len(start) == n else np.zeros(len(start), dtype=np.int64)
    out = np.full(len(start), -1, dtype=np.int64)
    for k in (PARAGRAPH, SENTENCE, WORD, MARK):
        own = np.flatnonzero(kind <= k)
        if not len(own):
            continue
        i = np.searchsorted(own, reach, side="right") - 1
        far = np.where(i >= 0, own[np.maximum(i, 0)], -1)
        good = (out < 0) & (far >= floor) & (pos[far] - start >= limit // 2)
        out[good] = far[good]
    out[out < 0] = reach[out < 0]
    out[start + limit >= pos[-1]] = n - 1
    return np.maximum(out, np.minimum(floor, n - 1))


def cuts(text: str, limit: int, overlap: int) -> tuple[list[tuple[int, int, int]], bool]:
    """The pieces (start, end, kind of cut) of one text, and whether a cut was forced: lies inside a stretch without a
    boundary that is longer than the limit. A piece can't hold such a stretch, so every one has a cut inside.

    Pointer doubling: every boundary is joined to its farthest legal successor, the overlap included, which makes a
    table from boundary to boundary. The set of cuts reached within 2^k steps doubles by following the table's 2^k-th
    power, and the table is squared, until the set stays as it is; so all greedy cuts come out in about log2(pieces)
    vectorised steps instead of one after another.
    """
    step = limit - overlap
    pos, kind, within = boundaries(text, step)
    table = successors(pos, kind, pos - overlap, limit)
    table[-1] = len(pos) - 1
    first = int(successors(pos, kind, np.zeros(1, dtype=np.int64), limit)[0])
    reached = np.array([first], dtype=np.int64)
    while True:
        grown = np.union1d(reached, table[reached])
        if len(grown) == len(reached):
            break
        reached, table = grown, table[table]
    ends = pos[reached]
    starts = np.concatenate([[0], ends[:-1] - overlap])
    kinds = kind[reached].astype(int)
    kinds[-1] = 5
    return list(zip(starts.tolist(), ends.tolist(), kinds.tolist())), bool((within[reached] > limit).any())


_PIECE = T.StructType([T.StructField(n, t) for n, t in (("piece_no", T.LongType()), ("start_pos", T.LongType()), ("end_pos", T.LongType()), ("piece_text", T.StringType()), ("cut_at", T.StringType()), ("n_pieces", T.LongType()), ("cut_kind", T.StringType()))])
_ITEM = T.StructType([f for f in _PIECE.fields if f.name in ("n_pieces", "cut_kind")])


def _over_items(items: DataFrame, keys: list[str], text: str, limit: Column, overlap: Column, schema: T.StructType, rows_of: Callable) -> DataFrame:
    named = items.select(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), F.col(text).alias("t"), limit.cast("int").alias("lim"), overlap.cast("int").alias("ov"))
    big = named.where(F.char_length("t") > F.col("lim"))
    fields = [T.StructField(f"k{i}", items.schema[k].dataType) for i, k in enumerate(keys)] + schema.fields
    nk, names = len(keys), [f.name for f in fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple] = []
            size = 0
            for item in pdf.itertuples(index=False):
                t, lim, ov = item[nk], int(item[nk + 1]), int(item[nk + 2])
                if not 0 <= ov < lim:
                    raise ValueError(f"overlap {ov} must be at least 0 and less than the limit {lim}")
                pieces, forced = cuts(t, lim, ov)
                rows += [(*item[:nk], *r) for r in rows_of(t, pieces, "forced" if forced else "natural")]
                size += len(t)
                if size > 4_000_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=names)

    out = big.mapInPandas(run, T.StructType(fields))
    return out.withColumnsRenamed({f"k{i}": k for i, k in enumerate(keys)})


def split_items(items: DataFrame, *, keys: list[str], text: str, limit: Column, overlap: Column) -> DataFrame:
    """One row per piece of each item longer than its limit.

    Columns: the keys, piece_no from 0, start_pos and end_pos (code points, end excluded), piece_text, cut_at (what
    lies at the piece's end: paragraph, sentence, word, mark, forced, end), n_pieces, and cut_kind, 'forced' if a cut of
    the item lies inside a stretch longer than the limit without white space or any of . ! ? 。 ！ ？, else 'natural'.

    Each piece but the first starts exactly ``overlap`` characters before the end of the one before. The filter on
    length runs in the JVM, so only oversized items reach Python, an Arrow batch at a time, in the task that read them;
    an item is one cell, so pieces never need another row's data and nothing is shuffled, whatever document holds most
    rows. Null texts, null limits and items within the limit give nothing; a repeated item is split each time it occurs;
    an overlap that is not less than the limit is an error.
    """
    rows_of = lambda t, pieces, kind: ((k, b, e, t[b:e], CUTS[c], len(pieces), kind) for k, (b, e, c) in enumerate(pieces))
    return _over_items(items, keys, text, limit, overlap, _PIECE, rows_of)


def oversized_items(items: DataFrame, *, keys: list[str], text: str, limit: Column, overlap: Column) -> DataFrame:
    """One row per item longer than its limit: the keys, n_pieces and cut_kind of the cuts that ``split_items`` makes.

    The cuts are the same; only the pieces' texts are not made.
    """
    return _over_items(items, keys, text, limit, overlap, _ITEM, lambda t, pieces, kind: [(len(pieces), kind)])
