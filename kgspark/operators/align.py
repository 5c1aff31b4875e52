"""Aligning mentions to their document: a cascade from exact to approximate, evidence and location."""

from __future__ import annotations

import difflib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .similarity import overlapping
from .text import regex_tokens

EXACT, FUZZY, LESSER = "match_exact", "match_fuzzy", "match_lesser"
# Spellings of comparison signs.
SIGNS = {"<": ("<", "less than"), ">": (">", "greater than"), "=": ("=",), "≤": ("≤", "<=", "less than or equal to"), "≥": ("≥", ">=", "greater than or equal to")}
_COMPARISON = re.compile(r"([a-z]+)\s*(<=|>=|[<>=≤≥]|less than or equal to|greater than or equal to|less than|greater than)\s*(\S.*)", re.S)
_SIGN_OF = {form: sign for sign, forms in SIGNS.items() for form in forms}


def _free(doc: str, b: int, e: int) -> bool:
    """Whether a hit doesn't begin or end inside a word."""
    return (b == 0 or not doc[b - 1].isalpha()) and (e >= len(doc) or not doc[e].isalpha())


def _hits(where: str, what: str) -> Iterator[int]:
    p = where.find(what)
    while p >= 0:
        yield p
        p = where.find(what, p + 1)


class Text:
    """A document prepared once for all its mentions."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.low = text.lower() if len(text.lower()) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        self._forms: dict[int, tuple[str, list[int]]] = {}
        self._tokens: list | None = None

    def form(self, level: int) -> tuple[str, list[int]]:
        """The lower-case text without white space, and each character's place; level 1 shortens brackets to their first word, 2 drops them."""
        if level not in self._forms:
            if level == 0:
                at = [i for i, c in enumerate(self.low) if not c.isspace()]
                self._forms[0] = ("".join(self.low[i] for i in at), at)
            else:
                s, at = self.form(0)
                keep: list[int] = []
                last = 0
                for m in re.finditer(r"\((\w+)[^)]*\)" if level == 1 else r"\([^)]*\)", s):
                    keep += range(last, m.start())
                    if level == 1:
                        keep += [m.start(), *range(m.start(1), m.end(1)), m.end() - 1]
                    last = m.end()
                keep += range(last, len(s))
                self._forms[level] = ("".join(s[i] for i in keep), [at[i] for i in keep])
        return self._forms[level]

    def tokens(self) -> list:
        if self._tokens is None:
            self._tokens = [(self.low[b:e], b, e) for _, b, e, _ in regex_tokens(self.text)]
        return self._tokens


def _bare(s: str, level: int) -> str:
    s = re.sub(r"\s+", "", s)
    return s if level == 0 else re.sub(r"\((\w+)[^)]*\)", r"(\1)", s) if level == 1 else re.sub(r"\([^)]*\)", "", s)


def align_one(mention: str, doc: Text) -> tuple[int, int, str] | None:
    """(start, end, status) of a mention in its document, by the first tier that finds it.

    1 the text itself, any case, not inside a word; 2 the same without white space, then with brackets shortened or
    dropped (at least 3 characters, not inside a word either); 3 comparison signs in other spellings; 4 the window of
    tokens most like the mention's, at least 0.6; 5 a cluster of at least half of its words, and at least two.
    """
    x = mention.strip()
    if not x or not doc.text:
        return None
    low = x.lower()
    for p in _hits(doc.low, low):
        if _free(doc.text, p, p + len(low)):
            return p, p + len(low), EXACT
    for level in (0, 1, 2):
        want = _bare(low, level)
        if len(want) >= 3:
            have, at = doc.form(level)
            for p in _hits(have, want):
                b, e = at[p], at[p + len(want) - 1] + 1
                if _free(doc.text, b, e):
                    return b, e, EXACT
    return _by_sign(low, doc) or _by_window(low, doc) or _by_words(low, doc)


def _by_sign(low: str, doc: Text) -> tuple[int, int, str] | None:
    m = _COMPARISON.fullmatch(low)
    if not m:
        return None
    sign = _SIGN_OF[m[2]]
    either = "|".join(re.escape(f) for f in sorted(SIGNS[sign], key=len, reverse=True))
    hit = re.search(rf"(?<![^\W\d_]){re.escape(m[1])}\s*(?:{either})\s*{re.escape(m[3].strip())}", doc.low)
    return (hit.start(), hit.end(), FUZZY) if hit else None


def _by_window(low: str, doc: Text, least: float = 0.6) -> tuple[int, int, str] | None:
    want = [low[b:e] for _, b, e, _ in regex_tokens(low)]
    telling = {t for t in want if len(t) > 1}
    if not telling:
        return None
    toks = doc.tokens()
    n, best = len(want), (0.0, -1, -1)
    sm = difflib.SequenceMatcher(autojunk=False)
    sm.set_seq2(want)
    seen = set()
    for i, (t, _, _) in enumerate(toks):
        if t in telling:
            for a in {max(0, i - n + 1), max(0, i - want.index(t)), i}:
                if a in seen:
                    continue
                seen.add(a)
                window = [w for w, _, _ in toks[a : a + n + 1]]
                sm.set_seq1(window)
                if sm.quick_ratio() <= best[0]:
                    continue
                blocks = [b for b in sm.get_matching_blocks() if b.size]
                if blocks and (r := sm.ratio()) > best[0]:
                    best = (r, toks[a + blocks[0].a][1], toks[a + blocks[-1].a + blocks[-1].size - 1][2])
    return (best[1], best[2], FUZZY) if best[0] >= least else None


def _by_words(low: str, doc: Text) -> tuple[int, int, str] | None:
    """The shortest stretch of text, at most three times as long as the mention, with the most of its different words.

    All places of all words lie in one sorted list, over which a window slides: it grows at the right and drops at the
    left what is too far or comes again inside.
    """
    words = [w for w in dict.fromkeys(re.split(r"[\s_\-]+", low)) if len(w) > 2]
    places = sorted((p, p + len(w), w) for w in words for p in _hits(doc.low, w)) if len(words) > 1 else []
    inside: Counter = Counter()
    left, best = 0, (0, 0, 0, 0)  # words, minus the length, minus the start, end
    for start, end, w in places:
        inside[w] += 1
        while end - places[left][0] > 3 * len(low) or inside[places[left][2]] > 1:
            inside[places[left][2]] -= 1
            left += 1
        n = sum(k > 0 for k in inside.values())
        best = max(best, (n, places[left][0] - end, -places[left][0], end))
    return (-best[2], best[3], FUZZY) if best[0] >= max(2, len(words) / 2) else None


_OPEN = re.compile(r"[.!?](?=\s)|\n")


def evidence_of(text: str, b: int, e: int, context: int = 300) -> tuple[str, str]:
    """The mention's surroundings of whole sentences, and the sentence or sentences that hold it, which lie inside."""
    def start(p: int) -> int:
        last = None
        for last in _OPEN.finditer(text, max(0, p - 500), p):
            pass
        return last.end() if last else max(0, p - 200)

    def end(p: int) -> int:
        m = re.compile(r"[.!?](?=\s|$)|\n").search(text, p, min(len(text), p + 500))
        return len(text) if m is None and p + 200 >= len(text) else min(len(text), p + 200) if m is None else m.end() if m.group() != "\n" else m.start()

    def trim(p: int, q: int) -> tuple[int, int]:
        while p < q and text[p].isspace():
            p += 1
        while q > p and text[q - 1].isspace():
            q -= 1
        return p, q

    p, q = trim(start(max(0, b - context)), end(min(len(text), e + context)))
    s, t = trim(start(b), end(e))
    return text[p:q], text[max(p, s) : min(q, t)]


SCHEMA = "start_pos int, end_pos int, alignment_status string, evidence_text string, source_location string"


def align(mentions: DataFrame, documents: DataFrame, *, document: str, mention: str, text: str, keep: list[str], context: int = 300) -> DataFrame:
    """``keep`` of each mention with its interval (code points), status, evidence and location; null where not found.

    Mentions meet their text in one shuffle by document, the mentions of a document as an array, so that no text is
    copied per mention and each is prepared once. Arrays are cut into lists of at most 500 mentions, which bounds a
    task's work for a document with very many.
    """
    kept = ", ".join(f"`{c}` {mentions.schema[c].dataType.simpleString()}" for c in keep)
    m = mentions.select(F.col(document).alias("__d"), F.struct(*keep, F.col(mention).alias("__m")).alias("__r"), F.pmod(F.xxhash64(*keep), F.lit(1 << 20)).alias("__h"))
    sizes = m.groupBy("__d").agg(F.ceil(F.count(F.lit(1)) / 500).cast("long").alias("__n"))
    lists = m.join(sizes, "__d").groupBy("__d", F.pmod("__h", "__n").alias("__s")).agg(F.collect_list("__r").alias("__rs"))
    joined = lists.join(documents.select(F.col(document).alias("__d"), F.col(text).alias("__t")), "__d", "left").select("__rs", "__t")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for rs, t in zip(pdf["__rs"], pdf["__t"]):
                doc = Text(t or "")
                for r in rs:
                    r = r.asDict() if hasattr(r, "asDict") else r
                    hit = align_one(r["__m"] or "", doc)
                    own = tuple(r[c] for c in keep)
                    rows.append((*own, hit[0], hit[1], hit[2], *evidence_of(doc.text, hit[0], hit[1], context)) if hit else (*own, None, None, None, "", ""))
            yield pd.DataFrame(rows, columns=[*keep, *(x.split()[0] for x in SCHEMA.split(", "))]).astype({"start_pos": "Int32", "end_pos": "Int32"})

    return joined.mapInPandas(run, f"{kept}, {SCHEMA}")


def exact_position(mention: Column, text: Column) -> Column:
    """Tier 1 in the JVM: 0-based place of the mention, any case, -1 if absent; word edges are not looked at."""
    return F.when(mention != "", F.position(F.lower(mention), F.lower(text)) - 1).otherwise(-1)


def word_position(mention: Column, text: Column) -> Column:
    """Tier 1 in the JVM: 0-based place of the mention, any case, that doesn't begin or end inside a word; -1 if there is
    none; null of nulls. The quoted mention is looked for between other than letters."""
    quoted = F.concat(F.lit(r"\Q"), F.replace(F.lower(mention), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    whole = F.concat(F.lit(r"(?s)^(.*?)(?<!\p{L})"), quoted, F.lit(r"(?!\p{L})"))
    # the length of what lies before counts characters; a matcher's own positions count UTF-16 units
    place = F.char_length(F.call_function("regexp_extract", F.lower(text), whole, F.lit(1)))
    return F.when((mention != "") & F.rlike(F.lower(text), whole), place).otherwise(F.when(mention.isNotNull() & text.isNotNull(), -1))


def raw_evidence(text: Column, start: Column, end: Column, context: int = 300) -> Column:
    """The text ``context`` characters around an interval; '' without one."""
    b = F.greatest(start - context, F.lit(0))
    return F.when(start.isNull() | end.isNull(), "").otherwise(text.substr(b + 1, end + context - b))


def lcs_spans(source: list[str], wanted: list[str]) -> dict[int, tuple[int, int]]:
    """For each number of matches in order, the tightest span of ``source`` (start, end) that has them."""
    best: dict[int, tuple[int, int]] = {}
    state: list[dict[int, int]] = [dict() for _ in wanted]  # j -> matches ending at j: latest start
    for i, s in enumerate(source):
        for j in range(len(wanted) - 1, -1, -1):
            if wanted[j] != s:
                continue
            new = {1: i}
            for p in range(j):
                for k, b in state[p].items():
                    if b > new.get(k + 1, -1) and (k > 0):
                        new[k + 1] = b
            for k, b in new.items():
                if b >= state[j].get(k, -1):
                    state[j][k] = b
                if k not in best or i - b < best[k][1] - 1 - best[k][0]:
                    best[k] = (b, i + 1)
    return best


def lcs_align(source: list[str], wanted: list[str], coverage: float = 0.75, density: float = 1 / 3) -> tuple[int, int] | None:
    """The span with the most of the wanted tokens in order that covers and is dense enough; None if there is none."""
    spans = lcs_spans(source, wanted)
    for k in sorted(spans, reverse=True):
        b, e = spans[k]
        if k / len(wanted) >= coverage and k / (e - b) >= density:
            return b, e
    return None


def block_align(source: list[str], wanted: list[str]) -> tuple[int, int, str] | None:
    """Longest common block of tokens: exact if it is all of the wanted ones, lesser if it is their beginning."""
    m = difflib.SequenceMatcher(a=source, b=wanted, autojunk=False).find_longest_match()
    if not m.size:
        return None
    return (m.a, m.a + m.size, EXACT) if m.size == len(wanted) else (m.a, m.a + m.size, LESSER) if m.b == 0 else None


def without_overlaps(first: DataFrame, second: DataFrame, document: str, ident: str, start: str, end: str) -> DataFrame:
    """Rows of ``second`` that overlap no row of ``first`` in the same document; rows without an interval overlap none."""
    return second.join(overlapping(second, first, document, ident, start, end), ident, "left_anti")


def merge_passes(passes: list[DataFrame], document: str, ident: str, start: str, end: str) -> DataFrame:
    """Union of extraction passes in which an earlier pass wins where intervals overlap; ``ident`` is unique per row."""
    out = passes[0]
    for p in passes[1:]:
        out = out.unionByName(without_overlaps(out, p, document, ident, start, end))
    return out
