"""Mapping freely typed values to a canonical list with a trie searched by a Levenshtein automaton."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import HOT_ROWS, hottest, lookup_join
from ..session import checkpointed

UNMATCHED = "UNMATCHED"
#: A reference list beyond this many names is refused: it is held by every worker.
MAX_NAMES = 2_000_000
#: Edits allowed by the number of letters of a name: (from this length on, edits).
DEFAULT_DISTANCES = ((0, 0), (5, 1), (10, 2), (13, 3))
#: Shorter stretches of a value stand for a name only if they are all of it or of a bracket, or in capitals.
SHORT = 4
#: Shorter names bear edits only in such stretches.
FIRM = 7
# Words that deny the name after them, and the sign that stands for them in alias paths.
DENIALS = ("no", "not", "non", "without", "never")
DENIED = "¬"
_TOKEN = re.compile(r"[^\W_]+|[↑↓→↔+%]+")
_BRACKETS = re.compile(r"[()\[\]{}]")


def plain(text: str) -> str:
    """Lower case, compatibility forms replaced, hyphens, underscores and blanks taken as one blank."""
    t = unicodedata.normalize("NFKC", text).lower().replace("\u00ad", "").replace("\u200b", "")
    return re.sub(r"[\s_\-‐-―]+", " ", t).strip()


def key_of(text: str) -> str:
    """What is compared: letters, digits and arrows of the plain form, without the blanks between."""
    k = "".join(c for c in plain(text) if c.isalnum() or c in "↑↓→↔+%")
    return re.sub(r"([↑↓→↔])\1+", r"\1", k)


class Trie:
    """Reference entries with their alias paths, in flat arrays.

    Nodes are numbered breadth first, so the children of node i are the nodes first[i] to first[i + 1] - 1, and node i
    is reached by letters[i]. ``ends`` holds the entries whose names end in a node; ``below`` the entry that all names
    through a node lead to, if it is one. Names that start with DENIED are alias paths behind a word of denial; that
    word is no matter of edits, so they are searched from its node on, and not from the root.
    """

    def __init__(self, names: Iterable[tuple[str, str]] = ()) -> None:
        keys: dict[str, set[str]] = {}
        for name, entry in names:
            if k := key_of(name):
                keys.setdefault(DENIED + k if name.startswith(DENIED) else k, set()).add(entry)
        if len(keys) > MAX_NAMES:
            raise ValueError(f"the reference list has more than {MAX_NAMES} names")
        self.names = len(keys)
        self.lengths = sorted({len(k.lstrip(DENIED)) for k in keys})
        children: list[dict[str, int]] = [{}]
        through: list[set[str]] = [set()]
        last: dict[int, set[str]] = {}
        for k, entries in keys.items():
            node = 0
            for c in k:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    through.append(set())
                node = children[node][c]
                if len(through[node]) < 2:
                    through[node] |= entries
            last[node] = entries
        order, letters, self.first = [0], [""], [1]
        for node in order:  # grows as it is read
            for c, child in sorted(children[node].items()):
                order.append(child)
                letters.append(c)
            self.first.append(len(order))
        self.letters = letters
        self.ends = {i: tuple(sorted(last[node])) for i, node in enumerate(order) if node in last}
        self.below = {i: next(iter(through[node])) for i, node in enumerate(order) if len(through[node]) == 1}

    def _node(self, k: str) -> int:
        node = 0
        for c in k:
            node = next((i for i in range(self.first[node], self.first[node + 1]) if self.letters[i] == c), -1)
            if node < 0:
                break
        return node

    def starting(self, k: str) -> str | None:
        """The entry that all names that start like this lead to, if it is one."""
        return self.below.get(self._node(k))

    def within(self, k: str, limit: int) -> dict[str, tuple[int, int]]:
        """Every entry with a name within ``limit`` edits: the fewest edits, and the length of the name they lead to.

        The automaton runs along the trie: shared prefixes are read once, and a branch is left as soon as no
        continuation can be within the limit. No edits at all is the path of the word itself.
        """
        root = self._node(DENIED) if k.startswith(DENIED) else 0
        if root < 0:
            return {}
        if not limit:
            return {e: (0, len(k.lstrip(DENIED))) for e in self.ends.get(self._node(k), ())}
        k = k.lstrip(DENIED)
        auto = automaton(limit)
        found: dict[str, tuple[int, int]] = {}
        masks: dict[str, int] = {}
        for p, c in enumerate(k):
            masks[c] = masks.get(c, 0) | 1 << (p + limit + 1)
        n, full, step, moves, rows = len(k), (1 << (2 * limit + 1)) - 1, auto.step, auto.moves, auto.rows
        first, letters, ends = self.first, self.letters, self.ends
        stack = [(root, 0, 0)]
        while stack:
            node, depth, state = stack.pop()
            depth += 1
            for child in range(first[node], first[node + 1]):
                seen = (masks.get(letters[child], 0) >> depth) & full
                new = moves.get((state, seen))
                if new is None:
                    new = step(state, seen)
                if new < 0 or letters[child] == DENIED:
                    continue
                if child in ends and abs(n - depth) <= limit and (d := rows[new][n - depth + limit]) <= limit:
                    for e in ends[child]:
                        if e not in found or (d, -depth) < (found[e][0], -found[e][1]):
                            found[e] = (d, depth)
                stack.append((child, depth, new))
        return found


class Automaton:
    """The Levenshtein automaton for ``n`` edits, for every word at once.

    A state is the band of 2n+1 edit distances around the diagonal, with the two bands before and their matches, so that
    two letters changed over count as one edit, also if a letter between them was left out or put in; its input is not a letter but the pattern of places in the
    band where the word has that letter. The states reached are few, so transitions are worked out once and looked up
    from then on, whatever the words.
    """

    def __init__(self, n: int) -> None:
        self.n = n
        first = tuple(max(0, t - n) if t >= n else n + 1 for t in range(2 * n + 1))
        none = (n + 1,) * (2 * n + 1)
        self.ids: dict[tuple, int] = {(first, none, none, 0, 0): 0}
        self.states: list[tuple] = list(self.ids)
        self.rows: list[tuple[int, ...]] = [first]
        self.moves: dict[tuple[int, int], int] = {}

    def step(self, state: int, seen: int) -> int:
        """The next state, or -1 if no word can still be within reach."""
        to = self.moves.get((state, seen))
        return self._work_out(state, seen) if to is None else to

    def _work_out(self, state: int, seen: int) -> int:
        row, older, oldest, before, earlier = self.states[state]
        n, width, far = self.n, 2 * self.n + 1, self.n + 1
        new: list[int] = []
        for t in range(width):
            v = row[t] + (not seen >> t & 1)
            if t + 1 < width:
                v = min(v, row[t + 1] + 1)
            if t:
                v = min(v, new[t - 1] + 1)
                if t + 1 < width and seen >> (t - 1) & 1 and before >> (t + 1) & 1:
                    v = min(v, older[t] + 1)
                if t + 2 < width and seen >> (t - 1) & 1 and earlier >> (t + 2) & 1:
                    v = min(v, oldest[t + 1] + 2)
            if t > 1 and t + 1 < width and seen >> (t - 2) & 1 and before >> (t + 1) & 1:
                v = min(v, older[t - 1] + 2)
            new.append(min(v, far))
        to = -1
        if min(new) <= n:
            key = (tuple(new), row, older, seen, before)
            to = self.ids.setdefault(key, len(self.ids))
            if to == len(self.states):
                self.states.append(key)
                self.rows.append(key[0])
        self.moves[state, seen] = to
        return to


_AUTOMATA: dict[int, Automaton] = {}


def automaton(n: int) -> Automaton:
    return _AUTOMATA.setdefault(n, Automaton(n)) if n not in _AUTOMATA else _AUTOMATA[n]


def verb_forms(word: str) -> list[str]:
    """Inflected forms of a regular English verb given in any of them."""
    stem = re.sub(r"(ing|ed|es|s|e)$", "", word) if len(word) > 4 else word
    forms = [stem, *(stem + x for x in ("e", "es", "s", "ed", "ing"))]
    return [*forms, stem[:-2] + "ation", stem + "ion"] if stem.endswith("at") else [*forms, stem + "ion", stem + "ment"]


def stretches(value: str, lengths: Sequence[int], most: int) -> list[tuple[int, int, str, bool]]:
    """(first word, end, key, alone) of the stretches of words of a value that may stand for a name.

    Words are what lies between blanks, marks and brackets. A stretch counts if its key is within ``most`` letters of
    one of ``lengths``, or if it ends the value (it may be the beginning of a name). It is alone if it is all of the
    value or of a bracket, or all that lies outside brackets, or written in capitals. One that starts with a denial is
    there a second time with DENIED for that word. Of a value with one comma the two parts changed over are a stretch
    too ('oxide, copper').
    """
    text = unicodedata.normalize("NFKC", value).replace("\u00ad", "").replace("\u200b", "")
    words = [(m.group(), m.start()) for m in _TOKEN.finditer(text)]
    marks = [(m.start(), 1 if m.group() in "([{" else -1) for m in _BRACKETS.finditer(text)]
    level, depth, i = [], 0, 0
    for _, b in words:
        while i < len(marks) and marks[i][0] < b:
            depth = max(0, depth + marks[i][1])
            i += 1
        level.append((depth > 0, i))
    keys = [re.sub(r"([↑↓→↔])\1+", r"\1", key_of(w)) for w, _ in words]
    fits = {n for m in lengths for n in range(m - most, m + most + 1)}
    longest, whole = max(fits, default=0), "".join(keys)
    at = [0]
    for k in keys:
        at.append(at[-1] + len(k))
    out = []
    n = len(words)
    for a in range(n):
        denies = keys[a] in DENIALS
        for b in range(a + 1, n + 1):
            size = at[b] - at[a]
            if size - (len(keys[a]) if denies else 0) > longest:
                break
            if size in fits or b == n or denies:
                part = level[a] == level[b - 1] and (a == 0 or level[a - 1] != level[a]) and (b == n or level[b] != level[b - 1])
                alone = part or all(w.isupper() for w, _ in words[a:b])
                if size:
                    out.append((a, b, whole[at[a] : at[b]], alone))
                if denies and at[b] - at[a + 1] in fits and b > a + 1:
                    out.append((a, b, DENIED + whole[at[a + 1] : at[b]], part))
    if text.count(",") == 1:
        head = sum(p < text.index(",") for _, p in words)
        if 0 < head < n and at[n] in fits:
            out.append((0, n, whole[at[head] :] + whole[: at[head]], True))
    return out


class Matcher:
    """Finds the entry that a typed value stands for."""

    def __init__(self, names: Iterable[tuple[str, str]], distances: Sequence[tuple[int, int]] = DEFAULT_DISTANCES) -> None:
        self.trie = Trie(names)
        self.distances = sorted(distances)

    def limit(self, letters: int) -> int:
        return max((d for n, d in self.distances if letters >= n), default=0)

    def near(self, k: str, alone: bool) -> list[tuple[int, str]]:
        """(score, entry) of all entries with a name within the distance that its length bears."""
        n, most = len(k.lstrip(DENIED)), max(d for _, d in self.distances)
        bears = max((d for d in range(most + 1) if self.limit(n + d) >= d), default=0) if alone or n + most >= FIRM else 0
        lengths = self.trie.lengths
        if bisect_left(lengths, n - bears) == bisect_left(lengths, n + bears + 1):
            return []
        more = 2 * (len(k) - n)
        return [(m - 2 * d + more, e) for e, (d, m) in self.trie.within(k, bears).items() if d <= (self.limit(m) if alone or m >= FIRM else 0)]

    def match(self, value: str) -> str:
        """The entry, or UNMATCHED: what explains most letters of the value with the fewest edits.

        Stretches of words are searched, the longest first, until none is left that could explain more; all entries
        with a name within the distance that its length bears come back. A name counts by its letters less twice the
        edits that lead to it, whatever words stand around it; so a longer name, as one that denies another, outweighs
        the name inside. A stretch that ends in a point may be the beginning of the names of one entry. Two different
        entries that count the same, or of which one is named beside the other, leave a value unmatched.
        """
        trie = self.trie
        if not trie.lengths:
            return UNMATCHED
        pieces = sorted(stretches(value, trie.lengths, max(d for _, d in self.distances)), key=lambda p: -len(p[2]))
        best: tuple[int, int, int, set[str]] = (0, 0, 0, set())
        for a, b, k, alone in pieces:
            if len(k) + 1 < best[0]:
                break
            if len(k) >= SHORT or alone:
                for score, e in self.near(k, alone):
                    if score > best[0]:
                        best = (score, a, b, {e})
                    elif score == best[0]:
                        best[3].add(e)
        score, a, b, entries = best
        if not entries:
            ending = [k for x, y, k, _ in pieces if value.rstrip().endswith(".") and y == max(p[1] for p in pieces) and len(k) >= SHORT]
            return next((e for k in ending if (e := trie.starting(k))), UNMATCHED)
        beside = (trie.within(k, 0) for x, y, k, alone in pieces if (y <= a or x >= b) and (len(k) >= SHORT or alone))
        return next(iter(entries)) if len(entries) == 1 and all(set(found) <= entries for found in beside) else UNMATCHED


def map_to_canonical(values: DataFrame, *, record: str, field: str, value: str, matchers: Mapping[str, Matcher], entries: Mapping[str, Sequence[str]], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(field_name, record_id, entry): each value that is not written exactly like an entry, with its entry or UNMATCHED.

    ``values`` has a record id, the name of the field's list and the value as typed. Nulls, blanks and exact entries
    are left out in the JVM. Equal spellings are brought together (counted on the map side, so a value held by a third of
    all rows costs one row a task) and each is searched once in the cluster, spread evenly; the outcome, a table of
    spellings, is joined back: by broadcasting it if it is small, else by spelling, hot spellings apart. The lists are
    broadcast in flat arrays; a list beyond MAX_NAMES names is refused. Fields without a matcher are left out.

    Redelivered records count once; a record delivered with different values keeps the entry that sorts first; a null
    record id gives nothing; an empty table gives an empty result; very long values are searched whole.
    """
    v = values.select(F.col(field).alias("field_name"), F.col(record).cast("long").alias("record_id"), F.col(value).alias("value"))
    v = v.where(F.col("field_name").isin(*matchers) & F.col("record_id").isNotNull() & F.col("value").isNotNull() & (F.regexp_replace("value", r"(?U)^\s+|\s+$", "") != ""))
    for name, listed in entries.items():
        v = v.where((F.col("field_name") != name) | ~F.col("value").isin(*listed))
    spark = values.sparkSession
    table = spark.sparkContext.broadcast(dict(matchers))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = table.value
        for pdf in batches:
            yield pdf.assign(entry=[known[f].match(x) for f, x in zip(pdf["field_name"], pdf["value"])])

    spellings = v.groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("n")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = T.StructType([T.StructField("field_name", T.StringType()), T.StructField("value", T.StringType()), T.StructField("n", T.LongType()), T.StructField("entry", T.StringType())])
    found = checkpointed(spellings.mapInPandas(run, schema))
    keys = ["field_name", "value"]
    out = lookup_join(v, found.select(*keys, "entry"), keys, "inner", hot=hottest(found.select(*keys, "n"), "n", hot_rows))
    return out.groupBy("field_name", "record_id").agg(F.min("entry").alias("entry"))
