"""One consistent form for texts that look the same but differ in their characters."""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import HOT_ROWS, hottest, lookup_join
from ..session import checkpointed

# Letters of other scripts that are printed like a Latin letter, beside that letter.
CYRILLIC = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Ү": "Y", "Х": "X", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G", "Ӏ": "I",
    "а": "a", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v",
}
GREEK = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ϲ": "c", "ϳ": "j", "ν": "v",
}
# Hyphens printed like the hyphen-minus; dashes and the minus sign are longer and stay.
HYPHENS = "\u2010\u2011\ufe63\uff0d"
# Marks that print nothing.
INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b\u180c\u180d\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\u206a\u206b\u206c\u206d\u206e\u206f\ufeff"
# Compatibility characters whose printed form differs from their decomposition.
DISTINCT = "\u017f\u03d0\u03d1\u03d2\u03d3\u03d4\u03d5\u03d6\u03f0\u03f1\u03f4\u03f5\u03f9"
#: Kinds of compatibility decomposition that keep the printed form; the others (raised, lowered, circled, fractions, fonts) show.
SAME_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<compat>", "<square>", "<small>")


def _table() -> dict[int, str]:
    out: dict[int, str] = {}
    for c in range(0x80, 0x30000):
        ch = chr(c)
        d = unicodedata.decomposition(ch)
        if unicodedata.category(ch) == "Zs":
            out[c] = " "
        elif d and ch not in DISTINCT:
            if d.startswith("<"):
                if d.split()[0] not in SAME_LOOK:
                    continue
                plain = unicodedata.normalize("NFKD", ch)
                if any(unicodedata.decomposition(chr(int(x, 16))).startswith(("<super>", "<sub>", "<fraction>")) for x in d.split()[1:]):
                    plain = "".join(chr(int(x, 16)) for x in d.split()[1:])
                if plain[:1] == " " and len(plain) > 1:
                    continue  # spacing accents are printed without a blank
                out[c] = plain
            elif 0xAC00 > c or c > 0xD7A3:
                out[c] = unicodedata.normalize("NFD", ch)
    for c in INVISIBLE:
        out[ord(c)] = ""
    for c in range(0xFE00, 0xFE10):
        out[c] = ""
    for c in range(0xE0000, 0xE0200):
        out[c] = ""
    for c in HYPHENS:
        out[ord(c)] = "-"
    like = CYRILLIC | GREEK
    full = {c: "".join(like.get(x, x) for x in s) for c, s in out.items()}
    full |= {ord(a): b for a, b in like.items()}
    return full


TABLE = _table()
#: For each printed form, the letters it may be: the look-alike lattice of one position.
LATTICE: dict[str, str] = {}
for _of in (CYRILLIC, GREEK):
    for _a, _b in _of.items():
        LATTICE[_b] = LATTICE.get(_b, _b) + _a
_WORD = re.compile(r"[^\W\d_]+(?:[\u0300-\u036f][^\W\d_]*)*")
_FOREIGN = re.compile(r"[\u0370-\u052f\u1f00-\u1fff]")


def script(ch: str) -> str:
    """'L', 'C' or 'G' for Latin, Cyrillic and Greek letters, else ''."""
    c = ord(ch)
    if c < 0x250:
        return "L" if ch.isalpha() else ""
    if 0x370 <= c < 0x400 or 0x1F00 <= c < 0x2000:
        return "G"
    if 0x400 <= c < 0x530:
        return "C"
    return "L" if 0x1E00 <= c < 0x1F00 else ""


def skeleton(text: str) -> str:
    """What the text looks like: compatibility forms and look-alikes replaced by one form each, ignorable characters gone."""
    if text.isascii():
        return text
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", text.translate(TABLE)))


def sure_letters(skel: str) -> tuple[int, int, int]:
    """How many letters are surely Latin, Cyrillic and Greek: those that can't be of another script."""
    n = Counter(s for ch in skel if (base := ch if ch.isascii() else unicodedata.normalize("NFD", ch)[0]) not in LATTICE and (s := script(base)))
    return n["L"], n["C"], n["G"]


def viterbi(word: str, home: str, scores: Mapping[str, float], switch: float = 6.0, abroad: float = 6.0) -> str:
    """The most likely letters behind a word's printed form.

    Each position offers its look-alikes; a path scores the character bigrams' log frequencies, loses ``switch`` for
    each change of script and ``abroad`` for each letter outside the word's home: the script of most of its letters
    that can't be of another, else the text's leading script. Ties go to Latin, then to the earlier path, so the
    result depends on the printed form, the leading script and the scores only.
    """
    options = []
    for ch in word:
        base, marks = unicodedata.normalize("NFD", ch)[0], unicodedata.normalize("NFD", ch)[1:]
        options.append([unicodedata.normalize("NFC", c + marks) for c in LATTICE.get(base, base)])
    if all(len(o) == 1 for o in options):
        return word
    sure = Counter(x for o in options if len(o) == 1 and (x := script(unicodedata.normalize("NFD", o[0])[0])))
    home = max("LCG", key=lambda x: sure[x]) if sure else home
    paths: dict[str, tuple[float, str]] = {"": (0.0, "")}
    for o in options:
        new: dict[str, tuple[float, str]] = {}
        for c in o:
            s = script(unicodedata.normalize("NFD", c)[0])
            own = -abroad * (s != home)
            best = None
            for p, (v, path) in paths.items():
                sp = script(unicodedata.normalize("NFD", p)[0]) if p else s
                w = v + own + scores.get(p + c, scores.get("", -12.0)) - switch * (sp != s)
                if best is None or w > best[0] + 1e-9:
                    best = (w, path + c)
            new[c] = best
        paths = new
    return max(paths.items(), key=lambda kv: (kv[1][0], -ord(kv[0][0])))[1][1]


def consistent(text: str, scores: Mapping[str, float], memo: dict) -> str:
    """The consistent form of a text: its printed form with every word read as the most likely letters.

    Nothing reaches across an ordinary blank, neither composition nor a word, so the text is read piece by piece and
    ``memo`` remembers each piece under the text's leading script.
    """
    pieces = text.split(" ")
    home = "L"
    if _FOREIGN.search(text):
        counts, n = memo.setdefault("sure", {}), [0, 0, 0]
        for p in pieces:
            c = counts.get(p)
            if c is None:
                c = counts[p] = sure_letters(skeleton(p))
            n = [n[0] + c[0], n[1] + c[1], n[2] + c[2]]
        home = "LCG"[n.index(max(n))]
    known, words = memo.setdefault(home, {}), memo.setdefault(f"words {home}", {})
    for m in memo.values():
        if len(m) > 500_000:
            m.clear()

    def read(m: re.Match) -> str:
        w = m.group()
        got = words.get(w)
        if got is None:
            got = words[w] = viterbi(w, home, scores)
        return got

    out = []
    for p in pieces:
        form = known.get(p)
        if form is None:
            form = known[p] = _WORD.sub(read, skeleton(p))
        out.append(form)
    return " ".join(out)


def bigram_scores(docs: DataFrame, text: str) -> dict[str, float]:
    """Log frequencies of character bigrams in words of one script, counted over all texts.

    A word counts for its script if one of its letters can't be another script's and none is of a third. Each task adds
    up its own words first; pairs of letters of three scripts bound the result, whatever the corpus (under 10^6, in
    practice a few thousand), so it is collected.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        pieces: Counter = Counter()
        for pdf in batches:
            for t in pdf["t"]:
                pieces.update(t.split(" "))
            if len(pieces) > 200_000:
                _add(pieces, total)
                pieces = Counter()
        _add(pieces, total)
        yield pd.DataFrame({"g": list(total), "n": list(total.values())}).astype({"g": "object", "n": "int64"})

    rows = docs.select(F.col(text).alias("t")).where("t IS NOT NULL").mapInPandas(count, "g string, n long").groupBy("g").agg(F.sum("n").alias("n")).collect()
    sums: Counter = Counter()
    for r in rows:
        sums[script(r["g"][0])] += r["n"]
    out = {r["g"]: math.log((r["n"] + 0.1) / (sums[script(r["g"][0])] + 100.0)) for r in rows}
    out[""] = -14.0
    return out


def _add(pieces: Counter, total: Counter) -> None:
    words: Counter = Counter()
    for p, k in pieces.items():
        for w in _WORD.findall(unicodedata.normalize("NFC", p)):
            words[w] += k
    for w, k in words.items():
        bases = [unicodedata.normalize("NFD", c)[0] for c in w]
        kinds = {script(b) for b in bases}
        if len(kinds) == 1 and "" not in kinds and any(b not in CYRILLIC and b not in GREEK and b not in LATTICE for b in bases):
            for i in range(len(w) - 1):
                total[w[i : i + 2]] += k


#: A worker's memory of words and pieces, by model; it lasts from task to task.
_MEMORY: dict[int, dict] = {}


def consistent_forms(docs: DataFrame, text: str, out: str = "form", scores: Mapping[str, float] | None = None) -> DataFrame:
    """``docs`` with a column ``out`` that holds each text's consistent form.

    Compatibility normalization (of the kinds that keep the printed form) and deletion of ignorable characters come
    first; then every word's lattice of look-alike letters is searched with Viterbi under script-consistent character
    bigram scores. The lattice depends on the printed form alone and a path keeps it, so texts have equal forms if and
    only if they look the same. Words are remembered by each Python worker. Null stays null, '' stays ''; whole texts
    are read whatever their length; other columns pass through. One pass, no shuffle; counting the bigrams is another.
    """
    model = docs.sparkSession.sparkContext.broadcast(dict(scores if scores is not None else bigram_scores(docs, text)))

    @F.pandas_udf("string")
    def form(texts: pd.Series) -> pd.Series:
        known = model.value
        memo = _MEMORY.setdefault(id(known), {})
        return texts.map(lambda t: None if t is None else consistent(t, known, memo))

    return docs.withColumn(out, form(F.col(text)))


def _spelt(docs: DataFrame, key: str, text: str, scores: Mapping[str, float] | None, hot_rows: int) -> DataFrame:
    """(k, form, spelt, n), once each and stored, of every row whose form is spelt in several ways; n rows spell it so.

    Python returns 128-bit hashes of form and text, so no text is shuffled. Rows are counted by spelling on the map side
    and look their spelling up, those of hot spellings where they lie; what is alone in its form goes no further.
    """
    model = docs.sparkSession.sparkContext.broadcast(dict(scores if scores is not None else bigram_scores(docs, text)))

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = lambda s: hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        known = model.value
        memo = _MEMORY.setdefault(id(known), {})
        for pdf in batches:
            yield pd.DataFrame({"k": pdf["k"], "form": [code(consistent(t, known, memo)) for t in pdf["t"]], "spelt": [code(t) for t in pdf["t"]]})

    base = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).where("k IS NOT NULL AND t IS NOT NULL")
    rows = checkpointed(base.mapInPandas(mark, "k long, form binary, spelt binary"))
    spellings = rows.groupBy("form", "spelt").agg(F.count(F.lit(1)).alias("n"))
    forms = spellings.groupBy("form").agg(F.count(F.lit(1)).alias("ways")).where("ways > 1").select("form")
    several = checkpointed(spellings.join(forms, "form"))
    on = ["form", "spelt"]
    return checkpointed(lookup_join(rows, several, on, "inner", hot=hottest(several.select(*on, "n"), "n", hot_rows)).distinct())


def look_alike_pairs(docs: DataFrame, key: str, text: str, scores: Mapping[str, float] | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(a, b), a < b: rows whose texts are different strings with the same consistent form.

    Rows meet by distinct spelling, not by row: the spellings of a form are paired first, and a form or a text held by a
    third of all rows is never compared with itself; only true pairs are made. A spelling of very many rows is dealt out
    to as many cells as it has ``hot_rows`` rows, and two spellings meet cell by cell, so no task gets all rows of
    either. Null keys or texts are in no pair; repeated rows count once.
    """
    rows = _spelt(docs, key, text, scores, hot_rows).withColumn("n", F.ceil(F.col("n") / hot_rows).cast("int"))
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("k"), F.col("n")).cast("int"))
    s = rows.select("form", "spelt", "n").distinct()
    met = s.select("form", F.col("spelt").alias("x"), F.col("n").alias("nx")).join(s.select("form", F.col("spelt").alias("y"), F.col("n").alias("ny")), "form").where("x < y")
    met = met.select("x", "y", "nx", F.explode(F.sequence(F.lit(0), F.col("ny") - 1)).alias("j")).select("x", "y", "j", F.explode(F.sequence(F.lit(0), F.col("nx") - 1)).alias("i"))
    met = checkpointed(met)
    left = met.join(rows.select(F.col("spelt").alias("x"), F.col("cell").alias("i"), F.col("k").alias("a")), ["x", "i"])
    right = met.join(rows.select(F.col("spelt").alias("y"), F.col("cell").alias("j"), F.col("k").alias("b")), ["y", "j"])
    return left.join(right, ["x", "y", "i", "j"]).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def look_alike_classes(docs: DataFrame, key: str, text: str, scores: Mapping[str, float] | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(k, class_id, n_links): one row for each row that looks like another but is spelt differently.

    class_id is the least key of all rows that look the same; n_links counts those of them with another text. The rows of
    ``look_alike_pairs`` without its pairs, whose number grows with the square of a class. Nulls and repeats as there.
    """
    rows = _spelt(docs, key, text, scores, hot_rows)
    ways = rows.groupBy("form", "spelt").agg(F.count(F.lit(1)).alias("same"), F.min("k").alias("k0"), F.max("n").alias("n"))
    forms = ways.groupBy("form").agg(F.sum("same").alias("alike"), F.min("k0").alias("class_id"))
    found = checkpointed(ways.join(forms, "form").select("form", "spelt", "n", "class_id", (F.col("alike") - F.col("same")).alias("n_links")))
    on = ["form", "spelt"]
    out = lookup_join(rows.drop("n"), found.drop("n"), on, "inner", hot=hottest(found.select(*on, "n"), "n", hot_rows))
    return out.select("k", "class_id", "n_links")
