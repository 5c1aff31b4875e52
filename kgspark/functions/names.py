"""Names: five normal forms, deterministic ids, identity keys, quality, abbreviations. All are Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes of global ids; other classes take their first four letters.
TYPE_PREFIXES = {
    "Alternative": "alte", "Alternative_Class": "alcl", "Composite_Product": "comp", "Literature": "lite", "Experiment": "expe", "Swine_Model": "swmo", "Swine": "swin",
    "Intervention": "intv", "Control_Group": "ctgr", "Tissue_Site": "tiss", "Indicator": "indi", "Method": "meth", "Result": "resu",
}
_EDGES = r"(?U)^\s+|\s+$"


def strip(text: Column) -> Column:
    """Without white space of any kind at the ends; Spark's trim removes blanks only."""
    return F.regexp_replace(text, _EDGES, "")


def nonblank(text: Column) -> Column:
    """The text if it holds more than white space, else null."""
    return F.when(strip(text) != "", text)


def _folded(text: Column) -> Column:
    return F.lower(strip(F.coalesce(text, F.lit(""))))


def graph_name(text: Column) -> Column:
    """Form that global ids are made of: hyphens and underscores are blanks, white space is collapsed."""
    return F.regexp_replace(F.regexp_replace(_folded(text), "[-_]", " "), r"(?U)\s+", " ")


def coref_name(text: Column) -> Column:
    """Form compared by coreference: parentheses go, separators and points are blanks."""
    t = F.regexp_replace(_folded(text), r"(?U)\s*\([^)]*\)", "")
    return strip(F.regexp_replace(F.regexp_replace(t, r"[-_/.,;:]", " "), r"(?U)\s+", " "))


def dedup_name(text: Column) -> Column:
    """Lower case with white space collapsed."""
    return F.regexp_replace(_folded(text), r"(?U)\s+", " ")


def vocab_name(text: Column) -> Column:
    """Lower case without punctuation."""
    return F.regexp_replace(F.regexp_replace(_folded(text), r"(?U)[^\w\s]", ""), r"(?U)\s+", " ")


def relation_name(text: Column) -> Column:
    """Lower case without parentheses and punctuation: the key of the relationship lookup."""
    t = F.regexp_replace(_folded(text), r"(?U)\s*\([^)]*\)", "")
    return strip(F.regexp_replace(F.regexp_replace(t, r"(?U)[^\w\s]", ""), r"(?U)\s+", " "))


def type_prefix(cls: Column) -> Column:
    known = F.create_map(*(F.lit(x) for kv in TYPE_PREFIXES.items() for x in kv))
    return F.coalesce(known[cls], F.substring(F.lower(cls), 1, 4))


def global_id(cls: Column, name: Column, document: Column, global_types: Sequence[str]) -> Column:
    """Deterministic id: by class and name for global classes, else by class, name and document."""
    key = F.concat(cls, F.lit(":"), graph_name(name), F.when(cls.isin(*global_types), F.lit("")).otherwise(F.concat(F.lit(":"), F.coalesce(document, F.lit("")))))
    return F.concat(type_prefix(cls), F.lit("_"), F.substring(F.sha2(key, 256), 1, 12))


def identity_key(attribute: Column, text: Column) -> Column:
    """The normal form of the identity attribute if stated, else of the mention's text."""
    return coref_name(F.coalesce(nonblank(attribute), text))


def fuzzy_equal(a: Column, b: Column, most: int) -> Column:
    """Both non-empty and within ``most`` edits; a length filter comes before the bounded edit distance."""
    near = F.abs(F.char_length(a) - F.char_length(b)) <= 2 * most
    return (a != "") & (b != "") & near & (F.levenshtein(a, b, most) >= 0)


def contained(a: Column, b: Column, least: float = 0.6) -> Column:
    """One name lies in the other and has at least ``least`` of its length."""
    short, long = F.when(F.char_length(a) <= F.char_length(b), a).otherwise(b), F.when(F.char_length(a) <= F.char_length(b), b).otherwise(a)
    return (short != "") & long.contains(short) & (F.char_length(short) / F.char_length(long) >= least)


def initials(text: Column) -> Column:
    """Upper-case first letters of the words."""
    return F.array_join(F.transform(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""), lambda w: F.upper(F.substring(w, 1, 1))), "")


def abbreviates(short: Column, full: Column) -> Column:
    """``short`` (at most 5 characters, written upper or title case) stands for ``full`` (longer than 5).

    Its letters start the full name's words, all from the first on or some in order, or it lies in the full name.
    """
    s, f = strip(short), strip(full)
    cased = F.char_length(s).between(1, 5) & (F.char_length(f) > 5) & s.rlike(r"(?U)\p{L}") & ((s == F.upper(s)) | (s == F.initcap(s)))
    words = F.filter(F.split(f, r"(?U)\s+"), lambda w: w != "")
    step = lambda i, w: F.when((i < F.char_length(s)) & (F.upper(F.substring(w, 1, 1)) == F.upper(s.substr(i + 1, F.lit(1)))), i + 1).otherwise(i)
    in_order = F.aggregate(words, F.lit(0), step) >= F.char_length(s)
    by_words = (F.size(words) >= F.char_length(s)) & (F.startswith(initials(f), F.upper(s)) | in_order)
    return cased & (by_words | F.lower(f).contains(F.lower(s)))


def name_quality(name: Column) -> Column:
    """0 to 100: a usual length (30, too short 10), no number first (20), more than digits and marks (20), no dose of
    colony units (15), no JSON (15); nothing for an empty name."""
    t = strip(F.coalesce(name, F.lit("")))
    n = F.char_length(t)
    points = [
        F.when(n.between(3, 80), 30).when(n < 3, 10).otherwise(0),
        F.when(t.rlike(r"^\d"), 0).otherwise(20),
        F.when(t.rlike(r"^[\d\s.,;:!?\-–—()\[\]{}]+$"), 0).otherwise(20),
        F.when(t.rlike(r"\d+\s*[×x]\s*\d+\s*(CFU|cfu)"), 0).otherwise(15),
        F.when(t.rlike(r"^[{\[]"), 0).otherwise(15),
    ]
    return F.when(t == "", 0).otherwise(reduce(lambda a, b: a + b, points))


# Phrases that frame a text rather than name a thing.
FRAMING = ("the study", "this experiment", "this research", "our study", "the paper", "this paper", "the trial", "this trial")


def looks_synthetic(name: Column, framing: Sequence[str] = FRAMING) -> Column:
    """A name that reads like a label made up, not one found in a text: underscores, more than four words all in lower
    case, or a framing phrase at either end."""
    t = strip(F.coalesce(name, F.lit("")))
    words = F.size(F.filter(F.split(t, r"(?U)\s+"), lambda w: w != ""))
    framed = [F.startswith(F.lower(t), F.lit(f)) | F.endswith(F.lower(t), F.lit(f)) for f in framing]
    return reduce(lambda a, b: a | b, framed, t.contains("_") | ((words > 4) & (t == F.lower(t))))
