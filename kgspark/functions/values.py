"""Cleaning of single values: texts, case, numbers, evidence, and mapping through value lists."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import strip

# A short first word in lower case is a fragment unless it is one of these.
SENTENCE_STARTS = (
    "the", "a", "an", "in", "on", "at", "to", "of", "for", "with", "from", "by", "as", "is", "was", "were", "are", "this", "that", "these", "those", "it", "we", "they", "no", "not", "our", "their",
    "and", "or", "but", "if", "so", "be", "has", "had", "been", "can", "may", "will", "would", "could", "should", "also", "then", "than",
)
# Openings of a concluding sentence.
CONCLUSIONS = (
    "in conclusion", "these results suggest", "these results indicate", "these findings suggest", "overall", "therefore", "in summary", "collectively", "taken together",
    "our results demonstrate", "our findings demonstrate", "this study demonstrates", "the present study demonstrates",
)
# Other words for the direction of a result and for the kind of a relation.
DIRECTIONS = {
    "altered": "no_significant_change", "improved": "increased", "downregulated": "decreased", "changed": "no_significant_change", "affected": "no_significant_change",
    "regulated": "no_significant_change", "promoted": "increased", "reduced": "decreased", "alleviated": "decreased", "modified": "no_significant_change",
    "enhanced": "increased", "elevated": "increased", "up-regulated": "increased", "down-regulated": "decreased", "lowered": "decreased",
}
RELATIONS = {
    "enriches": "increases", "depletes": "decreases", "enhances": "upregulates", "suppresses": "downregulates", "reduces": "decreases", "raises": "increases", "lowers": "decreases",
    "boosts": "increases", "inhibits": "decreases", "stimulates": "upregulates", "induces": "upregulates", "represses": "downregulates", "activates": "upregulates", "blocks": "decreases",
    "attenuates": "decreases", "modulates": "affects", "regulates": "affects", "alters": "affects", "impairs": "decreases", "improves": "increases", "ameliorates": "increases",
    "augments": "increases", "diminishes": "decreases",
}
# Other words for control groups and methods.
CONTROLS = {
    "con": "Control group", "con.": "Control group", "ctr": "Control group", "ctrl": "Control group", "control": "Control group", "control group": "Control group", "control diet": "Basal diet",
    "nc": "Negative control", "n.c.": "Negative control", "pc": "Positive control", "p.c.": "Positive control", "ab": "Antibiotic group", "abx": "Antibiotic group", "anti": "Antibiotic group",
    "antibiotic": "Antibiotic group", "antibiotic group": "Antibiotic group", "pbs": "PBS", "saline": "Saline",
}
METHODS = {
    "elisa": "ELISA", "elisa assay": "ELISA assay", "elisa kit": "ELISA kit", "elisa test": "ELISA test", "pcr": "PCR", "rt-pcr": "RT-PCR", "qpcr": "qPCR", "rt-qpcr": "RT-qPCR", "western blot": "Western blot",
    "western blotting": "Western blotting", "sds-page": "SDS-PAGE", "nmr": "NMR", "gc-ms": "GC-MS", "lc-ms": "LC-MS", "hplc": "HPLC", "icp-oes": "ICP-OES", "icp-ms": "ICP-MS",
}
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def nfc(text: Column) -> Column:
    """Canonical composition, which Spark has no function for; ASCII texts pass untouched."""

    def compose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))

    return F.pandas_udf(compose, "string")(text)


def clean_text(text: Column) -> Column:
    """Without control characters, doubled blanks, empty brackets, and brackets around the whole."""
    t = F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")
    t = F.regexp_replace(t, r"\(\s*\)|\[\s*\]", "")
    t = strip(F.regexp_replace(t, r"(?U)\s+", " "))
    return F.regexp_replace(t, r"^[(\[]([^()\[\]]*)[)\]]$", "$1")


def number(text: Column) -> Column:
    """The text as a double if it is one; guarded by a pattern, as casts accept endings like '1d'."""
    return F.when(strip(text).rlike(_NUMBER), strip(text).try_cast("double"))


def p_value(text: Column) -> Column:
    """The number, else the number without a leading p and comparison and without stars or brackets behind, else the
    first number in the text, else null."""
    bare = F.regexp_replace(strip(text), r"^[pP]?\s*[<>=≈]*\s*", "")
    bare = F.regexp_replace(bare, r"\*+$|\s*\(.*\)$", "")
    return F.coalesce(number(text), number(bare), F.nullif(F.regexp_extract(bare, r"(\d+\.?\d*)", 1), F.lit("")).try_cast("double"))


def mapped(value: Column, table: Mapping[str, str]) -> Column:
    """The value's canonical form from a small fixed map, compared in lower case; itself if it has none."""
    known = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.coalesce(known[F.lower(strip(value))], value)


def clean_evidence(text: Column) -> Column:
    """White space collapsed, and a leading fragment of a word dropped."""
    t = strip(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))
    first = F.regexp_extract(t, r"^([^ ]+) ", 1)
    fragment = (first != "") & (first == F.lower(first)) & first.rlike(r"\p{Ll}") & (F.char_length(first) <= 6) & ~first.isin(*SENTENCE_STARTS)
    return F.when(fragment, strip(t.substr(F.char_length(first) + 2, F.char_length(t)))).otherwise(t)


def table_reference(text: Column) -> Column:
    """'Table 3' or 'Figure 2' if the text names one."""
    t = F.regexp_extract(text, r"(?i)\b(?:Table|Tab\.)\s*(\d+)", 1)
    f = F.regexp_extract(text, r"(?i)\b(?:Figure|Fig\.)\s*(\d+)", 1)
    return F.when(t != "", F.concat(F.lit("Table "), t)).when(f != "", F.concat(F.lit("Figure "), f))


def conclusion(abstract: Column, markers: Sequence[str] = CONCLUSIONS) -> Column:
    """Of the last three sentences the last that starts with a marker, else the last sentence."""
    s = F.split(strip(abstract), r"(?<=[.!?])\s+")
    tail = F.slice(s, F.greatest(F.size(s) - 2, F.lit(1)), 3)
    marked = F.filter(tail, lambda x: F.lower(strip(x)).rlike("^(?:" + "|".join(markers) + ")"))
    return strip(F.coalesce(F.try_element_at(marked, F.lit(-1)), F.try_element_at(tail, F.lit(-1))))


def publication_date(year: Column, month: Column, day: Column) -> Column:
    """Y-M-D, Y-M or Y, as precise as given, months and days padded."""
    m, d = F.lpad(month, 2, "0"), F.lpad(day, 2, "0")
    return F.when(year.isNull(), None).when(month.isNull(), year).when(day.isNull(), F.concat_ws("-", year, m)).otherwise(F.concat_ws("-", year, m, d))
