"""The reference lists of the test tables as matchers: entries, their other names, and what a careful reader knows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from .canonical import DENIED, MAX_NAMES, Matcher, key_of, verb_forms

# Other words for the entries, beside those that the list names.
WORDS = {
    "increased": ("augmented", "greater", "gain", "raised", "heightened", "enhanced", "improved", "grew", "risen", "rising", "upward", "larger", "more", "increment", "boosted"),
    "decreased": ("diminished", "smaller", "less", "lesser", "lowered", "fell", "fallen", "falling", "dropped", "drop", "reduction", "declined", "declining", "downward", "decrement", "depressed", "suppressed"),
    "no_significant_change": ("comparable", "similar", "same", "equal", "stable", "unaffected", "unaltered", "remained unchanged", "nonsignificant", "nsd"),
    "increases": ("elevates", "augments", "enhances", "higher"),
    "decreases": ("diminishes", "lessens", "lower", "reduction"),
    "upregulates": ("up-reg", "induces", "overexpresses"),
    "downregulates": ("down-reg", "represses"),
    "enriches": ("enrichment",),
    "depletes": ("depletion",),
    "affects": ("impacts", "regulates", "dysregulates", "deregulates"),
}
#: An entry of this name is what a denied change stands for: a denial before any of these words or another entry's
#: names, with or without a word for its significance between.
UNCHANGED = "no_significant_change"
CHANGES = ("change", "changed", "difference", "different", "differ", "effect", "altered", "significant", "sig")
DEGREES = ("", "significant", "significantly", "sig")


def _rows(df: DataFrame) -> list:
    """All rows of a reference list; one beyond MAX_NAMES rows is refused."""
    rows = df.limit(MAX_NAMES + 1).collect()
    if len(rows) > MAX_NAMES:
        raise ValueError(f"the reference list has more than {MAX_NAMES} rows")
    return rows


def alias_paths(listed: list[str], known_as: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(name, entry) of everything that leads to the entries of one field: the entries, their other names, inflected forms
    of those that are verbs, and denials of the other entries' names. Where names meet, the one given first stays."""
    own: dict[str, str] = {}
    names = {e: [e, *known_as[e], *WORDS.get(e, ())] for e in listed}
    for e in listed:
        own[key_of(e)] = e
    for e in listed:
        for x in known_as[e]:
            own.setdefault(key_of(x), e)
    for e in listed:
        for x in names[e]:
            own.setdefault(key_of(x), e)
    for e in listed:
        for x in names[e]:
            if re.fullmatch(r"[a-z]{5,}", x):
                for form in verb_forms(x):
                    own.setdefault(key_of(form), e)
    if UNCHANGED in listed:
        for x in [*CHANGES, *(k for k, e in own.items() if e != UNCHANGED)]:
            for d in DEGREES:
                own.setdefault(DENIED + key_of(d + x), UNCHANGED)
    return list(own.items())


def value_matchers(canonical: DataFrame) -> tuple[dict[str, Matcher], dict[str, list[str]]]:
    """Matchers and entries by field from canonical_values."""
    entries: dict[str, list[str]] = {}
    given: dict[str, dict[str, list[str]]] = {}
    for r in _rows(canonical):
        if r["field_name"] and r["entry"]:
            known = given.setdefault(r["field_name"], {}).setdefault(r["entry"], [])
            known += [x for x in (r["known_as"] or []) if x]
            entries[r["field_name"]] = list(given[r["field_name"]])
    return {f: Matcher(alias_paths(listed, given[f])) for f, listed in entries.items()}, entries


def vocabulary_entries(vocabulary: DataFrame) -> list[tuple[str, str | None]]:
    """(entry, abbreviation) of each item of the comma lists in ``names``."""
    out: dict[str, str | None] = {}
    for r in _rows(vocabulary.select("names")):
        for item in (r["names"] or "").split(","):
            m = re.fullmatch(r"\s*(.*?)\s*(?:\(([^()]*)\))?\s*", item, re.S)
            if m and m[1]:
                out[m[1]] = out.get(m[1]) or (m[2] or "").strip() or None
    return list(out.items())


def vocabulary_matcher(vocabulary: DataFrame) -> tuple[Matcher, list[str]]:
    """The vocabulary's matcher: entries, abbreviations, and binomials with the genus shortened where that is unique."""
    listed = vocabulary_entries(vocabulary)
    names = [(e, e) for e, _ in listed]
    taken = {key_of(e) for e, _ in listed}
    names += [(a, e) for e, a in listed if a and key_of(a) not in taken]
    short: dict[str, set[str]] = {}
    for e, _ in listed:
        if m := re.fullmatch(r"([A-Z])[a-z]+ ([a-z]+)", e):
            short.setdefault(f"{m[1]} {m[2]}", set()).add(e)
    names += [(s, next(iter(e))) for s, e in short.items() if len(e) == 1]
    return Matcher(names), [e for e, _ in listed]
