"""Expressions shared by the SQL texts."""

from __future__ import annotations


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def folded(x: str) -> str:
    return f"lower({strip(f'coalesce({x}, {chr(39) * 2})')})"


def spaced(x: str) -> str:
    return rf"regexp_replace({x}, '\s+', ' ', 'g')"


def graph_name(x: str) -> str:
    return spaced(f"regexp_replace({folded(x)}, '[-_]', ' ', 'g')")


def coref_name(x: str) -> str:
    bare = rf"regexp_replace({folded(x)}, '\s*\([^)]*\)', '', 'g')"
    return strip(spaced(f"regexp_replace({bare}, '[-_/.,;:]', ' ', 'g')"))


def dedup_name(x: str) -> str:
    return spaced(folded(x))


def vocab_name(x: str) -> str:
    return spaced(rf"regexp_replace({folded(x)}, '[^\w\s]', '', 'g')")


def relation_name(x: str) -> str:
    bare = rf"regexp_replace({folded(x)}, '\s*\([^)]*\)', '', 'g')"
    return strip(spaced(rf"regexp_replace({bare}, '[^\w\s]', '', 'g')"))


def global_id(prefix: str, cls: str, name: str, document: str | None = None) -> str:
    tail = f" || ':' || coalesce({document}, '')" if document else ""
    return f"'{prefix}_' || substr(sha256('{cls}:' || {graph_name(name)}{tail}), 1, 12)"


ENTRY = rf"""entries AS (SELECT lower({strip(r"regexp_replace(raw, '\s*\([^)]*\)\s*$', '')")}) AS key, alternative_class AS entry_class, subclass AS entry_subclass
  FROM (SELECT unnest(string_split(names, ',')) AS raw, alternative_class, subclass FROM vocabulary) WHERE trim(raw) <> '')"""
