"""Evidence and location of mentions as Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import looks_synthetic, nonblank, strip
from .values import table_reference


def window(text: Column, at: Column, size: Column, context: int) -> Column:
    """The text ``context`` characters on either side of ``size`` characters at a 0-based place; '' without one."""
    b = F.greatest(at - context, F.lit(0))
    return F.when(at.isNull() | (at < 0), "").otherwise(text.substr(b + 1, at + size + context - b))


def find_evidence(text: Column, mention: Column, context: int = 300, least: int = 4) -> Column:
    """Surroundings of the mention, else of the first of its words of ``least`` letters or more that the text holds, any case."""
    low, m = F.lower(text), F.lower(strip(mention))
    words = F.filter(F.split(m, r"(?U)\W+"), lambda w: (F.char_length(w) >= least) & low.contains(w))
    word = F.try_element_at(words, F.lit(1))
    whole = F.when(m != "", F.position(m, low) - 1)
    part = F.position(word, low) - 1
    return F.when(whole >= 0, window(text, whole, F.char_length(m), context)).otherwise(F.coalesce(window(text, part, F.char_length(word), context), F.lit("")))


def trimmed(evidence: Column, mention: Column, around: int = 10, most: int = 30) -> Column:
    """At most ``around`` words on either side of the mention's first word, or the first ``most`` words if it isn't there."""
    words = F.filter(F.split(F.coalesce(evidence, F.lit("")), r"(?U)\s+"), lambda w: w != "")
    first = F.lower(F.element_at(F.split(strip(F.coalesce(mention, F.lit(""))), r"(?U)\s+"), 1))
    at = F.array_position(F.transform(words, lambda w: F.lower(w).contains(first) & (first != "")), True)
    cut = F.slice(words, F.greatest(at - around, F.lit(1)).cast("int"), (F.least(at, F.lit(around + 1)) + around).cast("int"))
    return F.array_join(F.when(at > 0, cut).otherwise(F.slice(words, 1, most)), " ")


def location(section: Column, nearby: Column, aligned: Column, least: int = 20) -> Column:
    """The aligned sentence if it is longer than ``least`` characters, else the section and the table or figure nearby."""
    name = F.initcap(F.regexp_replace(F.coalesce(section, F.lit("")), "_", " "))
    return F.when(F.char_length(aligned) > least, aligned).otherwise(F.concat_ws(", ", F.nullif(name, F.lit("")), table_reference(nearby)))


def repaired_name(name: Column, evidence: Column, other: Column) -> Column:
    """A made-up label replaced by its words if the evidence has them, else by another stated name, else kept."""
    plain = F.regexp_replace(name, "_", " ")
    found = F.lower(F.coalesce(evidence, F.lit(""))).contains(F.lower(strip(plain)))
    return F.when(~looks_synthetic(name), name).when(found, plain).otherwise(F.coalesce(F.when(~looks_synthetic(other), nonblank(other)), name))


def normalized_attributes(attributes: Column, fields: Sequence[str], clean: Callable[[Column], Column]) -> Column:
    """The attribute map with the named fields cleaned, and blank values dropped."""
    cleaned = F.transform_values(attributes, lambda k, v: F.when(k.isin(*fields), clean(v)).otherwise(v))
    return F.map_filter(cleaned, lambda k, v: nonblank(v).isNotNull())
