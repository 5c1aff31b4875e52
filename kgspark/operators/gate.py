"""Gates: a condition on a document's entities decides whether the document goes on."""

from __future__ import annotations

import ast
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import nonblank

_IN = re.compile(r"\s*(\w+)\s+(not\s+in|in)\s+(\[.*\])\s*", re.S)
_SET = re.compile(r"\s*(\w+)?\s*(not_empty|not empty|exists|is set)\s*")


def condition(text: str, field) -> Column | None:
    """A condition as a Column, None if it can't be read: ``f in [..]``, ``f not in [..]``, ``f exists``, ``not_empty``.

    ``field`` gives the Column of a field. Lists are compared in lower case; a missing value counts as ''.
    """
    if m := _IN.fullmatch(text):
        try:
            values = [str(v).lower() for v in ast.literal_eval(m[3])]
        except (ValueError, SyntaxError):
            return None
        hit = F.lower(F.coalesce(field(m[1]), F.lit(""))).isin(*values) if values else F.lit(False)
        return ~hit if m[2].startswith("not") else hit
    if m := _SET.fullmatch(text):
        return nonblank(field(m[1])).isNotNull() if m[1] else F.lit(True)
    return None


def split(documents: DataFrame, entities: DataFrame, document: str, passes: Column | None) -> tuple[DataFrame, DataFrame]:
    """(passed, failed): documents with and without an entity that meets the condition; without one all pass."""
    if passes is None:
        return documents, documents.limit(0)
    good = entities.where(passes).select(document).distinct()
    return documents.join(good, document, "left_semi"), documents.join(good, document, "left_anti")
