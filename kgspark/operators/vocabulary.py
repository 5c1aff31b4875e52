"""Matching names to a vocabulary: exact, then cheaper to dearer tiers on what is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import coref_name, strip, vocab_name
from ..session import checkpointed
from .similarity import contains_join, near_join

#: A vocabulary beyond this many keys isn't broadcast.
MAX_KEYS = 100_000
#: Up to so many keys comparing a name with all of them costs less than taking it apart into grams and segments.
LOOP_KEYS = 1_000


def entry_name(raw: Column) -> Column:
    """An item of the key column without a bracketed end."""
    return F.lower(strip(F.regexp_replace(raw, r"(?U)\s*\([^)]*\)\s*$", "")))


def load(rows: DataFrame, names: str, cls: str, subclass: str) -> DataFrame:
    """(key, pos, entry_class, entry_subclass): one row per key of the comma lists; of equal keys the last row wins."""
    ordered = rows.select(names, cls, subclass).withColumn("__r", F.monotonically_increasing_id())
    items = ordered.select(F.posexplode(F.split(names, ",")).alias("__i", "raw"), "__r", F.col(cls).alias("entry_class"), F.col(subclass).alias("entry_subclass"))
    keyed = items.withColumn("key", entry_name(F.col("raw"))).where("key <> ''")
    best = keyed.groupBy("key").agg(F.max_by(F.struct("entry_class", "entry_subclass"), F.struct("__r", "__i")).alias("e"))
    return best.select("key", "e.entry_class", "e.entry_subclass")


def is_small(vocabulary: DataFrame) -> bool:
    """Whether a vocabulary has so few keys that it may be broadcast."""
    return vocabulary.select("key").limit(MAX_KEYS + 1).count() <= MAX_KEYS


def small(vocabulary: DataFrame) -> DataFrame:
    """The vocabulary marked for broadcasting if it is small enough to prove it, else as it is."""
    return F.broadcast(vocabulary) if is_small(vocabulary) else vocabulary


def _plain(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"(?U)[^\p{L}\p{N}]", "")


def cascade(names: DataFrame, name: str, vocabulary: DataFrame, least: int = 3, edits: int = 3) -> DataFrame:
    """(name, tier, key, entry_class, entry_subclass, match_source) for each distinct non-blank name.

    Tier 1 exact, 2 without punctuation, 3 one contains the other, 4 letters and digits only, 5 at most ``edits``
    edits, 6 a part between commas by tiers 1 to 5; match_source is 'exact', 'fuzzy' or 'unmatched'. Within a tier the
    fewest edits, then the first key win. Keys shorter than ``least`` take part in the equal tiers only. All tiers are
    equi-joins over distinct names, on forms, on grams and on segments; the looser ones see only what the equal ones
    leave. The forms of a vocabulary that is small (``MAX_KEYS``) are broadcast; with very few keys (``LOOP_KEYS``) the
    looser tiers compare a name with all of them, with the same outcome.
    """
    v = checkpointed(vocabulary)
    n_keys = v.select("key").limit(MAX_KEYS + 1).count()
    distinct = names.select(F.col(name).alias("name")).where(strip(F.col("name")) != "").distinct()
    distinct = checkpointed(distinct)
    first = checkpointed(_tiers(distinct.select("name", "name", F.lower(strip(F.col("name"))).alias("n")).toDF("name", "whole", "n"), v, least, edits, n_keys))
    left = distinct.where(F.col("name").contains(",")).join(first, "name", "left_anti")
    parts = left.select("name", F.posexplode(F.split("name", ",")).alias("i", "p")).select("name", "i", F.lower(strip(F.col("p"))).alias("n")).where("n <> ''")
    by_part = _tiers(parts.select(F.concat_ws("\u0000", "name", "n").alias("name"), F.col("name").alias("whole"), "n"), v, least, edits, n_keys)
    sixth = by_part.groupBy("whole").agg(F.min_by(F.struct("key", "entry_class", "entry_subclass"), F.struct("tier", "dist", "key")).alias("b"), F.lit(6).alias("tier"))
    found = first.select("name", "tier", "key", "entry_class", "entry_subclass").unionByName(sixth.select(F.col("whole").alias("name"), "tier", "b.key", "b.entry_class", "b.entry_subclass"))
    out = distinct.join(found, "name", "left")
    source = F.when(F.col("tier").isNull(), "unmatched").when(F.col("tier") == 1, "exact").otherwise("fuzzy")
    return out.withColumn("entry_class", F.coalesce("entry_class", F.lit("Other"))).withColumn("match_source", source)


def _tiers(names: DataFrame, v: DataFrame, least: int, edits: int, n_keys: int) -> DataFrame:
    """Best hit of each name by tiers 1 to 5; ``names`` has name, whole and n, the form compared."""
    forms = lambda c: F.explode(F.array(F.struct(F.lit(1).alias("tier"), c.alias("form")), F.struct(F.lit(2).alias("tier"), vocab_name(c).alias("form")), F.struct(F.lit(4).alias("tier"), _plain(c).alias("form")))).alias("f")
    mine = names.select("name", "whole", forms(F.col("n"))).select("name", "whole", "f.tier", "f.form").where("form <> ''")
    theirs = v.select("key", "entry_class", "entry_subclass", forms(F.col("key"))).select("key", "entry_class", "entry_subclass", "f.tier", "f.form").where("form <> ''")
    best = lambda df: df.groupBy("name", "whole").agg(F.min_by(F.struct("tier", "dist", "key", "entry_class", "entry_subclass"), F.struct("tier", "dist", "key")).alias("b")).select("name", "whole", "b.*")
    equal = checkpointed(best(mine.join(F.broadcast(theirs) if n_keys <= MAX_KEYS else theirs, ["tier", "form"]).withColumn("dist", F.lit(0))))
    # a name equal only in letters and digits may still contain a key, which comes first
    left = names.join(equal.where("tier < 3"), "name", "left_anti")
    forms = left.select("n").where("n <> ''").distinct()
    keys = v.where(F.char_length("key") >= least).select("key")
    if n_keys <= LOOP_KEYS:
        long, dist = F.char_length("n") >= least, F.levenshtein("n", "key", edits)
        holds = (F.col("n").contains(F.col("key")) | F.col("key").contains(F.col("n"))) & long
        met = forms.join(F.broadcast(keys), holds | (dist >= 0)).select("n", "key", F.when(holds, 3).otherwise(5).alias("tier"), dist.alias("dist"))
        loose = left.join(met, "n").join(F.broadcast(v), "key").withColumn("dist", F.when(F.col("dist") >= 0, F.col("dist")).otherwise(edits + 1))
        return best(equal.unionByName(loose.select(*equal.columns)))
    inside = contains_join(forms.where(F.char_length("n") >= least), keys, [], "n", "key").select("n", "key", F.lit(3).alias("tier"), F.levenshtein("n", "key", edits).alias("dist"))
    near = near_join(forms, keys, [], "n", "key", edits).select("n", "key", F.lit(5).alias("tier"), F.col("edits").alias("dist"))
    # one row for each pair: what contains is of tier 3, whatever the edits
    met = inside.unionByName(near).groupBy("n", "key").agg(F.min("tier").alias("tier"), F.max("dist").alias("dist"))
    loose = left.join(met, "n").join(v, "key").withColumn("dist", F.when(F.col("dist") >= 0, F.col("dist")).otherwise(edits + 1))
    return best(equal.unionByName(loose.select(*equal.columns)))


def second_pass(unmatched: DataFrame, name: str, vocabulary: DataFrame, least: int = 3) -> DataFrame:
    """(name, entry_class) of the longest key that a name of class 'Other' contains or lies in, other than 'Other'."""
    v = vocabulary.where((F.col("entry_class") != "Other") & (F.char_length("key") >= least))
    forms = unmatched.select(name, F.lower(strip(F.col(name))).alias("__n")).where("__n <> ''").distinct()
    met = contains_join(forms.select("__n").distinct(), v, [], "__n", "key").where((F.char_length("__n") >= least) | F.col("__n").contains(F.col("key")))
    best = met.groupBy("__n").agg(F.min_by("entry_class", F.struct(-F.char_length("key"), "key")).alias("entry_class"))
    return forms.join(best, "__n").select(name, "entry_class")


def synonyms(vocabulary_rows: DataFrame, names: str) -> DataFrame:
    """(alias, canonical): every further name of an entry, given in brackets behind it, beside the entry."""
    items = vocabulary_rows.select(F.explode(F.split(names, ",")).alias("raw"))
    pair = items.select(coref_name(F.col("raw")).alias("canonical"), coref_name(F.regexp_extract("raw", r"\(([^)]*)\)", 1)).alias("alias"))
    return pair.where("alias <> '' AND canonical <> ''").groupBy("alias").agg(F.min("canonical").alias("canonical"))


def summary(rows: DataFrame, cls: str, subclass: str, names: str, k: int = 3) -> DataFrame:
    """Per class and subclass the number of names and the first ``k`` in alphabetical order, for prompts."""
    items = rows.select(cls, subclass, F.explode(F.split(names, ",")).alias("raw")).select(cls, subclass, entry_name(F.col("raw")).alias("n")).where("n <> ''").distinct()
    numbered = items.withColumn("__i", F.row_number().over(Window.partitionBy(cls, subclass).orderBy("n")))
    return numbered.groupBy(cls, subclass).agg(F.count(F.lit(1)).alias("n_names"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("__i") <= k, F.col("n")))), "; ").alias("examples"))
