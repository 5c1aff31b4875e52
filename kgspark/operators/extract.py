"""From model output to mentions: parsing, resolving, decomposing, and the extractor as an operator."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import strip
from ..session import checkpointed
from ..sources.tables import read_stage

_FENCE = re.compile(r"```(?:\w+)?\s*\n?(.*?)```", re.S)
_THINK = re.compile(r"<think>.*?</think>", re.S)


def parse_output(text: str, wrapper: str = "extractions", fmt: str = "json", strict: bool = False) -> list[dict]:
    """The list of extractions in a model's answer: fences and thoughts removed, JSON or YAML, wrapped or bare.

    ValueError if it is empty, can't be read, isn't a list of mappings with text keys, or, when strict, isn't exactly one
    fenced block.
    """
    body = _THINK.sub("", text or "")
    blocks = _FENCE.findall(body)
    if strict and len(blocks) != 1:
        raise ValueError("one fenced block is expected")
    body = (blocks[0] if blocks else body).strip()
    if not body:
        raise ValueError("empty output")
    try:
        if fmt == "yaml":
            import yaml

            data = yaml.safe_load(body)
        else:
            data = json.loads(body)
    except Exception as e:
        raise ValueError(f"unreadable output: {e}") from e
    if isinstance(data, dict):
        data = data.get(wrapper, [data] if wrapper not in data and data else [])
    if not isinstance(data, list) or any(not isinstance(x, dict) or any(not isinstance(k, str) for k in x) for x in data):
        raise ValueError("a list of mappings with text keys is expected")
    return data


def resolve_items(items: Sequence[dict], attributes: str = "_attributes", index: str = "_index") -> list[tuple[str, str, dict[str, str]]]:
    """(class, text, attributes) of each item in order: scalar values are mentions, ``<class>_attributes`` goes with them."""
    out = []
    for item in items:
        for k, v in item.items():
            if k.endswith((attributes, index)) or isinstance(v, (dict, list)) or v is None:
                continue
            raw = item.get(k + attributes)
            attrs = {a: x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for a, x in raw.items() if x is not None} if isinstance(raw, dict) else {}
            out.append((k, str(v), attrs))
    return out


def render_answer(mentions: Sequence[tuple[str, str, dict[str, str]]], wrapper: str = "extractions", attributes: str = "_attributes", fmt: str = "json", fenced: bool = False) -> str:
    """The answer that holds these mentions (class, text, attributes), as a worked example shows it to a model: what
    ``parse_output`` and ``resolve_items`` read back."""
    data = {wrapper: [{c: t} | ({c + attributes: a} if a else {}) for c, t, a in mentions]}
    if fmt == "yaml":
        import yaml

        body = yaml.safe_dump(data, allow_unicode=True, sort_keys=False)
    else:
        body = json.dumps(data, ensure_ascii=False, indent=2)
    return f"```{fmt}\n{body.rstrip()}\n```" if fenced else body


def resolve_outputs(outputs: DataFrame, keep: list[str], output: str, wrapper: str = "extractions", fmt: str = "json") -> DataFrame:
    """One row per mention: kept columns, ext_ord, extraction_class, extraction_text, attributes, parse_error.

    An output that can't be parsed gives one row with its error and no mention, so nothing is lost silently.
    """
    kept = ", ".join(f"`{c}` {outputs.schema[c].dataType.simpleString()}" for c in keep)
    names = ["ext_ord", "extraction_class", "extraction_text", "attributes", "parse_error"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple] = []
            for r in pdf.itertuples(index=False, name=None):
                try:
                    rows += [(*r[:-1], i, c, t, list(a.items()), None) for i, (c, t, a) in enumerate(resolve_items(parse_output(r[-1], wrapper, fmt)))]
                except ValueError as e:
                    rows.append((*r[:-1], -1, None, None, None, str(e).split(":")[0]))
            yield pd.DataFrame(rows, columns=[*keep, *names])

    out = outputs.select(*keep, F.col(output).alias("__output")).mapInPandas(run, f"{kept}, ext_ord int, extraction_class string, extraction_text string, attributes array<struct<k:string,v:string>>, parse_error string")
    return out.withColumn("attributes", F.map_from_entries("attributes"))


def resolve_simple(output: Column, cls: str) -> Column:
    """Mentions of one class in the JVM, for plain JSON in the wrapper: an array of (text, attributes); bad JSON gives null."""
    body = F.coalesce(F.nullif(F.regexp_extract(output, r"(?s)```(?:\w+)?\s*\n?(.*?)```", 1), F.lit("")), output)
    parsed = F.from_json(F.regexp_replace(body, r"(?s)<think>.*?</think>", ""), f"struct<extractions:array<struct<`{cls}`:string,`{cls}_attributes`:map<string,string>>>>")
    return F.filter(F.transform(parsed["extractions"], lambda x: F.struct(x[cls].alias("text"), x[f"{cls}_attributes"].alias("attributes"))), lambda x: x["text"].isNotNull())


# Patterns of names with 'and' that are one thing.
ONE_THING = (
    r"mono.*and\s+di.*and\s+tri", r"fatty\s+acid", r"\d+,\s*\d+.*and", r"β-.*and\s+β-", r"villi\s+and\s+crypt", r"mortality\s+and\s+", r"health\s+and\s+\w+", r"growth\s+and\s+\w+", r"quality\s+and\s+\w+",
    r"combination", r"complex", r"blend", r"mixture", r"extract.*and.*extract", r"powder", r"fiber", r"oil.*and.*oil", r"protein.*and", r"and.*protein", r"acid.*and.*acid", r"enzyme", r"cells", r"leaves.*and.*branch",
    r"fruit.*and.*vegetable", r"oil",
)


def split_conjunction(name: Column, whole: Sequence[str] = ONE_THING, longest: int = 60) -> Column:
    """The name, and its two sides if it reads 'A and B': more than five words, at most ``longest`` characters, more
    than one word on either side, and none of the patterns ``whole`` that mark a name as one thing."""
    t = strip(name)
    a, b = strip(F.regexp_extract(t, r"(?i)^(.+?)\s+and\s+(.+)$", 1)), strip(F.regexp_extract(t, r"(?i)^(.+?)\s+and\s+(.+)$", 2))
    spaces = F.char_length(t) - F.char_length(F.replace(t, F.lit(" "), F.lit("")))
    held = t.rlike("(?i)" + "|".join(whole)) if whole else F.lit(False)
    return F.when((a != "") & a.contains(" ") & b.contains(" ") & (spaces > 4) & (F.char_length(t) <= longest) & ~held, F.array(t, a, b)).otherwise(F.array(t))


def new_components(products: DataFrame, existing: DataFrame, scope: Sequence[str], components: str, name: str) -> DataFrame:
    """(scope, component): components of products, 3 letters or more and no placeholder, that the scope doesn't hold yet."""
    each = products.select(*scope, F.explode(components).alias("c")).select(*scope, strip(F.col("c")).alias("component"))
    each = each.where((F.char_length("component") >= 3) & ~F.lower("component").isin("none", "n/a"))
    one = each.groupBy(*scope, F.lower("component").alias("__k")).agg(F.min("component").alias("component"))
    have = existing.select(*scope, F.lower(strip(F.col(name))).alias("__k"))
    return one.join(have, [*scope, "__k"], "left_anti").drop("__k")


def context_line(rows: DataFrame, scope: Sequence[str], template: Column, order: str, separator: str = "; ") -> DataFrame:
    """(scope, context): one text per scope that names its entities in order, for the prompt of a later phase."""
    one = rows.groupBy(*scope, template.alias("__t")).agg(F.min(order).alias("__o"))
    return one.groupBy(*scope).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__o", "__t"))), lambda s: s["__t"]), separator).alias("context"))


#: Prompts to answers, in their order; None for an answer that failed and may be asked for again.
Extractor = Callable[[list[str]], list[str | None]]


class DictionaryExtractor:
    """An offline extractor: finds listed names in a prompt's text (behind ``mark``, if it has one) and answers as a model would."""

    def __init__(self, names: dict[str, Sequence[str]], mark: str = "\n\nText:\n") -> None:
        self.mark = mark
        self.names = {c: sorted(n, key=len, reverse=True) for c, n in names.items()}

    def __call__(self, prompts: list[str]) -> list[str]:
        find = {c: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, n)) + r")(?!\w)", re.I) for c, n in self.names.items() if n}
        return [json.dumps({"extractions": [{c: m.group()} for c, r in find.items() for m in r.finditer(p.rpartition(self.mark)[2])]}, ensure_ascii=False) for p in prompts]


def extract(prompts: DataFrame, keep: list[str], prompt: str, make: Callable[[], Extractor], batch: int = 32, retries: int = 3, wait: float = 1.0) -> DataFrame:
    """Kept columns, output and score: the extractor is made once per task and asked ``batch`` prompts at a time.

    What fails, a whole batch by an exception or single prompts by None, is asked again, up to ``retries`` times in all,
    after ``wait`` seconds and twice as long each further time; what still fails has an empty output with score 0.
    Results stand beside their own prompt. ValueError is for mistakes that asking again can't mend, and stops the job.
    """
    kept = ", ".join(f"`{c}` {prompts.schema[c].dataType.simpleString()}" for c in keep)

    def answers(ask: Extractor, texts: list[str]) -> list[str | None]:
        out: list[str | None] = [None] * len(texts)
        left = list(range(len(texts)))
        for attempt in range(retries):
            if attempt:
                time.sleep(wait * 2 ** (attempt - 1))
            try:
                got = ask([texts[i] for i in left])
            except ValueError:
                raise
            except Exception:  # noqa: BLE001
                got = []
            if len(got) == len(left):
                for i, o in zip(left, got):
                    out[i] = o
            left = [i for i in left if out[i] is None]
            if not left:
                break
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = make()
        for pdf in batches:
            texts = list(pdf["__p"])
            outs = [o for i in range(0, len(texts), batch) for o in answers(ask, texts[i : i + batch])]
            yield pdf[keep].assign(output=[o or "" for o in outs], score=[float(o is not None) for o in outs])

    return prompts.select(*keep, F.col(prompt).alias("__p")).mapInPandas(run, f"{kept}, output string, score double")


def cache_key(model: Column, system: Column, user: Column, settings: Column | None = None) -> Column:
    """Key of a cached answer; the model's settings are part of it."""
    return F.substring(F.sha2(F.concat_ws("|", model, system, user, *([settings] if settings is not None else [])), 256), 1, 16)


def with_cache(prompts: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(answered, open): prompts with their cached output, and those to ask."""
    return prompts.join(cache, key), prompts.join(cache.select(key), key, "left_anti")


class AnswerCache:
    """Answers kept from run to run, in a table folder that all workers share: (key, output).

    A prompt whose key is there isn't asked; equal prompts of a run are asked once. New answers are added as files of
    their own, so runs side by side don't disturb each other; of several answers to a key the first in order holds.
    Answers that failed aren't kept.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        stored = read_stage(self.spark, self.path)
        if stored is None:
            return self.spark.createDataFrame([], "key string, output string")
        return stored.groupBy("key").agg(F.min("output").alias("output"))

    def add(self, answers: DataFrame) -> None:
        answers.where("score > 0").select("key", "output").distinct().write.mode("append").parquet(self.path)

    def clear(self) -> None:
        """Forgets all answers."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def extract(self, prompts: DataFrame, keep: list[str], prompt: str, key: str, make: Callable[[], Extractor], **how) -> DataFrame:
        """As ``extract``, by the cache: kept columns, output and score; ``key`` is the column of the prompts' keys."""
        named = prompts.select(*keep, F.col(prompt).alias("__p"), F.col(key).alias("__k"))
        answered, open_ = with_cache(named, self.read().withColumnRenamed("key", "__k"), "__k")
        asked = checkpointed(extract(open_.groupBy("__k").agg(F.min("__p").alias("__q")), ["__k"], "__q", make, **how))
        self.add(asked.withColumnRenamed("__k", "key"))
        found = answered.select(*keep, "output", F.lit(1.0).alias("score"))
        return found.unionByName(open_.join(asked, "__k").select(*keep, "output", "score"))
