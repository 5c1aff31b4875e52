"""JATS XML articles as rows."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import conclusion

SCHEMA = (
    "document_id string, file_path string, pmcid string, pmid string, doi string, title string, journal string, abstract_text string, body_text string, "
    "publication_year string, publication_date string, sections array<struct<section_key:string,section_text:string>>, parse_warnings array<string>"
)
# Kinds of publication date, best first; others come last.
DATE_RANKS = {"epub": 0, "ppub": 0, "pmc-release": 1, "collection": 2}
# Words of a section's title that decide its key.
SECTION_WORDS = (("introduction", ("introduction", "background")), ("methods", ("method", "materials")), ("results", ("result",)), ("discussion", ("discussion", "conclusion")))
# Words in a section's key that make it part of a phase's text, and those that keep it out of the fallback.
PHASE_WORDS = {"methods": ("method", "material", "experiment", "animal", "sample", "design", "diet", "management", "collection", "analysis", "chemical", "statistical", "data"), "results": ("result", "discussion", "conclusion")}
NOT_METHODS = ("intro", "discussion", "conclusion", "result")


def _bare(root: ET.Element) -> ET.Element:
    """The tree without namespaces."""
    for e in root.iter():
        if isinstance(e.tag, str):
            e.tag = e.tag.rpartition("}")[2]
    return root


def _text(e: ET.Element | None) -> str:
    return "".join(e.itertext()).strip() if e is not None else ""


def section_key(title: str) -> str:
    t = title.strip().lower()
    for key, words in SECTION_WORDS:
        if any(w in t for w in words):
            return key
    return t.replace(" ", "_")[:30] if t else "other"


def parse_article(path: str, content: bytes) -> dict:
    """One article as a row; what can't be read becomes a warning and the rest is kept."""
    row: dict = {c.split()[0]: None for c in SCHEMA.split(", ")} | {"file_path": path, "sections": [], "parse_warnings": [], "title": "", "journal": "", "abstract_text": "", "body_text": ""}
    try:
        root = _bare(ET.fromstring(content))
        front, body = root.find(".//front"), root.find(".//body")
        if front is not None:
            for e in front.iter("article-id"):
                kind = {"pmc": "pmcid"}.get(e.get("pub-id-type", ""), e.get("pub-id-type", ""))
                if kind in ("doi", "pmid", "pmcid") and _text(e):
                    row[kind] = _text(e)
            row["title"], row["journal"], row["abstract_text"] = (_text(front.find(f".//{t}")) for t in ("article-title", "journal-title", "abstract"))
            dates = [((d.get("pub-type") or d.get("date-type") or "").strip(), d) for d in front.iter("pub-date")]
            if dates:
                best = min(dates, key=lambda x: DATE_RANKS.get(x[0], 3))[1]
                y, m, d = (_text(best.find(t)) for t in ("year", "month", "day"))
                row["publication_year"] = y or None
                row["publication_date"] = "-".join([y, *([m.zfill(2)] if m else []), *([d.zfill(2)] if m and d else [])]) if y else None
        if body is not None:
            row["body_text"] = _text(body)
            found: dict[str, str] = {}
            for sec in body.iter("sec"):
                k, t = section_key(_text(sec.find("title"))), _text(sec)
                found[k] = found[k] + "\n\n" + t if k in found else t
            row["sections"] = [{"section_key": k, "section_text": t} for k, t in found.items()]
    except ET.ParseError as e:
        row["parse_warnings"].append(f"XML parse error: {e}")
    row["document_id"] = row["pmid"] or row["pmcid"] or re.sub(r"\.[^.]*$", "", path.rsplit("/", 1)[-1])
    return row


def read_articles(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """Articles of all files below ``path`` that match ``glob``, one row per file, parsed in the tasks that read them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", "content")
    if files.isEmpty():
        raise FileNotFoundError(f"no {glob} in {path}")

    return parse_files(files)


def parse_files(files: DataFrame) -> DataFrame:
    """Articles of (path, content), one row per file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([parse_article(p, bytes(c)) for p, c in zip(pdf["path"], pdf["content"])], columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return files.mapInPandas(run, SCHEMA)


def to_documents(articles: DataFrame) -> DataFrame:
    """(document_id, text, additional_context): abstract and body, and the metadata as JSON."""
    text = F.concat_ws("\n\n", F.nullif("abstract_text", F.lit("")), F.nullif("body_text", F.lit("")))
    meta = F.to_json(F.struct("title", "journal", "doi", "pmid", "pmcid", "publication_year"))
    return articles.select("document_id", text.alias("text"), meta.alias("additional_context"))


def literature(articles: DataFrame) -> DataFrame:
    """(document_id, cls, name, attributes, evidence_text, source_location): what an article's front matter says of the
    article itself, read without a model; articles with neither title nor doi give none. Missing values are left out."""
    stated = lambda c: F.nullif(F.col(c).cast("string"), F.lit(""))
    fields = {c: stated(c) for c in ("doi", "pmid", "title", "journal", "publication_year", "publication_date") if c in articles.columns}
    fields["abstract_conclusion"] = F.nullif(conclusion(F.coalesce("abstract_text", F.lit(""))), F.lit(""))
    attributes = F.map_filter(F.create_map(*(x for k, c in fields.items() for x in (F.lit(k), c))), lambda k, v: v.isNotNull())
    place = F.concat(F.lit("front-matter:"), F.element_at(F.split("file_path", "/"), -1))
    a = articles.where(stated("title").isNotNull() | stated("doi").isNotNull())
    return a.select("document_id", F.lit("Literature").alias("cls"), F.coalesce(stated("title"), F.col("document_id")).alias("name"), attributes.alias("attributes"), F.coalesce("title", F.lit("")).alias("evidence_text"), F.coalesce(place, F.lit("front-matter:")).alias("source_location"))


def phase_text(articles: DataFrame, phase: str) -> DataFrame:
    """(document_id, phase_text): the sections of a phase by the words in their keys, else its fallback, else the body.

    'gate' is the abstract, else the first 2000 characters of the body.
    """
    nonempty = lambda c: F.nullif(c, F.lit(""))
    texts = lambda keep: nonempty(F.array_join(F.transform(F.filter("sections", keep), lambda s: s["section_text"]), "\n\n"))
    has = lambda s, words: F.lower(s["section_key"]).rlike("|".join(words))
    if phase == "gate":
        out = F.coalesce(nonempty(F.col("abstract_text")), F.substring("body_text", 1, 2000))
    elif phase == "methods":
        out = F.coalesce(texts(lambda s: has(s, PHASE_WORDS["methods"])), texts(lambda s: ~has(s, NOT_METHODS)), "body_text")
    elif phase == "results":
        out = F.coalesce(texts(lambda s: has(s, PHASE_WORDS["results"])), "body_text")
    else:
        out = F.concat_ws("\n\n", nonempty(F.col("abstract_text")), nonempty(F.col("body_text")))
    return articles.select("document_id", F.coalesce(out, F.lit("")).alias("phase_text"))


def read_texts(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """(document_id, text): one row per plain-text file; the id is the file's stem."""
    df = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    return df.select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1).alias("document_id"), F.col("value").alias("text"))


def unprocessed(files: DataFrame, done: DataFrame, key: str = "document_id") -> DataFrame:
    """Rows whose key isn't among those done: a job that resumes."""
    return files.join(done.select(key).distinct(), key, "left_anti")
