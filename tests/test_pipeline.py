"""End to end with an offline extractor; settings; evidence functions; command line."""

import json

import pytest
from pyspark.sql import functions as F

from kgspark.__main__ import main
from kgspark.config import Settings
from kgspark.functions import evidence as E
from kgspark.operators import vocabulary
from kgspark.operators.extract import DictionaryExtractor
from kgspark.pipeline import deliver, run
from kgspark.registry import Registry

ENTITIES = {
    "Alternative": {"primary_text": "standard_name", "dedup_mode": "fuzzy", "priority": 2, "attributes": [{"name": "standard_name"}, {"name": "classification", "source": "post"}]},
    "Indicator": {"primary_text": "abbreviation", "dedup_mode": "exact", "attributes": [{"name": "abbreviation"}]},
    "Result": {"primary_text": "indicator_abbreviation", "dedup_mode": "article", "attributes": [{"name": "indicator_abbreviation", "required": True}], "references": [{"name": "indicator_abbreviation", "target_entity": "Indicator", "target_field": "abbreviation", "edge_type": "corresponds_to"}]},
}
PHASES = {
    "gate": {"sections": ["gate"], "extracts": ["Alternative"], "gate": {"entity": "Alternative", "condition": "classification not in ['Other', '']"}},
    "results": {"sections": ["results"], "extracts": ["Indicator", "Result"]},
}


class Fake(DictionaryExtractor):
    def __call__(self, prompts):
        out = []
        for text, answer in zip(prompts, super().__call__(prompts)):
            items = json.loads(answer)["extractions"]
            items += [{"Result": "ADG rose", "Result_attributes": {"indicator_abbreviation": "ADG"}}] if "ADG rose" in text else []
            out.append("```json\n" + json.dumps({"extractions": items}) + "\n```" if "broken" not in text else "not json")
        return out


def articles(spark):
    rows = [
        ("1", "Thymol was fed to pigs.", "We fed thymol. ADG rose in all pigs.", [("results", "ADG rose in all pigs. ADG was measured twice.")]),
        ("2", "Nothing of interest here.", "ADG rose.", [("results", "ADG rose.")]),
        ("3", "thymol again, and thymoll.", "broken", [("results", "broken")]),
    ]
    return spark.createDataFrame([(a, f"/{a}.xml", a, None, None, "T", "J", ab, b, s) for a, ab, b, s in rows], "document_id string, file_path string, pmid string, pmcid string, doi string, title string, journal string, abstract_text string, body_text string, sections array<struct<section_key:string,section_text:string>>").withColumn("publication_year", F.lit("2024"))


def test_run(spark, tmp_path):
    reg = Registry.from_mappings(ENTITIES, PHASES)
    voc = vocabulary.load(spark.createDataFrame([("Plant", "oil", "thymol (THY)")], "c string, s string, n string"), "n", "c", "s")
    res = run(articles(spark), reg, lambda: Fake({"Alternative": ["thymol", "thymoll"], "Indicator": ["ADG"]}), Settings(), {"Alternative": voc})
    assert sorted(r["document_id"] for r in res.passed.collect()) == ["1", "3"] and [r["document_id"] for r in res.failed.collect()] == ["2"]
    assert [r["document_id"] for r in res.errors.collect()] == ["3"]
    nodes = {(r["label"], r["name"].lower()): r for r in res.nodes.collect()}
    assert nodes["Alternative", "thymol"]["source_pmids"] in (["1"], ["1", "3"]) and ("Indicator", "adg") in nodes
    assert [r["type"] for r in res.edges.collect()] == ["corresponds_to"]
    m = {(r["document_id"], r["cls"], r["name"]): r for r in res.mentions.collect()}
    assert m["1", "Indicator", "ADG"]["n_rows"] == 2 and "ADG rose" in m["1", "Indicator", "ADG"]["evidence_text"]
    deliver(res, reg, str(tmp_path))
    assert spark.read.option("header", True).csv(str(tmp_path / "graph/nodes")).count() == len(nodes)
    assert spark.read.option("header", True).csv(str(tmp_path / "manifest")).count() == 2
    skipped = run(articles(spark), reg, lambda: Fake({"Alternative": ["thymol"], "Indicator": ["ADG"]}), Settings(skip_gate=True), {"Alternative": voc})
    assert skipped.passed.count() == 3


def test_settings(spark, monkeypatch):
    monkeypatch.setenv("KGSPARK_BATCH", "7")
    assert Settings.load(spark).batch == 7 and Settings.load(spark, batch=9).batch == 9
    with pytest.raises(ValueError):
        Settings.load(nonsense=1)


def test_evidence(spark):
    df = spark.createDataFrame([("We fed corn. Then thymol oil was given to all pigs.", "thymol oil", "feed_additive")], "t string, m string, s string")
    one = lambda c: df.select(c.alias("x")).first()["x"]
    t, m = F.col("t"), F.col("m")
    assert one(E.find_evidence(t, m, 5)) == "Then thymol oil was "
    assert one(E.find_evidence(t, F.lit("thymol extract"), 0)) == "thymol" and one(E.find_evidence(t, F.lit("zinc"), 5)) == ""
    assert one(E.trimmed(t, m, 1)) == "Then thymol oil" and one(E.trimmed(t, F.lit("zinc"), 1, 3)) == "We fed corn."
    assert one(E.location(F.lit("methods_section"), F.lit("see Table 2"), F.lit("short"))) == "Methods Section, Table 2"
    assert one(E.repaired_name(F.lit("thymol_oil"), t, F.lit(None).cast("string"))) == "thymol oil"
    assert one(E.repaired_name(F.lit("a_b"), t, F.lit("Zinc"))) == "Zinc" and one(E.repaired_name(F.lit("Zinc"), t, t)) == "Zinc"
    a = spark.createDataFrame([({"standard_name": " x ", "k": " y ", "z": " "},)], "a map<string,string>").select(E.normalized_attributes(F.col("a"), ["standard_name"], F.trim).alias("a")).first()["a"]
    assert a == {"standard_name": "x", "k": " y "}


def test_debug(tmp_path, capsys):
    f = tmp_path / "a.xml"
    f.write_text("<article><body><sec><title>Results</title><p>x</p></sec></body></article>")
    assert main(["debug", str(f)]) == 0
    assert json.loads(capsys.readouterr().out)["sections"][0]["section_key"] == "results"


class Named(DictionaryExtractor):
    """Indicators named in full with their abbreviation, and results that name them by it."""

    def __call__(self, prompts):
        full = {"Indicator": "average daily gain", "Indicator_attributes": {"abbreviation": "ADG"}}
        results = [{"Result": t, "Result_attributes": {"indicator_abbreviation": v}} for t, v in (("gain rose", "ADG"), ("gain fell", "average daily gain"), ("intake rose", "FI"))]
        return [json.dumps({"extractions": [full, {"Indicator": "average daily gains"}, *results]}) for _ in prompts]


def test_references_reach_nodes_by_identity(spark, tmp_path):
    reg = Registry.from_mappings(ENTITIES | {"Indicator": ENTITIES["Indicator"] | {"dedup_mode": "fuzzy"}}, {"results": PHASES["results"]})
    docs = articles(spark).limit(1).withColumn("sections", F.expr("transform(sections, s -> named_struct('section_key', s.section_key, 'section_text', 'The average daily gain (ADG): gain rose, gain fell, intake rose; average daily gains.'))"))
    res = run(docs, reg, lambda: Named({}), Settings())
    label = {r["id"]: (r["label"], r["name"]) for r in res.nodes.collect()}
    ends = sorted((label[r["source_id"]][1], label[r["target_id"]][0]) for r in res.edges.collect())
    # one source per stated indicator; both spellings reach the same node
    assert len({r["target_id"] for r in res.edges.collect()}) == 1 and {e[1] for e in ends} == {"Indicator"} and len(ends) == 2
    assert [(r["value"], r["type"], r["targets"]) for r in res.unresolved.collect()] == [("FI", "corresponds_to", ["Indicator"])]
    deliver(res, reg, str(tmp_path))
    assert spark.read.option("header", True).csv(str(tmp_path / "graph/unresolved")).count() == 1


def test_batch_with_vocabulary_passes_the_gate(spark, tmp_path):
    docs = tmp_path / "in"
    docs.mkdir()
    (docs / "1.xml").write_text("<article><front><article-meta><abstract><p>Thymol was fed to pigs.</p></abstract></article-meta></front><body><sec><title>Results</title>\n<p>ADG rose in all pigs.</p></sec></body></article>")
    for name, data in (("entities", ENTITIES), ("phases", PHASES), ("names", {"Alternative": ["thymol"], "Indicator": ["ADG"]})):
        (tmp_path / f"{name}.json").write_text(json.dumps(data))
    (tmp_path / "v.tsv").write_text("c\ts\tn\nPlant\toil\tthymol (THY)\n")
    args = ["batch", str(docs), str(tmp_path / "out"), *(x for n in ("entities", "phases", "names") for x in (f"--{n}", str(tmp_path / f"{n}.json")))]
    assert main([*args, "--vocabulary", "Alternative", str(tmp_path / "v.tsv"), "n", "c", "s"]) == 0
    nodes = spark.read.option("header", True).csv(str(tmp_path / "out/graph/nodes"))
    assert nodes.count() == 2
    assert spark.read.option("header", True).csv(str(tmp_path / "out/manifest")).count() == 1


class Twice(DictionaryExtractor):
    """Finds more in its second pass; counts what it is asked in a folder."""

    def __init__(self, names, folder):
        super().__init__(names)
        self.folder = folder

    def __call__(self, prompts):
        import uuid

        for p in prompts:
            (self.folder / uuid.uuid4().hex).write_text(p)
        return super().__call__(prompts)


def test_passes_cache_and_graph_of_classes(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()
    reg = Registry.from_mappings(ENTITIES | {"Literature": {"primary_text": "title", "dedup_mode": "exact", "attributes": [{"name": "title", "source": "meta"}]}}, PHASES)
    voc = vocabulary.load(spark.createDataFrame([("Plant", "oil", "thymol (THY)")], "c string, s string, n string"), "n", "c", "s")
    how = Settings(passes=2, cache=str(tmp_path / "cache"), class_nodes=True, merge_names=True, create_missing="Indicator")
    make = lambda: Twice({"Alternative": ["thymol"], "Indicator": ["ADG"]}, asked)
    res = run(articles(spark).where("document_id = '1'"), reg, make, how, {"Alternative": voc})
    first = {(r["cls"], r["name"].lower(), r["n_rows"]) for r in res.mentions.collect()}
    # the second pass says the same again at the same places, which the first pass holds
    assert {x[:2] for x in first} == {("Alternative", "thymol"), ("Indicator", "adg"), ("Literature", "t")}
    labels = {r["label"] for r in res.nodes.collect()}
    assert labels == {"Alternative", "Indicator", "Alternative_Class", "Literature"} and {r["type"] for r in res.edges.collect()} == {"belongs_to"}
    n = len(list(asked.iterdir()))
    assert n == 4  # two phases, one prompt each, two passes
    again = run(articles(spark).where("document_id = '1'"), reg, make, how, {"Alternative": voc})
    assert {(r["cls"], r["name"].lower(), r["n_rows"]) for r in again.mentions.collect()} == first and len(list(asked.iterdir())) == n
