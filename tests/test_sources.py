"""XML articles, texts, vocabularies, stages, sinks, streams."""

import pytest

from kgspark import streaming
from kgspark.plans.texts import _dictionary
from kgspark.sources import articles, sinks, tables

XML = """<article xmlns="urn:x"><front><journal-meta><journal-title>J</journal-title></journal-meta><article-meta>
<article-id pub-id-type="pmid">123</article-id><article-id pub-id-type="doi">10.1/x</article-id><title-group><article-title>On <i>pigs</i></article-title></title-group>
<pub-date pub-type="collection"><year>2020</year></pub-date><pub-date pub-type="epub"><year>2021</year><month>3</month><day>7</day></pub-date>
<abstract><p>Short.</p></abstract></article-meta></front>
<body><sec><title>Materials and Methods</title><p>We fed.</p><sec><title>Diet</title><p>Corn.</p></sec></sec><sec><title>Results</title><p>Grew.</p></sec></body></article>"""


def test_parse_article():
    a = articles.parse_article("/x/y/file.one.xml", XML.encode())
    assert (a["document_id"], a["doi"], a["title"], a["journal"], a["publication_date"]) == ("123", "10.1/x", "On pigs", "J", "2021-03-07")
    assert [s["section_key"] for s in a["sections"]] == ["methods", "diet", "results"] and "Corn." in a["sections"][0]["section_text"]
    broken = articles.parse_article("/x/y/file.one.xml", b"<a>")
    assert broken["document_id"] == "file.one" and broken["parse_warnings"]


def test_read_articles(spark, tmp_path):
    (tmp_path / "a.xml").write_text(XML)
    (tmp_path / "b.xml").write_text("<broken")
    df = articles.read_articles(spark, str(tmp_path))
    assert {r["document_id"] for r in df.collect()} == {"123", "b"}
    assert {r["document_id"]: r["phase_text"] for r in articles.phase_text(df, "results").collect()}["123"].endswith("Grew.")
    assert articles.to_documents(df).where("document_id = '123'").first()["text"].startswith("Short.")
    with pytest.raises(FileNotFoundError):
        articles.read_articles(spark, str(tmp_path), "*.nxml")


def test_texts_and_tables(spark, tmp_path):
    (tmp_path / "d1.txt").write_text("one\ntwo")
    assert [tuple(r) for r in articles.read_texts(spark, str(tmp_path)).collect()] == [("d1", "one\ntwo")]
    (tmp_path / "v.tsv").write_text('class\tnames\nA\t"x,\ny"\n')
    assert tables.read_vocabulary(spark, str(tmp_path / "v.tsv")).first()["names"] == "x,\ny"
    (tmp_path / "r1.csv").write_text("source_doc,name\nd,NA\n")
    (tmp_path / "r2.csv").write_text("pmid,other\ne,1\n")
    got = tables.read_review(spark, {"A": str(tmp_path / "r1.csv"), "B": str(tmp_path / "r2.csv")}).orderBy("entity_class").collect()
    assert [(r["source_doc"], r["name"], r["other"]) for r in got] == [("d", "NA", None), ("e", None, "1")]
    assert tables.read_stage(spark, str(tmp_path / "none")) is None
    kept = tables.write_stage(spark.range(3), str(tmp_path / "stage"))
    assert kept.count() == 3 == tables.read_stage(spark, str(tmp_path / "stage")).count()
    assert articles.unprocessed(spark.range(3), spark.range(2), "id").count() == 1
    sinks.write_csv(spark.range(2), str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 2


def test_neo4j(spark):
    n = spark.createDataFrame([("a", "A", "x\ny", {"p": "1"}, ["1", "2"])], "id string, label string, name string, properties map<string,string>, source_pmids array<string>")
    out = sinks.neo4j_nodes(n, ["p"])
    assert out.columns[:2] == ["entity_id:ID", "entity_type:LABEL"] and out.first()["source_pmids"] == "1|2"
    e = spark.createDataFrame([("a", "b", "t", "e", ["1"])], "source_id string, target_id string, type string, evidence string, source_pmids array<string>")
    assert sinks.neo4j_edges(e).columns[:3] == [":START_ID", ":END_ID", ":TYPE"]


def test_stream(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id long, k string").write.parquet(str(tmp_path / "in"))
    s = streaming.read_stream(spark, str(tmp_path / "in"), "id long, k string")
    streaming.run_batches(s, lambda df: df.distinct(), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_too_many_dictionary_names_are_refused(spark):
    names = spark.createDataFrame([("b",), ("a",), ("",), (None,), ("a",)], "s string")
    assert _dictionary(names, 2) == ["a", "b"]
    with pytest.raises(ValueError, match="more than 1 names"):
        _dictionary(names, 1)
