"""Vocabulary, lookups, deduplication, graph, coreference, validation, gates, extraction."""

import json

import pytest
from pyspark.sql import functions as F

from kgspark.operators import coref, dedup, extract, gate, graph, lookup, validate, vocabulary
from kgspark.registry import Registry
from kgspark.sources import sinks


def test_vocabulary_cascade(spark):
    rows = spark.createDataFrame([("Plant", "oils", "thymol (THY), carvacrol,\nn"), ("Acid", "short", "butyric acid, x")], "c string, s string, names string")
    v = vocabulary.load(rows, "names", "c", "s")
    assert sorted(r["key"] for r in v.collect()) == ["butyric acid", "carvacrol", "n", "thymol", "x"]
    names = spark.createDataFrame([("Thymol",), ("thymol!",), ("thymol oil blend",), ("carvacroll",), ("zinc, butyric acid",), ("unrelated",), (None,), (" ",)], "name string")
    got = {r["name"]: (r["tier"], r["key"], r["match_source"], r["entry_class"]) for r in vocabulary.cascade(names, "name", v).collect()}
    assert got["Thymol"] == (1, "thymol", "exact", "Plant")
    assert got["thymol!"][0] == 2 and got["thymol oil blend"][0] == 3
    assert got["carvacroll"][:2] == (3, "carvacrol")
    assert got["unrelated"] == (None, None, "unmatched", "Other")
    assert got["zinc, butyric acid"][1] == "butyric acid" and len(got) == 6


def test_lookup_tiers(spark):
    refs = spark.createDataFrame([(1, "d", "ADG"), (2, "d", "average-daily gain"), (3, "d", "daily gain"), (4, "d", "gain in daily average"), (5, "e", "ADG"), (6, "d", None)], "id long, doc string, r string")
    ents = spark.createDataFrame([(10, "d", "Average Daily Gain"), (11, "d", None)], "k long, doc string, n string")
    got = {r["id"]: (r["k"], r["tier"]) for r in lookup.find(refs, ents, scope=["doc"], ref_id="id", ref="r", ident="k", name="n").collect()}
    assert got[1] == (10, 5) and got[3] == (10, 3) and got[4] == (10, 4) and 5 not in got and 6 not in got


def test_missing_and_answered(spark):
    refs = spark.createDataFrame([("d", 2, "BW "), ("d", 1, "bw"), ("d", 3, "ADG")], "doc string, o long, r string")
    ents = spark.createDataFrame([("d", "adg", "x"), ("d", "zz", None)], "doc string, a string, b string")
    assert [tuple(r) for r in lookup.missing_targets(refs, ents, ["doc"], "r", ["a", "b"], "o").collect()] == [("d", "bw", "bw")]
    assert [r["a"] for r in lookup.answered(ents, refs, ["doc"], ["a", "b"], "r").collect()] == ["adg"]


def test_merge_groups(spark):
    df = spark.createDataFrame([("k", 1, "ab", "one two", {"x": "1", "y": ""}), ("k", 2, "abc", "one", {"x": "22", "y": "b"}), ("k", 3, "abd", "three", None)], "k string, o long, t string, e string, a map<string,string>")
    r = dedup.merge_groups(df, ["k"], order="o", text="t", evidence="e", attributes="a", separator=" <|> ").first()
    assert (r["o"], r["t"], r["n_rows"], r["e"], r["a"]) == (1, "abc", 3, "one two <|> three", {"x": "22", "y": "b"})
    r = dedup.merge_groups(df, ["k"], order="o", text="t", attributes="a", rule="first").first()
    assert r["a"] == {"x": "1", "y": "b"}


def test_graph(spark):
    m = spark.createDataFrame([("111", "Alternative", "thymol", {"abbreviation": "THY"}, 1), ("222", "Alternative", "Thymol ", {"cas": "89-83-8"}, 2), ("222", "Alternative", " ", {}, 3)], "d string, c string, n string, a map<string,string>, o long")
    r = graph.nodes(m, document="d", cls="c", name="n", attributes="a", order="o", global_types=["Alternative"]).collect()
    assert len(r) == 1 and r[0]["properties"] == {"abbreviation": "THY", "cas": "89-83-8"} and r[0]["source_pmids"] == ["111", "222"] and r[0]["name"] == "thymol"
    assert sinks.property_names(graph.nodes(m, document="d", cls="c", name="n", attributes="a", order="o", global_types=["Alternative"])) == ["abbreviation", "cas"]


@pytest.mark.parametrize(
    "rows,want",
    [
        ([("1", "microbe-derived antioxidants", "MA"), ("2", "MA", None)], {"2": "1"}),
        ([("1", "aa", "bb"), ("2", "bb", "aa")], {"2": "1"}),
        ([("1", "aa", "bb"), ("2", "bb", "cc"), ("3", "cc", None)], {"2": "1", "3": "1"}),
        ([("3", "aa", "bb"), ("2", "bb", "cc"), ("1", "cc", "aa")], {"2": "1", "3": "1"}),
        ([("1", "aa", None)], {}),
    ],
)
def test_merge_map(spark, rows, want):
    n = spark.createDataFrame([(i, "A", n, a, None) for i, n, a in rows], "id string, l string, n string, a string, f string")
    assert {r["id"]: r["into"] for r in graph.merge_map(n, ident="id", label="l", name="n", abbreviation="a", full="f").collect()} == want


def test_remap(spark):
    e = spark.createDataFrame([("a", "b", "t"), ("c", "b", "t"), ("a", "c", "t")], "source_id string, target_id string, type string")
    m = spark.createDataFrame([("c", "a")], "id string, into string")
    assert [tuple(r) for r in graph.remap(e, m).collect()] == [("a", "b", "t")]


def test_cascade_is_the_same_by_loop_and_by_joins(spark, monkeypatch):
    import random

    random.seed(11)
    word = lambda: "".join(random.choice("abcd") for _ in range(random.randint(1, 9)))
    v = spark.createDataFrame([(f"C{i % 3}", "s", f"{word()} {word()}, {word()} (x), {word()}") for i in range(12)], "c string, s string, n string")
    names = spark.createDataFrame([(f"{word()}{random.choice([' ', '-', ', '])}{word()}",) for _ in range(150)] + [(None,), (" ",), ("ab",)], "name string")
    voc = vocabulary.load(v, "n", "c", "s")
    out = []
    for keys, loop in ((10**5, 1000), (10**5, 0), (0, 0)):
        monkeypatch.setattr(vocabulary, "MAX_KEYS", keys)
        monkeypatch.setattr(vocabulary, "LOOP_KEYS", loop)
        out.append(sorted(str(r) for r in vocabulary.cascade(names, "name", voc).collect()))
    assert out[0] == out[1] == out[2] and any("tier=5" in r for r in out[0]) and any("tier=3" in r for r in out[0])


def test_constrained(spark):
    r = spark.createDataFrame([("A", "X"), ("A", "y"), ("B", "q"), ("A", None)], "c string, k string")
    ok = spark.createDataFrame([("A", " x"), ("A", "x")], "c string, k string")
    assert sorted(map(tuple, lookup.constrained(r, ok, "c", "k").collect())) == [("A", "X"), ("B", "q")]


def test_merged_nodes_fill_gaps(spark):
    n = spark.createDataFrame([("1", "A", "aa", {"x": "1", "y": " "}, ["d"]), ("2", "A", "bb", {"x": "2", "y": "3"}, ["e", "d"]), ("3", "A", "cc", {"y": "4", "z": "5"}, None), ("4", "B", "q", None, None)], "id string, label string, name string, properties map<string,string>, source_pmids array<string>")
    m = spark.createDataFrame([("2", "1"), ("3", "1")], "id string, into string")
    got = {r["id"]: (r["name"], r["properties"], r["source_pmids"]) for r in graph.merge_nodes(n, m).collect()}
    assert got == {"1": ("aa", {"x": "1", "y": "3", "z": "5"}, ["d", "e"]), "4": ("q", None, None)}
    assert {r["id"] for r in graph.merge_nodes(n, m.limit(0)).collect()} == set("1234")


def by_rereading(rows):
    """Groups of (order, text) by comparing whole groups again after each merge, from the rules alone."""
    import re

    def edits(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(d[j] + 1, new[-1] + 1, d[j - 1] + (x != y)))
            d = new
        return d[-1]

    def stands(s, f):
        if not (1 <= len(s) <= 5 < len(f) and (s.isupper() or s.istitle())):
            return False
        words = f.split()
        letters = iter(w[0].upper() for w in words)
        ordered = len(words) >= len(s) and all(c in letters for c in s.upper())
        return s.lower() in f.lower() or ordered or (len(words) >= len(s) and "".join(w[0] for w in words).upper().startswith(s.upper()))

    key = lambda t: re.sub(r"\s+", " ", re.sub(r"[-_/.,;:]", " ", t.lower())).strip()
    groups = {}  # key -> (texts, keys)
    for _, t in sorted(rows):
        k = key(t)
        at = k if any(k in ks for _, ks in groups.values()) else next((g for g in groups if edits(g, k) <= 1), k)
        at = next((g for g, (_, ks) in groups.items() if k in ks), at)
        texts, ks = groups.setdefault(at, ([], set()))
        texts.append(t)
        ks.add(k)
    heads = list(groups)
    for i, g in enumerate(heads):
        for h in heads[i + 1 :]:
            if g not in groups:
                break
            if h not in groups:
                continue
            a, b = sorted((g, h), key=len)
            if (a in b and len(a) / len(b) >= 0.6) or any(stands(x, y) or stands(y, x) for x in groups[g][0] for y in groups[h][0]):
                keep, lose = (g, h) if len(g) >= len(h) else (h, g)
                texts, ks = groups.pop(lose)
                groups[keep][0].extend(texts)
                groups[keep][1].update(ks)
    return {i: g for i, t in rows for g, (_, ks) in groups.items() if key(t) in ks}


def test_coreference(spark):
    df = spark.createDataFrame([(1, "d", "Thymol", "THY"), (2, "d", "thymol ", None), (3, "d", "THY", None), (4, "d", "curcumin", None), (5, "d", None, None), (6, "e", "THY", None)], "i long, d string, t string, a string")
    out = coref.resolve(df, ["d"], order="i", text="t", aliases=coref.alias_map(df, ["d"], "t", "a"))
    got = {r["i"]: r["group_key"] for r in out.collect()}
    assert got[1] == got[2] == got[3] == "thymol" and got[4] == "curcumin" and got[5] is None and got[6] == "thy"
    assert coref.resolve(df.limit(0), ["d"], order="i", text="t").count() == 0
    exact = coref.resolve(spark.createDataFrame([(1, "d", "thymol"), (2, "d", "thymoll")], "i long, d string, t string"), ["d"], order="i", text="t", fuzzy=False)
    assert {r["group_key"] for r in exact.collect()} == {"thymol", "thymoll"}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_coreference_against_rereading(spark, seed):
    import random

    random.seed(seed)
    words = ["gain", "gains", "daily", "average", "thymol", "thymoll", "feed", "intake", "Bw", "ADG", "FI", "Adg", "Tf"]
    docs = {d: [(i, " ".join(random.sample(words, random.randint(1, 3)))) for i in range(30)] for d in "abcd"}
    df = spark.createDataFrame([(i, d, t) for d, rows in docs.items() for i, t in rows], "i long, d string, t string")
    got = {(r["d"], r["i"]): r["group_key"] for r in coref.resolve(df, ["d"], order="i", text="t").collect()}
    assert got == {(d, i): g for d, rows in docs.items() for i, g in by_rereading(rows).items()}


def test_validation(spark):
    df = spark.createDataFrame([(1, "R", "x", None), (2, "R", "x", "y"), (3, "Q", None, None)], "i long, c string, a string, b string")
    need = {"R": ["a", "b"]}
    cols = {"a": F.col("a"), "b": F.col("b")}
    assert [r["i"] for r in validate.complete(df, "c", cols, need).orderBy("i").collect()] == [2, 3]
    assert [r["i"] for r in validate.complete(df, "c", cols, need, F.col("i") == 1).orderBy("i").collect()] == [1, 2, 3]
    ex = spark.createDataFrame([("d", "A", 1, "Thymol"), ("d", "B", 2, "thymol"), ("d", "A", 3, "zinc")], "d string, c string, o long, n string")
    assert [r["o"] for r in validate.exclusive(ex, ["d"], cls="c", name="n", order="o", priority={"A": 2, "B": 3}).orderBy("o").collect()] == [2, 3]


def test_gate(spark):
    c = lambda t: gate.condition(t, lambda f: F.col(f))
    df = spark.createDataFrame([("a", "Other"), ("b", "Enzyme"), ("c", None)], "d string, k string")
    assert [r["d"] for r in df.where(c("k not in ['Other', '', 'unmatched']")).collect()] == ["b"]
    assert [r["d"] for r in df.where(c("k exists")).orderBy("d").collect()] == ["a", "b"]
    assert c("nonsense here") is None and c("k in [broken") is None
    docs = spark.createDataFrame([("a",), ("b",), ("z",)], "d string")
    passed, failed = gate.split(docs, df, "d", c("k in ['enzyme']"))
    assert passed.count() == 1 and failed.count() == 2
    assert gate.split(docs, df, "d", None)[0].count() == 3


def test_parse_output():
    body = '{"extractions":[{"Alternative":"thymol","Alternative_attributes":{"abbreviation":"THY"},"Alternative_index":2}]}'
    for t in (body, f"```json\n{body}\n```", f"<think>reasoning</think>{body}"):
        assert extract.resolve_items(extract.parse_output(t)) == [("Alternative", "thymol", {"abbreviation": "THY"})]
    assert len(extract.parse_output('[{"Alternative":"thymol"},{"Alternative":"curcumin"}]')) == 2
    assert extract.parse_output('{"extractions":[]}') == []
    assert extract.parse_output("extractions:\n- A: x", fmt="yaml") == [{"A": "x"}]
    for bad in ("", "{invalid json}}}", '{"extractions":["x"]}', "plain"):
        with pytest.raises(ValueError):
            extract.parse_output(bad)
    with pytest.raises(ValueError):
        extract.parse_output(body, strict=True)
    assert extract.resolve_items([{"Result": 42}, {"Result": 3.14}, {"Result": {"a": 1}}]) == [("Result", "42", {}), ("Result", "3.14", {})]


def test_resolve_outputs(spark):
    df = spark.createDataFrame([(1, '{"extractions":[{"A":"x","A_attributes":{"k":"v"}}]}'), (2, "not valid json"), (3, None)], "id long, o string")
    got = {r["id"]: r for r in extract.resolve_outputs(df, ["id"], "o").collect()}
    assert got[1]["extraction_text"] == "x" and got[1]["attributes"] == {"k": "v"} and got[2]["parse_error"] and got[3]["parse_error"]


def test_extractor(spark):
    df = spark.createDataFrame([(i, f"fed thymol {i}") for i in range(5)], "id long, p string")
    out = extract.extract(df, ["id"], "p", lambda: extract.DictionaryExtractor({"Alternative": ["thymol"]}), batch=2)
    assert all(json.loads(r["output"]) == {"extractions": [{"Alternative": "thymol"}]} and r["score"] == 1 for r in out.collect())

    def broken():
        def ask(prompts):
            raise RuntimeError("down")

        return ask

    assert {(r["output"], r["score"]) for r in extract.extract(df, ["id"], "p", broken).collect()} == {("", 0.0)}
    keyed = df.select("id", extract.cache_key(F.lit("m"), F.lit("s"), F.col("p")).alias("key"))
    cache = keyed.where("id < 2").select("key", F.lit("{}").alias("output"))
    hit, miss = extract.with_cache(keyed, cache, "key")
    assert hit.count() == 2 and miss.count() == 3


def test_conjunction(spark):
    df = spark.createDataFrame([("grape seed meal and green tea leaf",), ("a and b",), (None,)], "n string")
    got = [r["x"] for r in df.select(extract.split_conjunction(F.col("n")).alias("x")).collect()]
    assert got[0] == ["grape seed meal and green tea leaf", "grape seed meal", "green tea leaf"] and got[1] == ["a and b"]
    assert df.select(extract.split_conjunction(F.col("n"), ["seed meal"]).alias("x")).first()["x"] == ["grape seed meal and green tea leaf"]


def test_registry():
    reg = Registry.from_mappings(
        {"entities": {
            "A": {"primary_text": "name", "dedup_mode": "fuzzy", "attributes": [{"name": "name", "required": True}, {"name": "kind", "type": "enum", "values": ["x", "y"]}, {"name": "ev", "source": "align"}]},
            "R": {"primary_text": "a", "dedup_mode": "article", "attributes": [{"name": "a"}, {"name": "p", "type": "float"}], "references": [{"name": "a", "target_entity": "A", "target_field": "name", "edge_type": "uses"}]},
        }},
        {"phases": {"one": {"sections": ["methods"], "extracts": ["A"], "gate": {"entity": "A", "condition": "kind exists"}}, "two": {"sections": ["methods", "results"], "extracts": ["A", "R"]}}},
    )
    assert reg.global_types() == ["A"] and reg.required() == {"A": ["name"], "R": []}
    assert [f.dataType.simpleString() for f in reg.spark_schema("R")] == ["string", "double"]
    assert reg.routing() == {"methods": ["A", "R"], "results": ["A", "R"]} or reg.routing()["methods"][0] == "A"
    schema = reg.json_schema()
    assert schema["properties"]["extractions"]["items"]["anyOf"][0]["properties"]["A_attributes"]["properties"]["kind"]["enum"] == ["x", "y"]
    assert reg.reference_columns() == [("R", "a", "A", "name", "uses")] and "name (string, required)" in reg.prompt(["A"])
    assert reg.reference_maps() == ({"R": [("a", "A", "name", "uses")]}, {"A": [("R", "a", "uses")]})
    late = Registry.from_mappings({"A": {"attributes": [{"name": "kind", "type": "enum", "source": "post"}, {"name": "n", "source": "post"}]}})
    assert reg.gate_fields("A", "odd") == ["odd"] and late.gate_fields("A", "odd") == ["kind"] and late.gate_fields("A", "n") == ["n"] and late.gate_fields("B", "x") == ["x"]


@pytest.mark.parametrize("fmt", ["json", "yaml"])
@pytest.mark.parametrize("fenced", [True, False])
def test_rendered_answers_are_read_back(fmt, fenced):
    mentions = [("A", "zinc: ``oxide``", {"kind": "x", "n": "1,5 – 2"}), ("B", "é", {})]
    text = extract.render_answer(mentions, fmt=fmt, fenced=fenced)
    assert extract.resolve_items(extract.parse_output(text, fmt=fmt, strict=fenced)) == mentions


def test_verify_is_the_row_rule(spark):
    rows = spark.createDataFrame(
        [(1, "d", "thymol", "fed thymol"), (2, "d", "Zinc (ZnO)", ""), (3, "d", "corn oil", None), (4, "d", "large white sows", "white sows were large"), (5, "d", "absent", "none"), (6, "e", "thymol", None), (7, None, "thymol", None), (8, "d", None, "x"), (9, "d", " ", "x")],
        "i long, doc string, t string, e string",
    )
    docs = spark.createDataFrame([("d", "ZINC was added to Corn Oil."), ("e", None)], "doc string, body string")
    got = {r["i"]: r["tier"] for r in validate.verify(rows, docs, document="doc", ident="i", text="t", evidence="e", body="body").collect()}
    plain = rows.join(docs, "doc", "left").select("i", validate.evidence_tier(F.col("t"), F.col("e"), F.col("body")).alias("tier"))
    assert got == {r["i"]: r["tier"] for r in plain.collect()} == {1: 1, 2: 3, 3: 2, 4: 4, 5: None, 6: None, 7: None, 8: None, 9: None}
