"""Trie and automaton against brute force; what a careful reader takes values for."""

import random

import pytest

from kgspark.llm import lists
from kgspark.llm.canonical import UNMATCHED, Matcher, Trie, key_of, map_to_canonical


def distance(a, b):
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
            if i > 2 and j > 1 and a[i - 1] == b[j - 2] and a[i - 3] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 3][j - 2] + 2)
            if i > 1 and j > 2 and a[i - 1] == b[j - 3] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 3] + 2)
    return d[-1][-1]


def test_automaton_finds_all_within():
    random.seed(1)
    word = lambda lo, hi: "".join(random.choice("abc") for _ in range(random.randint(lo, hi)))
    for _ in range(60):
        names = [word(1, 9) for _ in range(15)]
        t = Trie((n, n) for n in names)
        for _ in range(10):
            k = word(0, 9)
            for most in (0, 1, 2, 3):
                assert {e: d for e, (d, _) in t.within(k, most).items()} == {n: distance(n, k) for n in names if distance(n, k) <= most}


@pytest.fixture(scope="module")
def frames(spark):
    canon = spark.createDataFrame(
        [
            ("direction", "increased", ["up", "higher", "elevated", "rise", "↑"]), ("direction", "decreased", ["down", "lower", "reduced", "decline", "↓"]),
            ("direction", "no_significant_change", ["NS", "unchanged", "no difference", "not significant", "no effect"]),
            ("relation_type", "upregulates", ["induces expression"]), ("relation_type", "downregulates", ["represses expression"]), ("relation_type", "increases", ["raises"]), ("relation_type", "enriches", None),
        ],
        "field_name string, entry string, known_as array<string>",
    )
    voc = spark.createDataFrame([("P", "thymoquinolin (TSP), copper sulfate , Lactovorax reuterans (LRX),, zinc oxide"), ("Q", None)], "alternative_class string, names string")
    return canon, voc


def test_values(frames):
    m, _ = lists.value_matchers(frames[0])
    d = m["direction"].match
    for v, e in {
        "increeased": "increased", "↑↑": "increased", "significantly increased (P<0.05)": "increased", "elevated vs. NC": "increased", "incr.": "increased", "UP ": "increased",
        "markedly decreased": "decreased", "was decreased": "decreased", "reduction": "decreased", "lower than control": "decreased", "Decreasde": "decreased",
        "n.s.": "no_significant_change", "no significant increase": "no_significant_change", "no_significat_chagne": "no_significant_change", "did not change": "no_significant_change",
        "not significantly lower": "no_significant_change", "NO sig. difference vs. NC": "no_significant_change", "increased, then decreased": UNMATCHED, "see Table": UNMATCHED, "never lower": "no_significant_change",
        "mixed": UNMATCHED, "N/A": UNMATCHED, "see Table 4": UNMATCHED, "17.2": UNMATCHED, "U-shaped": UNMATCHED, "-": UNMATCHED,
    }.items():
        assert d(v) == e, v
    r = m["relation_type"].match
    assert r("up-reg.") == r("up_regulates") == r("upregulates mRNA of") == "upregulates" and r("down regulates") == "downregulates" and r("enriches genus") == "enriches" and r("correlates with") == UNMATCHED


def test_names(frames):
    m, listed = lists.vocabulary_matcher(frames[1])
    assert listed == ["thymoquinolin", "copper sulfate", "Lactovorax reuterans", "zinc oxide"]
    for v, e in {
        "TSP (thymoquinolin)": "thymoquinolin", "tsp": "thymoquinolin", "coated thymoqiunolin powder": "thymoquinolin", "sulfate, copper": "copper sulfate", "0.2% copper-sulfate": "copper sulfate",
        "L. reuterans": "Lactovorax reuterans", "LACTOVORAX REUTERANS, feed grade": "Lactovorax reuterans", "zinc oxide 500 mg/kg": "zinc oxide", "zinc oxide (bin lot 4)": "zinc oxide",
        "thymolin": UNMATCHED, "the supplement": UNMATCHED, "TSX": UNMATCHED, "": UNMATCHED, "x" * 5000: UNMATCHED,
    }.items():
        assert m.match(v) == e, v


def test_long_names_and_values(spark):
    """Names of thousands of letters, sent to the workers; a value of thousands of words is searched whole."""
    long = "ab" * 4000
    m = Matcher([(long, "long"), ("zinc oxide", "zinc")])
    assert m.match(long[:-3] + "x" + long[-2:]) == "long" and m.match("word " * 3000 + "zinc oxide") == "zinc"
    df = spark.createDataFrame([(1, "f", long + "b"), (2, "f", "Zinc-oxide"), (3, "g", "zinc oxide")], "i long, f string, v string")
    out = map_to_canonical(df, record="i", field="f", value="v", matchers={"f": m}, entries={"f": ["zinc oxide"]})
    assert sorted((r["record_id"], r["entry"]) for r in out.collect()) == [(1, "long"), (2, "zinc")]


def test_reference_list_beyond_the_bound_is_refused(spark, monkeypatch):
    canon = spark.createDataFrame([("f", "e", ["x"])] * 4 + [("f", None, None)], "field_name string, entry string, known_as array<string>")
    assert lists.value_matchers(canon)[1] == {"f": ["e"]}
    monkeypatch.setattr(lists, "MAX_NAMES", 4)
    with pytest.raises(ValueError, match="more than"):
        lists.value_matchers(canon)


def test_hot_spellings(spark, frames):
    m, entries = lists.value_matchers(frames[0])
    df = spark.createDataFrame([(i, "direction", "UP" if i % 3 else f"decreasd{i}") for i in range(90)], "i long, f string, v string")
    a, b = (map_to_canonical(df, record="i", field="f", value="v", matchers=m, entries=entries, hot_rows=n) for n in (5, 10**9))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_ambiguous():
    m = Matcher([("alphaxin", "a"), ("alphaxon", "b"), ("same", "c"), ("same", "d")])
    assert m.match("alphaxan") == UNMATCHED and m.match("same") == UNMATCHED
    assert key_of("A-b_c d") == "abcd"


def test_frame(spark, frames):
    m, entries = lists.value_matchers(frames[0])
    rows = [(1, "direction", "up"), (1, "direction", "up"), (2, "direction", "increased"), (3, "direction", None), (4, "direction", "  "), (5, "direction", "odd"), (None, "direction", "up"), (1, "relation_type", "raises"), (6, "direction", "Increased")]
    df = spark.createDataFrame(rows, "entry long, field_name string, v string")
    out = map_to_canonical(df, record="entry", field="field_name", value="v", matchers=m, entries=entries)
    assert sorted(tuple(r) for r in out.collect()) == [("direction", 1, "increased"), ("direction", 5, "UNMATCHED"), ("direction", 6, "increased"), ("relation_type", 1, "increases")]
    assert map_to_canonical(df.limit(0), record="entry", field="field_name", value="v", matchers=m, entries=entries).count() == 0
