"""Alignment tiers, evidence, overlaps."""

from kgspark.operators import align as A

D = (
    "Pigs were fed a basal diet supplemented with 500 mg/kg thymol (THY, purity >= 99%) for 28 days. Average Daily Gain (ADG) was measured weekly. "
    "Compared with the basal diet control group, thymol significantly increased ADG in the jejunal mucosa (P < 0.05, Table 3)."
)


def hit(mention, doc=D):
    h = A.align_one(mention, A.Text(doc))
    return (doc[h[0] : h[1]], h[2]) if h else None


def test_exact():
    assert hit("thymol") == ("thymol", "match_exact")
    assert hit("average daily gain") == ("Average Daily Gain", "match_exact")


def test_white_space_and_signs():
    for m in ("P<0.05", "P< 0.05", "P <0.05"):
        assert hit(m)[0] == "P < 0.05"
    assert hit("P less than 0.05")[0] == "P < 0.05"
    assert hit("P = 0.023", "It was significant (P=0.023) then.")[0] == "P=0.023"
    assert "0.023" in hit("P=0.023", "It was significant (P = 0.023) compared to control.")[0]


def test_word_edges_hold_in_all_exact_tiers():
    d = "The product contains isoflavones, flavone, and glutathione."
    assert A.align_one("flavone", A.Text(d))[0] == d.index(" flavone") + 1
    assert hit("flavone", "It contains isoflavones only.") is None
    assert hit("ma", "The antioxidants were found to improve inflammatory responses.") is None


def test_brackets():
    got = hit("thymol (THY)")[0].lower()
    assert "thymol" in got and "thy" in got
    d = "Feed (A, old) and thymol (THY, pure) were mixed."
    assert hit("thymol (THY)", d)[0].startswith("thymol (THY")


def test_nothing():
    assert hit("Duroc × Landrace × Yorkshire") is None
    assert hit("") is None and hit("x", "") is None


def test_approximate():
    assert hit("basal diet of the control group")[1] == "match_fuzzy"
    assert hit("mucosa jejunal tissue")[1] == "match_fuzzy"


def test_location_lies_in_evidence():
    for m in ("thymol", "ADG", "P<0.05", "28 days"):
        b, e, _ = A.align_one(m, A.Text(D))
        ev, loc = A.evidence_of(D, b, e)
        assert loc in ev and ev in D and len(loc) < 300


def test_lcs_and_blocks():
    src = "the mean daily gain of all pigs rose".split()
    assert A.lcs_align(src, "mean gain of pigs".split()) == (1, 7)
    assert A.lcs_align(src, "none of these here".split()) is None
    assert A.block_align(src, "daily gain".split()) == (2, 4, "match_exact")
    assert A.block_align(src, "daily gain fell".split()) == (2, 4, "match_lesser")


def test_passes(spark):
    f = lambda rows: spark.createDataFrame(rows, "d string, i int, s int, e int")
    out = A.merge_passes([f([("a", 1, 0, 6), ("a", 2, 15, 25)]), f([("a", 3, 0, 6), ("a", 4, 50, 58), ("a", 5, 10, 20), ("a", 6, None, None), ("b", 7, 0, 6)])], "d", "i", "s", "e")
    assert sorted(r["i"] for r in out.collect()) == [1, 2, 4, 6, 7]


def test_frame(spark):
    m = spark.createDataFrame([(1, "d", "thymol"), (2, "d", None), (3, "x", "thymol"), (4, None, "thymol")], "id long, doc string, m string")
    docs = spark.createDataFrame([("d", D)], "doc string, t string")
    got = {r["id"]: (r["start_pos"], r["alignment_status"]) for r in A.align(m, docs, document="doc", mention="m", text="t", keep=["id"]).collect()}
    assert got[1] == (D.index("thymol"), "match_exact") and got[2] == got[3] == (None, None)


def test_cluster_after_many_single_occurrences():
    far = "z " * 60
    text = ("alpha " + far) * 7 + ("gamma " + far) * 7 + "gamma and alpha"
    b, e, _ = A._by_words("alpha gamma", A.Text(text))
    assert text[b:e] in ("gamma and alpha", "alpha") and b >= text.rindex("gamma")
