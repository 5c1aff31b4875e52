"""Names, ids, values."""

from pyspark.sql import functions as F

from kgspark.functions import casing as C
from kgspark.functions import names as N
from kgspark.functions import values as V


def one(spark, expr, *values):
    schema = ", ".join(f"c{i} string" for i in range(len(values)))
    return spark.createDataFrame([values], schema).select(expr(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first()["x"]


def test_forms(spark):
    assert one(spark, N.graph_name, "  Microbe-Derived_Antioxidants  ") == "microbe derived antioxidants"
    assert one(spark, N.coref_name, "Control_Group") == "control group"
    assert one(spark, N.coref_name, "  thymol  500  ") == "thymol 500"
    assert one(spark, N.coref_name, "Microbe-derived_Antioxidants (MA)") == "microbe derived antioxidants"
    assert one(spark, N.coref_name, None) == "" == one(spark, N.coref_name, "")
    assert one(spark, N.graph_name, " café ") == "café"


def test_ids(spark):
    gid = lambda cls, glob: lambda n, d: N.global_id(F.lit(cls), n, d, glob)
    a = one(spark, gid("Alternative", ["Alternative"]), "Thymol", "1")
    assert a == one(spark, gid("Alternative", ["Alternative"]), "  thymol  ", "2") and a.startswith("alte_") and len(a) == 17
    assert one(spark, gid("Result", []), "x", "12345") != one(spark, gid("Result", []), "x", "67890")
    assert one(spark, gid("Newtype", []), "x", None).startswith("newt_")


def test_tests_of_pairs(spark):
    assert one(spark, N.abbreviates, "ADG", "Average Daily Gain")
    assert not one(spark, N.abbreviates, "adg", "Average Daily Gain")
    assert not one(spark, N.abbreviates, "XYZ", "Average Daily Gain")
    assert one(spark, lambda a, b: N.fuzzy_equal(a, b, 1), "thymol", "thymoll")
    assert not one(spark, lambda a, b: N.fuzzy_equal(a, b, 1), "", "")
    assert one(spark, N.contained, "blautia hominis", "blautia hominis lyh1") and not one(spark, N.contained, "thymol", "thymol extract mix")


def test_values(spark):
    for raw, want in (("0.045", 0.045), ("p = 0.045", 0.045), ("P < 0.001", 0.001), ("0.04*", 0.04), ("> 0.05", 0.05), ("P=0.03", 0.03), ("0.04 (adjusted)", 0.04), ("none", None), (None, None), ("1d", 1.0)):
        assert one(spark, V.p_value, raw) == want
    assert one(spark, V.clean_evidence, "bited a fermented taste and was well accepted") == "a fermented taste and was well accepted"
    assert one(spark, V.clean_evidence, "the pigs grew") == "the pigs grew"
    assert one(spark, V.clean_text, " [ thymol ()  oil ] ") == "thymol oil" or one(spark, V.clean_text, " [ thymol ()  oil ] ") == " thymol oil "
    assert one(spark, V.table_reference, "as shown in Table 3 and Fig. 2") == "Table 3"
    assert one(spark, V.conclusion, "We fed pigs. In conclusion, it works. Funding was public.") == "In conclusion, it works."
    assert one(spark, V.nfc, "é") == "é"
    assert one(spark, lambda c: V.mapped(c, V.DIRECTIONS), " Elevated ") == "increased"


def test_normal_forms_are_idempotent(spark):
    rows = [("A-b_ c",), ("  x (y) z ",), ("Thymol",), ("",), (None,)]
    df = spark.createDataFrame(rows, "c string")
    for f in (N.graph_name, N.coref_name, N.dedup_name, N.vocab_name, N.relation_name):
        assert df.where(~f(f(F.col("c"))).eqNullSafe(f(F.col("c")))).count() == 0


def test_case(spark):
    for raw, rule, want in (
        ("TLR4", "preserve", "TLR4"), ("p38", "preserve", "p38"), ("25(OH)D3", "preserve", "25(OH)D3"), ("adg", "preserve", "adg"), ("Butyric Acid", "lowercase", "butyric acid"), ("aspartic acid", "title", "Aspartic Acid"),
        ("Xylanase", "lowercase", "xylanase"), ("B. hominis", "preserve", "B. hominis"), ("Interleukin 6", "lowercase", "interleukin 6"), ("Zinc Oxide", "lowercase", "zinc oxide"), ("ZINC", "preserve", "ZINC"), ("zinc", "title", "Zinc"),
        ("vitamin e", "vitamin", "Vitamin E"), ("beta-carotene", "vitamin", "β-carotene"), ("bacillus Subtilis", "binomial", "Bacillus subtilis"), ("extract of green tea", "title", "Extract of Green Tea"), ("Green Tea Extract", "preserve", "Green Tea Extract"),
    ):
        assert (one(spark, C.case_rule, raw), one(spark, C.apply_case, raw)) == (rule, want), raw


def test_quality(spark):
    assert one(spark, N.name_quality, "thymol") == 100 and one(spark, N.name_quality, "") == 0
    assert one(spark, N.name_quality, "12") == 40
