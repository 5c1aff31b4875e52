"""Letter case of names by what they name: a chain of conditions that Catalyst compiles into one expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import strip

# Spellings kept as they are (symbols of genes, short codes, numbered forms, names that begin with a Greek letter).
KEPT = (r"^[A-Z][A-Z0-9]{1,7}\d*$", r"^[a-z]{1,3}\d{1,3}[A-Za-z]?$", r"^\d+\([A-Za-z]+\)[A-Za-z0-9]*$", r"^[α-ωΑ-Ω][\w\-].*$")
# Acronyms kept in capitals.
ACRONYMS = (
    "ADG", "ADFI", "FCR", "LPS", "BW", "FBW", "NBW", "IUGR", "ROS", "MDA", "TNF", "IFN", "IGA", "IGG", "IGM", "ALP", "ALT", "AST", "CK", "LDH", "BUN", "TC", "TG", "HDL", "LDL", "VLDL", "NEFA", "SOD",
    "CAT", "GPX", "T-AOC", "GSH", "PCV", "RBC", "WBC", "HB", "CFU", "MIC", "PBS", "PCR", "ELISA", "HPLC", "NMR", "SD", "SE", "SEM", "CI", "OR", "RR", "HR", "DM", "CP", "EE", "CF", "NDF", "ADF", "NSP",
    "VFA", "SCFA", "BCFA", "BA", "PUFA", "MUFA", "SFA", "DHA", "EPA", "ARA", "CLA",
)
# Names in title case by kind.
AMINO_ACIDS = (
    "arginine", "lysine", "methionine", "threonine", "tryptophan", "glutamine", "leucine", "valine", "isoleucine", "glycine", "alanine", "proline", "serine", "cysteine", "tyrosine", "phenylalanine",
    "histidine", "aspartic acid", "glutamic acid", "asparagine", "glutamate", "aspartate", "taurine", "citrulline", "ornithine", "homocysteine", "cystine",
)
MINERALS = (
    "selenium", "chromium", "iron", "zinc", "copper", "calcium", "phosphorus", "magnesium", "potassium", "sodium", "manganese", "iodine", "cobalt", "molybdenum", "sulfur", "boron", "silicon", "vanadium",
    "nickel", "tin",
)
SITES = (
    "liver", "spleen", "kidney", "heart", "lung", "duodenum", "jejunum", "ileum", "colon", "cecum", "stomach", "pancreas", "hypothalamus", "pituitary", "adrenal", "thyroid", "thymus", "serum", "plasma",
    "blood", "feces", "urine", "saliva", "muscle", "adipose", "skin", "brain", "intestine", "rectum", "cerebellum", "cortex", "medulla", "ovary", "testis", "uterus", "mammary", "lymph", "bone", "cartilage",
    "tendon", "ligament", "aorta", "artery", "vein", "capillary",
)
# Names in lower case by kind.
COMPOUNDS = (
    "zinc oxide", "copper sulfate", "zinc sulfate", "ferrous sulfate", "ferric oxide", "calcium carbonate", "calcium phosphate", "magnesium oxide", "magnesium sulfate", "sodium chloride",
    "sodium bicarbonate", "potassium chloride", "potassium iodide", "sodium selenite", "zinc chloride", "zinc acetate", "copper chloride", "copper oxide", "manganese oxide", "manganese sulfate",
    "chromium picolinate", "zinc methionine", "zinc glycinate", "iron oxide", "iron sulfate", "nano zinc oxide", "nano-zno",
)
MEASURES = ("body weight", "average daily gain", "average daily feed intake", "feed conversion ratio", "diarrhea rate", "diarrhea score", "survival rate", "total protein", "crude protein")
SIGNALS = ("interleukin", "interferon", "immunoglobulin", "tumor necrosis factor", "transforming growth factor", "colony stimulating factor", "chemokine")
# Vitamins by other names, and those written with a Greek letter.
VITAMINS = ("alpha-tocopherol", "beta-carotene", "retinol", "retinoic acid", "ascorbic acid", "cholecalciferol", "ergocalciferol", "thiamine", "riboflavin", "niacin", "pyridoxine", "cobalamin", "biotin", "folate", "folic acid", "menadione", "phylloquinone")
GREEK_FORMS = {"alpha-tocopherol": "α-tocopherol", "alpha-tocopheryl": "α-tocopheryl", "beta-carotene": "β-carotene", "gamma-tocopherol": "γ-tocopherol"}
# Words kept small inside a title.
SMALL_WORDS = ("of", "in", "and", "the", "to", "for", "with", "from", "by", "or", "at", "on", "as", "per", "via")


def _words(t: Column) -> Column:
    return F.split(t, r"\s+")


def case_rule(name: Column) -> Column:
    """'preserve', 'lowercase', 'title', 'binomial' or 'vitamin'; the first condition that holds decides."""
    t = strip(name)
    low, n = F.lower(t), F.char_length(t)
    all_low = (t == low) & t.rlike(r"\p{Ll}")
    acid = low.endswith(" acid") & ~low.isin(*AMINO_ACIDS) & ~low.contains("nucleic") & ~low.contains("fatty")
    rule = F.when(t.rlike("|".join(KEPT)), "preserve").when(F.upper(t).isin(*ACRONYMS) & (n <= 6), "preserve")
    rule = rule.when(acid, "lowercase").when((low.endswith("ase") | low.endswith("zyme")) & (n > 5), "lowercase")
    rule = rule.when(t.rlike(r"^[A-Za-z]\. [a-z]"), "preserve").when(low.rlike("^(?:" + "|".join(SIGNALS) + ")"), "lowercase")
    rule = rule.when(low.isin(*MEASURES, *COMPOUNDS), "lowercase").when(low.isin(*AMINO_ACIDS, *MINERALS, *SITES), "title")
    rule = rule.when(low.startswith("vitamin ") | low.isin(*VITAMINS), "vitamin").when(F.size(_words(t)) == 2, "binomial")
    return rule.when(all_low & (t.contains(" ") | (n > 2)), "title").otherwise("preserve")


def _capital(w: Column) -> Column:
    return F.concat(F.upper(F.substring(w, 1, 1)), F.lower(w.substr(F.lit(2), F.char_length(w))))


def title_case(text: Column) -> Column:
    """Words capitalised, small words and capitals of up to three letters inside left as such."""
    def word(w: Column, i: Column) -> Column:
        code = (w == F.upper(w)) & w.rlike(r"\p{Lu}") & (F.char_length(w) <= 3)
        return F.when((i > 0) & F.lower(w).isin(*SMALL_WORDS), F.lower(w)).when((i > 0) & code, w).otherwise(_capital(w))
    return F.array_join(F.transform(_words(strip(text)), word), " ")


def binomial_case(text: Column) -> Column:
    """'Genus species rest'; a single word stays."""
    w = _words(strip(text))
    cased = F.transform(w, lambda x, i: F.when(i == 0, _capital(x)).when(i == 1, F.lower(x)).otherwise(x))
    return F.when(F.size(w) >= 2, F.array_join(cased, " ")).otherwise(strip(text))


def vitamin_case(text: Column) -> Column:
    """'Vitamin E', Greek letters for their names, else title case."""
    low = F.lower(strip(text))
    known = F.create_map(*(F.lit(x) for kv in GREEK_FORMS.items() for x in kv))
    return F.coalesce(known[low], F.when(low.startswith("vitamin "), F.concat(F.lit("Vitamin "), F.upper(strip(low.substr(F.lit(9), F.char_length(low)))))), title_case(text))


def apply_case(name: Column) -> Column:
    """The name in the case of its rule."""
    rule, t = case_rule(name), strip(name)
    return F.when(rule == "lowercase", F.lower(t)).when(rule == "title", title_case(t)).when(rule == "binomial", binomial_case(t)).when(rule == "vitamin", vitamin_case(t)).otherwise(t)
