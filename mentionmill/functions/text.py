"""Text functions as Column expressions; everything here stays in the JVM and inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the hyphens, dashes and minus signs that count as one sign.
DASHES = "-‐‑‒–—―−⁃"


def casefold(c: Column) -> Column:
    """Lower case with the letters folded that lower case leaves apart: sharp s, final sigma, micro sign, dotted capital I."""
    return F.regexp_replace(F.translate(F.lower(c), "ςµİ", "σμi"), "ß", "ss")


def dash_normalize(c: Column) -> Column:
    """One sign for all dashes, without blanks around it."""
    return F.regexp_replace(F.translate(c, DASHES, "-" * len(DASHES)), r"(?U)\s*-\s*", "-")


def hyphen_space_fold(c: Column) -> Column:
    """Case folded, hyphens as blanks."""
    return F.translate(casefold(c), "-", " ")


def no_separators(c: Column) -> Column:
    """Case folded, without hyphens and blanks."""
    return F.translate(casefold(c), "- ", "")


def entity_text(label: Column, text: Column) -> Column:
    """Gene mentions with normalized dashes, others as they are."""
    return F.when(label == "GENETIC", dash_normalize(text)).otherwise(text)


def squeeze(c: Column) -> Column:
    """Blanks of any kind and number as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def one_line(c: Column) -> Column:
    """Tabs and line ends as blanks."""
    return F.trim(F.translate(c, "\t\r\n", "   "))


def accession(c: Column) -> Column:
    """The article id: what stands before the first dot."""
    return F.substring_index(c, ".", 1)


def without_scheme(c: Column) -> Column:
    """A file name without the ending of its scheme."""
    return F.regexp_replace(c, r"(\.grobid\.tei)?(\.xml)?$", "")


def section_type(c: Column) -> Column:
    """Section names in lower case with parts around and, &, /, +, | or a comma sorted and joined by a bar; null gives an empty text."""
    flat = F.translate(F.lower(F.trim(c)), "-_", "  ")
    parts = F.split(F.regexp_replace(flat, r"\s*(?:\band\b|&|/|\+|\||,)\s*", "|"), r"\|")
    clean = F.filter(F.transform(parts, lambda p: F.trim(F.regexp_replace(p, r"\s+", " "))), lambda p: p != "")
    return F.coalesce(F.array_join(F.array_sort(clean), "|"), F.lit(""))


def title_key(c: Column) -> Column:
    """A heading for comparison: lower case, no blanks or stops at the ends."""
    return F.regexp_replace(F.lower(c), r"^[ .:;-]+|[ .:;-]+$", "")


def heading(c: Column) -> Column:
    """A heading without inner tags, entities, leading numbers and surplus blanks."""
    x = squeeze(unescaped(F.regexp_replace(c, r"<[^>]+>", " ")))
    return F.trim(F.regexp_replace(x, r"^(?:\d+(?:\.\d+)*\.?|[IVXLC]+\.)\s+", ""))


def unescaped(c: Column) -> Column:
    """The five named entities of XML and the common numeric ones."""
    # fixed values
    for name, sign in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("nbsp", " "), ("#160", " "), ("#39", "'"), ("amp", "&")):
        c = F.regexp_replace(c, f"&{name};", sign)
    return c


def curie(iri: Column) -> Column:
    """prefix:number from the last part of an address."""
    return F.translate(F.substring_index(F.substring_index(iri, "/", -1), "#", -1), "_", ":")


def first_year(*dates: Column) -> Column:
    """The first four-digit word of the first date that has one, as a number."""
    return F.coalesce(*[F.nullif(F.regexp_extract(d, r"\b(\d{4})\b", 1), F.lit("")).try_cast("int") for d in dates])


def alpha_ratio(c: Column) -> Column:
    """Letters per visible character; 0 for none."""
    return F.coalesce(F.try_divide(F.regexp_count(c, F.lit(r"\p{L}")), F.regexp_count(c, F.lit(r"(?U)\S"))), F.lit(0.0))


# British spellings and their American form, in order.
BRITISH = (
    ("tumour", "tumor"), ("oesophag", "esophag"), ("oedema", "edema"), ("haemorrh", "hemorrh"), ("haemat", "hemat"), ("haemangi", "hemangi"), ("haem", "hem"),
    ("anaemi", "anemi"), ("leukaemi", "leukemi"), ("ischaemi", "ischemi"), ("paediatr", "pediatr"), ("coeliac", "celiac"), ("oestrogen", "estrogen"), ("caemia", "cemia"), ("aemia", "emia"),
)


def american(c: Column) -> Column:
    for a, b in BRITISH:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


# Plurals that follow no ending.
IRREGULAR = {"metastases": "metastasis", "foci": "focus", "carcinomata": "carcinoma", "adenomata": "adenoma", "lymphomata": "lymphoma", "sarcomata": "sarcoma", "neoplasiae": "neoplasia"}


def singulars(c: Column) -> Column:
    """Forms that a plural in lower case may have as singular, likeliest first."""
    n = F.length(c)
    listed = F.try_element_at(F.create_map(*[F.lit(v) for kv in IRREGULAR.items() for v in kv]), c)
    cut = lambda k: F.substring(c, F.lit(1), n - k)
    return F.array_compact(F.array(listed, F.when(c.endswith("ies") & (n > 4), F.concat(cut(3), F.lit("y"))), F.when(c.endswith("es") & (n > 4), cut(2)), F.when(c.endswith("s") & ~c.endswith("ss") & (n > 3), cut(1))))


GREEK_NAMES = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()
_GREEK_LETTERS = dict(zip("αβγδεζηθικλμνξοπρστυφχψω", GREEK_NAMES, strict=True))


def greek_spelled(c: Column) -> Column:
    """Greek letters as their English names, capitals and final sigma too; lower case."""
    x = F.translate(F.lower(c), "ς", "σ")
    for letter, name in _GREEK_LETTERS.items():
        x = F.replace(x, F.lit(letter), F.lit(name))
    return x


def greek_words(c: Column) -> Column:
    """Greek letters as their English names, the rest as it is."""
    x = F.translate(c, "ς", "σ")
    for letter, name in _GREEK_LETTERS.items():
        x = F.replace(F.replace(x, F.lit(letter), F.lit(name)), F.lit(letter.upper()), F.lit(name))
    return x


def is_greek(c: Column) -> Column:
    """Holds a Greek letter, or a letter's name that is not in capitals and, for short names that mean other things, in lower case."""
    words = F.regexp_extract_all(c, F.lit(r"(?i)\b(" + "|".join(GREEK_NAMES) + r")\b"), F.lit(1))
    short = ["mu", "nu", "xi", "pi", "psi", "eta", "phi", "chi"]
    named = F.exists(words, lambda w: (w != F.upper(w)) & (~F.lower(w).isin(*short) | (w == F.lower(w))))
    return c.rlike(r"[Ͱ-Ͽἀ-῿]") | named


def md5_prefix(c: Column, n: int = 8) -> Column:
    return F.left(F.md5(c), F.lit(n))


def pair_id(article: Column, sentence: Column, a: Column, b: Column) -> Column:
    """article : digest of the sentence : first span : second span."""
    span = lambda e: F.concat_ws("-", e["start"], e["end"])
    return F.concat_ws(":", article, md5_prefix(sentence), span(a), span(b))


def between(text: Column, start: Column, end: Column) -> Column:
    """text[start:end] by code points, empty where end is not behind start."""
    return F.substring(text, start + 1, F.greatest(end - start, F.lit(0)))


def blinded(text: Column, a: Column, b: Column, marker) -> Column:
    """The text with two spans, a before b, as type markers; ``marker`` maps a label column to the marker's name."""
    mark = lambda e: F.concat(F.lit("@"), marker(e["label"]), F.lit("$"))
    return F.concat(between(text, F.lit(0), a["start"]), mark(a), between(text, a["end"], b["start"]), mark(b), F.substring(text, b["end"] + 1, F.length(text)))


def preview(c: Column, n: int = 300) -> Column:
    return F.left(c, F.lit(n))


def symbols(ids: Column) -> Column:
    """Distinct ids of an array whose texts may join several by a bar, in order of appearance."""
    x = F.flatten(F.transform(F.coalesce(ids, F.array().cast("array<string>")), lambda v: F.split(v, r"\|")))
    return F.array_distinct(F.filter(F.transform(x, lambda v: F.trim(v)), lambda v: v != ""))


def single(ids: Column) -> Column:
    """The id of an array that holds just one, without blanks at the ends; null for none or several."""
    return F.when(F.size(ids) == 1, F.nullif(F.trim(F.get(ids, F.lit(0))), F.lit("")))
