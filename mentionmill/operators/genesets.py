"""Names of gene sets that a gene list does not have as names: complexes, receptor families, oncogene spellings and histones.

Each becomes names of a field of its own in the index of the gene cascade; the functions here say which of those names a surface
stands for. Genes that the list lacks stand for themselves, with their symbol as id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionmill.functions import text as T
from mentionmill.operators.flags import first_rule

# Complexes and their subunits, receptor families and their members, oncogenes of several genes, by key.
_ERBB, _TRK, _VEGFR, _PDGFR, _FGFR = "EGFR ERBB2 ERBB3 ERBB4", "NTRK1 NTRK2 NTRK3", "FLT1 KDR FLT4", "PDGFRA PDGFRB", "FGFR1 FGFR2 FGFR3 FGFR4"
NFKB = "nf-kb complex"
SETS = {
    "complex": (
        ("IL12A IL12B", "il12 il12p70"), ("IL12A", "il12p35"), ("IL12B", "il12p40 il23p40"), ("IL12B IL23A", "il23"), ("IL23A", "il23p19"), ("EBI3 IL27", "il27"), ("IL27", "il27p28"),
        ("FOS FOSB JUN JUND", "ap1"),
    ),
    "family": (
        (_VEGFR, "vegfreceptor vegfreceptors vegfrs"), (_PDGFR, "pdgfreceptor pdgfreceptors pdgfrs"), (_FGFR, "fgfreceptor fgfreceptors fgfr fgfrs"),
        (_ERBB, "egfrfamily egfrfamilymembers erbbreceptor erbbreceptors erbbproteins erbboncoproteins erbbfamilyreceptors erbbs her herfamily herreceptors"),
        (_TRK, "trk trks trkr trkreceptor trkreceptors trktyrosinekinase ntrk ntrks ntrk13 ntrkreceptor ntrkreceptors ntrkfusion ntrkfusions ntrkfusionproteins"),
        ("NGFR " + _TRK, "neurotrophinreceptor neurotrophinreceptors"),
    ),
    "oncogene": (("ETS1 ETS2", "cets"), ("HRAS KRAS NRAS", "cras")),
}
NFKB_GENES = "NFKB1 RELA"
MODES = {"complex": "complex→subunits", "family": "receptor family (ambiguous)", "oncogene": "c-oncogene→genes (ambiguous)"}

# Cellular oncogenes by the name behind c-, and numbered or lettered ones by what tells them apart.
ONCOGENES = dict(
    pair.split("=")
    for pair in (
        "kit=KIT src=SRC abl=ABL1 fos=FOS jun=JUN myc=MYC ret=RET raf=RAF1 cbl=CBL mpl=MPL met=MET ros=ROS1 sis=PDGFB fms=CSF1R yes=YES1 fgr=FGR fes=FES mos=MOS rel=REL mil=RAF1 myb=MYB erba=THRA "
        "crk=CRK maf=MAF ski=SKI fps=FES pim=PIM1 cot=MAP3K8 mer=MERTK sea=MST1R"
    ).split()
)
NUMBERED = (
    (r"^c-?ets-?([12])\b", {"1": "ETS1", "2": "ETS2"}), (r"^c-?(ha|ki|[hkn])-?ras\b", {"ha": "HRAS", "h": "HRAS", "ki": "KRAS", "k": "KRAS", "n": "NRAS"}),
    (r"^c-?bcl-?([236])\b", {"2": "BCL2", "3": "BCL3", "6": "BCL6"}), (r"^c-?erbb-?([1-4])\b", {"1": "EGFR", "2": "ERBB2", "3": "ERBB3", "4": "ERBB4"}),
)
MET_RECEPTOR = r"^(?:hgf|met)[ -]receptors?\b"
JUN_KINASE = "termin|jnk"

# What speaks of an enzyme rather than a histone, what may stand before one, look-alikes, and the variants in order.
HISTONE_ENZYMES = "deacetylas|demethylas|methyltransferas|acetyltransferas|acetyl transferas|methyl transferas|monomethyltransferas|acetylase|methylase|kinase|inhibitor"
HISTONE_FRONT = r"^(?:phospho|cit|acetyl(?:ated)?|anti[- ]?phospho|anti|g|wt|oncohistones?|core)[- ]+"
NO_HISTONES = ("H3-5HT",)
HISTONES = (
    ("macroH2A", "macroh2a|mh2a"), ("H2A.Z", r"h2a[.\- ]*z"), ("H2A.X", r"h2a[.\- ]*x"), ("CENP-A", r"cenp[.\- ]*a|cenh3"), ("H3.3", r"h3f3|h3[.\- ]*3"), ("H3.4", r"h3[.\- ]*4"), ("H3.5", r"h3[.\- ]*5"),
    ("H3", r"h3(?:[.\- ]|[krsgtqa]|f3|$)"), ("H4", r"h4(?:[.\- ]|[krs]|$)"), ("H2B", "h2b"), ("H2A", "h2a"), ("H1", r"h1(?:[.\- ]|[krs]\d|f|$)"),
)
HISTONE_GENES = {"macroH2A": "MACROH2A1 MACROH2A2", "H2A.Z": "H2AZ1 H2AZ2", "H2A.X": "H2AX", "CENP-A": "CENPA", "H3.3": "H3-3A H3-3B", "H3.4": "H3-4", "H3.5": "H3-5"}
HISTONE_GROUPS = {"H3": "H3 histones", "H4": "H4 histones", "H2B": "H2B histones", "H2A": "H2A histones", "H1": "H1 histones"}
NOT_CANONICAL_H3 = ("CENPA", "H3-4", "H3-5", "H3-7", "H3Y1", "H3Y2")


def set_rows() -> list[tuple[str, str, str]]:
    """(field, name, symbol) of all sets with fixed genes."""
    out = [(f, key, g) for f, sets in SETS.items() for genes, keys in sets for key in keys.split() for g in genes.split()]
    out += [("complex", NFKB, g) for g in NFKB_GENES.split()]
    return out + [(v, v, g) for v, genes in HISTONE_GENES.items() for g in genes.split()]


def set_names(hgnc: DataFrame) -> DataFrame:
    """(id, label, field, field_rank, name): the names of gene sets, histone families from the gene groups of the list."""
    fixed = hgnc.sparkSession.createDataFrame(set_rows(), "field string, name string, symbol string")
    known = hgnc.where("symbol is not null").select("symbol", "hgnc_id")
    x = fixed.join(known, "symbol", "left").select(F.coalesce("hgnc_id", "symbol").alias("id"), F.col("symbol").alias("label"), "field", "name")
    if "gene_group" in hgnc.columns:
        member = hgnc.select(F.col("hgnc_id").alias("id"), F.col("symbol").alias("label"), F.explode("gene_group").alias("g"))
        family = first_rule([(v, F.col("g") == g) for v, g in HISTONE_GROUPS.items()])
        member = member.select("id", "label", family.alias("field")).where(F.col("field").isNotNull() & ~((F.col("field") == "H3") & F.col("label").isin(*NOT_CANONICAL_H3)))
        x = x.unionByName(member.withColumn("name", F.col("field")))
    return x.select("id", "label", "field", F.lit(-1).alias("field_rank"), "name")


def set_key(surface: Column) -> Column:
    """A surface without a word of form behind it, hyphens and blanks, in lower case."""
    return F.translate(F.regexp_replace(T.casefold(surface), " (?:mrna|gene|protein|cytokine)$", ""), "- ", "")


def nfkb_key(surface: Column) -> Column:
    """The name of the NF-kB complex if a surface means it and not one of its genes, inhibitors or subunits."""
    k = set_key(surface)
    behind = F.regexp_extract(k, "nfk(?:appab|b)(.?)", 1)
    means = k.rlike("nfk(?:appab|b)") & ~behind.rlike("^[0-9i]") & ~k.rlike("p(?:65|50|52|105|100)")
    return F.when(means, F.lit(NFKB))


def oncogene_key(surface: Column) -> Column:
    """The symbol, in lower case, of the gene that a cellular oncogene's spelling means, or null."""
    low = F.lower(surface)
    found = lambda p: F.nullif(F.regexp_extract(low, p, 1), F.lit(""))
    symbol = lambda genes, key: F.try_element_at(F.create_map(*[F.lit(v) for kv in genes.items() for v in kv]), key)
    plain = found(rf"^c-?({'|'.join(ONCOGENES)})\b")
    kinase = (plain == "jun") & low.rlike(JUN_KINASE)
    numbered = [symbol(genes, found(p)) for p, genes in NUMBERED]
    return F.lower(F.when(~F.coalesce(kinase, F.lit(False)), F.coalesce(symbol(ONCOGENES, plain), *numbered, F.when(low.rlike(MET_RECEPTOR), "MET"))))


def histone_key(surface: Column) -> Column:
    """The histone variant that a mark, mutant or variant belongs to, or null."""
    low = F.lower(F.trim(surface))
    t = F.regexp_replace(low, HISTONE_FRONT, "")
    named = t.rlike("^histones?[ -]*")
    t = F.regexp_replace(t, "^histones?[ -]*", "")
    t = F.when(named & t.rlike("^[0-9]"), F.concat(F.lit("h"), t)).otherwise(t)
    variant = first_rule([(v, t.rlike(f"^(?:{p})")) for v, p in HISTONES])
    return F.when(~surface.isin(*NO_HISTONES) & ~low.rlike(HISTONE_ENZYMES), variant)
