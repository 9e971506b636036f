from collections import Counter

import pytest
from pyspark.sql import functions as F

from mentionmill.functions import scores as S
from mentionmill.functions import text as T
from mentionmill.operators import flags, linking, segment


def _of(spark, f, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_folds(spark):
    assert _of(spark, T.casefold, "ςßµ", "ABC", None) == ["σssμ", "abc", None]
    assert _of(spark, T.dash_normalize, "Pisd - ps1", "a – b", "IL−6") == ["Pisd-ps1", "a-b", "IL-6"]
    assert _of(spark, T.hyphen_space_fold, "PD-L1") == ["pd l1"]
    assert _of(spark, T.no_separators, "PD-L1 x") == ["pdl1x"]
    assert _of(spark, T.squeeze, " a \n b ") == ["a b"]
    assert _of(spark, T.accession, "PMC1.grobid.tei", "PMC2") == ["PMC1", "PMC2"]
    assert _of(spark, T.without_scheme, "PMC1.grobid.tei.xml", "PMC2.xml", "PMC3.grobid.tei") == ["PMC1", "PMC2", "PMC3"]
    assert _of(spark, T.section_type, "Results and Discussion", "materials|methods", " Intro ", None) == ["discussion|results", "materials|methods", "intro", ""]
    assert _of(spark, T.curie, "http://x/obo/MONDO_0001") == ["MONDO:0001"]
    assert _of(spark, T.heading, "2.1. <i>Cell</i> &amp; tissue", "IV. Results") == ["Cell & tissue", "Results"]
    assert _of(spark, T.title_key, " Results: ") == ["results"]
    assert _of(spark, lambda c: T.first_year(c), "c. 2011 Jan", "none", None) == [2011, None, None]
    assert _of(spark, T.american, "haemorrhagic tumour") == ["hemorrhagic tumor"]
    assert _of(spark, T.singulars, "metastases", "biopsies", "mass") == [["metastasis", "metastas", "metastase"], ["biopsy", "biopsi", "biopsie"], []]
    assert _of(spark, T.is_greek, "TNF-α", "PI3K", "p38 alpha", "MU", "mu opioid", "Mu") == [True, False, True, False, True, False]
    assert _of(spark, T.greek_spelled, "NF-κB") == ["nf-kappab"]


def test_blinding_and_ids(spark):
    df = spark.sql("select 'EGFR binds gefitinib.' t, named_struct('start', 0, 'end', 4, 'label', 'GENETIC') a, named_struct('start', 11, 'end', 20, 'label', 'CHEMICAL') b")
    from mentionmill.operators.relations import MARKERS, marker

    r = df.select(T.blinded(F.col("t"), F.col("a"), F.col("b"), marker(MARKERS)).alias("x"), T.pair_id(F.lit("PMC1"), F.col("t"), F.col("a"), F.col("b")).alias("p")).first()
    assert r.x == "@GENE$ binds @CHEMICAL$." and r.p.endswith(":0-4:11-20") and len(r.p.split(":")[1]) == 8


def test_symbols_and_single(spark):
    df = spark.sql("select array('A|B', ' A ', '') x, array('A|B') y, cast(null as array<string>) z")
    r = df.select(T.symbols(F.col("x")).alias("a"), T.single(F.col("y")).alias("b"), T.single(F.col("x")).alias("c"), T.symbols(F.col("z")).alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == (["A", "B"], "A|B", None, [])


@pytest.mark.parametrize(("p", "want"), [(0.0, 0.1), (0.25, 0.25), (0.5, 0.4), (0.95, 0.91), (1.0, 0.97)])
def test_interpolation(spark, p, want):
    df = spark.range(1).select(S.interpolated(F.lit(p), [0.0, 0.5, 0.9, 1.0], [0.1, 0.4, 0.85, 0.97]).alias("x"))
    assert df.first().x == pytest.approx(want)


def test_scores(spark):
    row = spark.range(1).select(
        S.composite(F.lit(0.9), F.lit(0.8), F.lit(0.0), F.lit(False), F.lit(0.2), F.lit("Introduction"), F.lit(True), F.lit("activates")).alias("a"),
        S.repenalized(F.lit(0.8), F.lit(1.0), F.lit(True), F.lit("activates")).alias("b"), S.repenalized(F.lit(0.8), F.lit(1.0), F.lit(True), F.lit("Binds")).alias("c"),
        S.decile(F.lit(1.0)).alias("d"), S.top_two(F.array(F.lit(0.2), F.lit(0.4), F.lit(0.4))).alias("e"), S.platt(F.lit(0.5), 1.0, 0.0).alias("f"),
    ).first()
    assert row.a == pytest.approx(round(0.9 * 0.8 * 0.85 * 1.1 * 0.9 * 0.5, 4)) and row.b == 0.4 and row.c == 0.8 and row.d == 100 and row.f == 0.5
    assert [(x.place, x.p) for x in row.e] == [(1, 0.4), (2, 0.4)]


def test_splitter(spark):
    assert _of(spark, segment.split, "Levels rose 3.5-fold (Fig. 2). J. Smith et al. agreed! Next one.", "", None) == [["Levels rose 3.5-fold (Fig. 2).", "J. Smith et al. agreed!", "Next one."], [], []]


def test_sentence_filter_and_cues(spark):
    good = "We found that levels of the protein increased (p < 0.05)."
    assert _of(spark, segment.is_sentence, good, "Short one.", "ALL CAPITAL LETTERS ARE A HEADING HERE.", "no clean start in this long sentence here.", None) == [True, False, False, False, False]
    assert _of(spark, segment.cues, good) == [["finding", "change", "stat"]]
    assert _of(spark, segment.is_prior, "It has been shown before.", "See https://x.org", good) == [True, True, False]


def test_controls(spark):
    assert _of(spark, flags.control_class, "anti-GAPDH antibody", "shNC", "shNCAM", "EGFP reporter", "3xFLAG", "Cas9", "siGFP", "TP53", None) == ["housekeeping control", "scramble control", None, "reporter protein", "epitope tag", "editing nuclease", "reporter knockdown", None, None]


def test_roles(spark):
    roles = ("EC 2.7.1.1 (hexokinase) inhibitor", "dopamine receptor antagonist", "tubulin modulator")
    assert _of(spark, flags.target_name, *roles) == ["hexokinase", "dopamine receptor", "tubulin"]
    assert _of(spark, flags.action_of, *roles) == ["inhibitor", "antagonist", "modulator"]
    assert _of(spark, flags.target_class, *roles) == ["EC enzyme", "receptor", "other protein"]
    assert _of(spark, flags.drug_key, "BEVACIZUMAB-AWWB", "x 111in", "a+b", " ") == ["bevacizumab", "x", None, None]


GENES = [
    ("HGNC:1", "AKT1", ["PKB"], [], ["AKT kinase 1"]), ("HGNC:2", "MMP9", [], [], ["matrix metallopeptidase 9"]), ("HGNC:3", "CD274", ["PD-L1"], ["PDCD1L1"], ["CD274 molecule"]), ("HGNC:4", "TP53", ["p53"], [], ["tumor protein p53"]),
    ("HGNC:5", "MIR21", ["hsa-mir-21"], [], ["microRNA 21"]), ("HGNC:6", "MIR124-1", [], [], ["m"]), ("HGNC:7", "MIR124-2", [], [], ["m"]), ("HGNC:8", "AMB1", ["SHARED"], [], ["a"]), ("HGNC:9", "AMB2", ["SHARED"], [], ["b"]), ("HGNC:10", "NFKB1", ["NF-kappaB"], [], ["c"]), ("HGNC:11", "PARP1", ["PARP"], [], ["d"]),
    ("HGNC:12", "GRD2", ["MMP-X9"], [], ["e"]), ("HGNC:13", "MMPX9", [], [], ["f"]),
]


GENE_CASES = [
        ("AKT1", "HGNC:1", "case-sensitive"), ("akt1", "HGNC:1", "case-insensitive"), ("PD L1", "HGNC:3", "hyphen vs white space"), ("Matrix metallopeptidase-9", "HGNC:2", "hyphen vs white space"), ("p-AKT1", "HGNC:1", "phospho stripped"),
        ("anti-PD-L1 antibody", "HGNC:3", "anti- stripped"), ("p53 protein", "HGNC:4", "protein stripped"), ("TP53 mRNA", "HGNC:4", "transcript/mRNA stripped"), ("mutant p53", "HGNC:4", "variant/mutant stripped"), ("TP53R248L", "HGNC:4", "missense stripped"),
        ("TP53 R248L", "HGNC:4", "missense stripped"), ("PARPi", "HGNC:11", "inhibitor-i stripped"), ("miR-21-5p", "HGNC:5", "miR mature→gene"), ("miR-124", "HGNC:6|HGNC:7", "miR mature→gene"), ("TP53 promoter", "HGNC:4", "promoter stripped"), ("MMP-9", "HGNC:2", "hyphen-removed"),
        ("pAKT1", "HGNC:1", "p-prefix stripped"), ("WT TP53", "HGNC:4", "WT stripped"), ("nuclear AKT1", "HGNC:1", "nuclear stripped"), ("AKT1 target genes", "HGNC:1", "regulatory target-set (not the gene)"), ("NF-kB", "HGNC:10|RELA", "complex→subunits"),
        ("NF-κB", "HGNC:10", "greek letters spelled out"), ("PDL1", "HGNC:3", "separator-removed"), ("SHARED", "HGNC:8|HGNC:9", "case-sensitive"), ("nothing", "", None),
]


def _linked(spark, link, genes, cases):
    """What all surfaces of the cases give, from one query."""
    hgnc = spark.createDataFrame([(*g, None, None) for g in genes], "hgnc_id string, symbol string, alias_symbol array<string>, prev_symbol array<string>, name array<string>, alias_name array<string>, prev_name array<string>")
    got = link(spark.createDataFrame([(c[0],) for c in cases] + [(None,)], "surface string"), "surface", hgnc).collect()
    for r in got:
        n = len(r.ids or [])
        assert r.status == ("unmatched" if not n else "ambiguous" if n > 1 else "matched")
    return {(r.surface, "|".join(r.ids or []), r.match_mode) for r in got}


def test_gene_cascade(spark):
    assert _linked(spark, linking.link_genes, GENES, GENE_CASES) == {*GENE_CASES, (None, "", None)}


GREEK = [
    ("HGNC:1", "HIF1A", ["HIF-1alpha", "HIF1 alpha"], [], ["hypoxia inducible factor 1 subunit alpha"]), ("HGNC:2", "IFNG", [], [], ["interferon gamma"]), ("HGNC:3", "H2AX", [], [], ["h"]), ("HGNC:4", "PDCD1", ["PD-1"], [], ["p"]), ("HGNC:5", "IL1B", ["IL1 beta"], [], ["i"]),
    ("HGNC:6", "GSK3B", ["GSK3beta"], [], ["g"]), ("HGNC:7", "MAPT", ["tau"], [], ["m"]), ("HGNC:8", "CTNNB1", ["beta-catenin"], [], ["c"]), ("HGNC:9", "CAT", [], [], ["catalase"]),
]


GREEK_CASES = [
        ("tau", "HGNC:7", "key case-insensitive"), ("HIF-1α", "HGNC:1", "case-sensitive"), ("HIF1α", "HGNC:1", "greek-letter split"), ("IL-1β", "HGNC:5", "letter-number split"), ("Il-1β", "HGNC:5", "letter-number split (ci)"), ("shHIF-1α", "HGNC:1", "prefix-stripped"), ("IFN-γ", "HGNC:2", "IFN expansion"),
        ("αPD-1", "HGNC:4", "alpha-stripped"), ("phospho-tau", "HGNC:7", "phospho-stripped"), ("p-tau", "HGNC:7", "p- stripped"), ("γH2AX", "HGNC:3", "leading-greek strip"), ("HIF-1-α", "HGNC:1", "separator-deletion"), ("nuclear β-catenin", "HGNC:8", "qualifier-stripped"), ("GSK3β S9A", "HGNC:6", "residue-stripped"),
        ("αcat", "", None), ("ω-nothing", "", None),
]


def test_greek_cascade(spark):
    assert _linked(spark, linking.link_greek_genes, GREEK, GREEK_CASES) == {*GREEK_CASES, (None, "", None)}


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.99])
def test_every_pair_of_alike_word_bags(spark, threshold):
    names = ["edema of the lung", "anemia of the lung", "lung of the anemia", "of of the the", "rare of lung", "the lung", "kidney stone", "stone stone kidney"]
    surfaces = ["edema of the lung with tejulhir deposits", "newone newtwo of the lung", "lung anemia", "the of the of", "stone kidney kidney", "nothing here", "Edema of the lung"]
    bags = {x: Counter(x.lower().split()) for x in [*names, *surfaces]}
    cosine = lambda a, b: sum(k * b[w] for w, k in a.items()) / sum(k * k for k in a.values()) ** 0.5 / sum(k * k for k in b.values()) ** 0.5
    want = {(s, n) for s in surfaces for n in names if cosine(bags[s], bags[n]) >= threshold and s.lower() != n}
    s = spark.createDataFrame([(x,) for x in surfaces], "text string")
    n = spark.createDataFrame([(x, x) for x in names], "id string, name string")
    assert {(r.surface, r.name) for r in linking.bag_cosine(s, "text", n, threshold, None).collect()} == want
    if threshold == 0.6:
        assert len(linking.bag_cosine(s, "text", n, threshold).collect()) < len(want)
