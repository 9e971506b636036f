"""Queries over small literal tables, for operators whose input no test table holds; their SQL is the expected result or says it anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionmill.functions import scores
from mentionmill.operators import corpus, evaluate, targets, training, xmldocs

JATS = """<article article-type="research-article"><front><article-title>On <i>x</i></article-title><abstract abstract-type="short"><p>One &amp; two.</p></abstract><abstract><title>Summary</title><p>Three.</p></abstract></front>
<body><p>Loose text.</p><sec sec-type="materials-and_methods"><title>How</title><p>First.</p><sec><title>Inner</title><p>Second.<p>Third.</p></p></sec><fig><label>Fig. 1</label><caption><p>A legend.</p></caption></fig></sec>
<sec><p>No title.</p><table-wrap><label>T1</label><caption><title>Rows</title></caption><table><thead><tr><th>a</th><th>b</th></tr></thead></table></table-wrap></sec></body><back><ref-list><ref/></ref-list></back></article>"""
TEI = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><title>On y</title><abstract><p>Abs &undefined; here.</p></abstract><body><div><head>1. Results and Discussion</head><p>Text one.</p><p>Text two.
</div><figure><head>Fig 2</head><figDesc>What it shows</figDesc></figure><figure type="table"><head>Table 1</head><figDesc>Rows</figDesc><table><row><cell>x</cell><cell>y</cell></row><row><cell>1</cell></row></table></figure></body></TEI>"""
_XML = [("a", JATS), ("b", TEI), ("c", None), ("d", " "), ("e", "<html><p>neither</p></html>"), ("f", "<article><body><preformat>scan</preformat></body></article>")]


def _xml(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_XML, "pmid string, xml string")


def article_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return xmldocs.article_paragraphs(_xml(spark), "pmid", "xml").drop("parse_error")


def section_headings(spark: SparkSession, d: str) -> DataFrame:
    return corpus.section_titles(_xml(spark), "pmid", "xml")


def structure_coverage(spark: SparkSession, d: str) -> DataFrame:
    x = _xml(spark).where("pmid in ('a', 'f')").select(corpus.structure(F.col("xml")).alias("s"))
    return corpus.coverage(x).select("part", "articles", F.round("share", 6).alias("share"))


def tei_facts(spark: SparkSession, d: str) -> DataFrame:
    x = _xml(spark).where("pmid = 'b'").select(corpus.tei_structure(F.col("xml")).alias("s")).select("s.*")
    return x.withColumn("sections", F.array_join("sections", "|"))


def article_kinds(spark: SparkSession, d: str) -> DataFrame:
    x = _xml(spark).where("pmid in ('a', 'b', 'f')")
    return x.select("pmid", corpus.article_type(F.col("xml")).alias("kind"), corpus.text_class(F.col("xml")).alias("text_class"))


_DOC = "struct<id: string, passages: array<struct<text: array<string>, offsets: array<array<int>>>>, entities: array<struct<id: string, type: string, text: array<string>, offsets: array<array<int>>>>, relations: array<struct<type: string, arg1_id: string, arg2_id: string>>>"
_KB = """[{"id": "d1", "passages": [{"text": ["Dex raised EGFR. Aspirin blocked dexamethasone and TP53."], "offsets": [[10, 66]]}, {"text": ["EGFR inhibits Dex! None here"], "offsets": [[70, 98]]}],
"entities": [{"id": "e1", "type": "Chem", "text": ["Dex"], "offsets": [[10, 13]]}, {"id": "e2", "type": "Gene", "text": ["EGFR"], "offsets": [[21, 25]]}, {"id": "e3", "type": "Chem", "text": ["Aspirin"], "offsets": []}, {"id": "e4", "type": "Gene", "text": ["TP53"], "offsets": [[0, 4]]}, {"id": "e5", "type": "Cell", "text": ["None"], "offsets": []}],
"relations": [{"type": "old", "arg1_id": "e1", "arg2_id": "e2"}, {"type": "up", "arg1_id": "e2", "arg2_id": "e1"}, {"type": "odd", "arg1_id": "e3", "arg2_id": "e4"}]}, {"id": "d2"}]"""


def training_examples(spark: SparkSession, d: str) -> DataFrame:
    docs = spark.createDataFrame([(_KB,)], "j string").select(F.explode(F.from_json("j", f"array<{_DOC}>")).alias("d")).select("d.*")
    return training.relation_rows(docs, {"Chem": "CHEMICAL", "Gene": "GENE"}, [("CHEMICAL", "GENE")], {"up": "1", "old": "2"})


_ROLES = [
    ("C1", "dexol", "R1", "EGFR inhibitor"), ("C1", "dexol", "R2", "EC 2.7.10.1 (protein kinase X) inhibitor"), ("C2", "betol", "R3", "muscarinic-receptor inverse agonist"), ("C2", "betol", "R4", "solvent"),
    ("C3", "gamol", "R5", "calcium channel blocker"), ("C3", "gamol", "R6", "p53 stabiliser"),
]
_GENES = [("EGFR", "EGFR"), ("EGFR", "epidermal growth factor receptor"), ("PKX", "Protein Kinase X"), ("CHRM1", "muscarinic receptor"), ("TP53", "p-53"), ("TP53", "p 53")]
_DRUGS = [
    ("Dexol-abcd", "EGFR", "inhibitor", "TRUE", "1"), (" dexol ", "TP53", None, "no", None), ("BETOL 99mTc", "CHRM1", "agonist", "yes", "no"), ("a + b", "EGFR", "x", "1", "1"), ("null", "EGFR", "x", "1", "1"), ("gamol 177lu", "TP53", "binder", "0", "0"),
    ("Dexol", None, "x", "1", "1"), ("omegol", "MYC", "binder", "0", "1"),
]


def role_targets(spark: SparkSession, d: str) -> DataFrame:
    """Genes that the roles of chemicals act on, with action and class."""
    nodes = spark.createDataFrame([(c, n) for c, n, *_ in _ROLES] + [(r, n) for *_, r, n in _ROLES], "id string, label string").distinct()
    edges = spark.createDataFrame([(c, "http://x/RO_0000087", r) for c, _, r, _ in _ROLES] + [("C1", "is_a", "R3")], "sub string, pred string, obj string")
    return targets.role_targets(targets.chemical_roles(nodes, edges), spark.createDataFrame(_GENES, "label string, name string"))


def role_counts(spark: SparkSession, d: str) -> DataFrame:
    """Targets of roles by class and action."""
    return role_targets(spark, d).groupBy("class", "action").agg(F.count("*").alias("roles"), F.countDistinct("symbol").alias("genes"))


def _interactions(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    known = targets.interactions(spark.createDataFrame(_DRUGS, "Drug_Name string, gene_name string, Interaction_Type string, approved string, anti_neoplastic string"))
    return spark.createDataFrame(sorted({(c, n) for c, n, *_ in _ROLES}), "chemical string, name string"), known


def drug_targets(spark: SparkSession, d: str) -> DataFrame:
    return targets.drug_targets(*_interactions(spark))


def uncovered_drugs(spark: SparkSession, d: str) -> DataFrame:
    chemicals, known = _interactions(spark)
    return targets.uncovered_drugs(known, chemicals).select("drug", "gene", "type", "approved", "anti_neoplastic")


def targets_by_gene(spark: SparkSession, d: str) -> DataFrame:
    x = targets.by_gene(drug_targets(spark, d), spark.createDataFrame([("EGFR",), ("EGFR",)], "gene string"))
    return x.withColumn("chemicals", F.array_join("chemicals", "|"))


def isotonic_fit(spark: SparkSession, d: str) -> DataFrame:
    """Breakpoints of a calibrator; a model with few rows has none."""
    rows = [("m", p, i < k) for p, n, k in ((0.2, 10, 3), (0.5, 4, 1), (0.8, 10, 8)) for i in range(n)] + [("few", 0.5, True), ("few", 0.6, False)]
    x = evaluate.fitted(spark.createDataFrame(rows, "model string, p double, hit boolean"), "model", "p", "hit")
    return x.select("group", F.explode(F.arrays_zip("x", "y")).alias("z")).select("group", F.col("z.x").alias("x"), F.round("z.y", 6).alias("y"))


def top_classes(spark: SparkSession, d: str) -> DataFrame:
    """The two likeliest classes of each vector."""
    x = spark.createDataFrame([(1, [0.1, 0.7, 0.2]), (2, [0.5, 0.5]), (3, [1.0])], "id int, p array<double>")
    return x.select("id", F.posexplode(scores.top_two(F.col("p"))).alias("rank", "t")).select("id", "rank", "t.place", "t.p")


QUERIES = {f.__name__: f for f in (article_paragraphs, section_headings, structure_coverage, tei_facts, article_kinds, training_examples, role_targets, role_counts, drug_targets, uncovered_drugs, targets_by_gene, isotonic_fit, top_classes)}


def _values(columns: str, rows: list[tuple]) -> str:
    plain = lambda v: "null" if v is None else str(v).lower() if isinstance(v, bool) else repr(v) + "::double" if isinstance(v, float) else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"select * from (values {', '.join('(' + ', '.join(map(plain, r)) + ')' for r in rows)}) v({columns})"


_ACTION = "inverse agonist|partial agonist|antagonist|agonist|inhibitor|activator|modulator|blocker|opener|potentiator|stabiliser|stabilizer"
_ROLE_SQL = f"""
with r as ({_values("chemical, label, id, role", _ROLES)}), g as ({_values("symbol, name", _GENES)}),
t as (select chemical, label, role, regexp_extract(lower(role), '({_ACTION})$', 1) as action,
  lower(trim(case when role like 'EC %' then regexp_extract(role, '[(\\[](.+)[)\\]]', 1) else regexp_replace(role, '(?i)({_ACTION})$', '') end)) as target from r where regexp_matches(lower(role), '{_ACTION}')),
hits as (select t.*, symbol, 0 as fold from t join g on target = lower(name) union select t.*, symbol, 1 from t join g on replace(replace(target, '-', ''), ' ', '') = replace(replace(lower(name), '-', ''), ' ', '')),
best as (select *, min(fold) over (partition by chemical, role) as first from hits)
select distinct chemical, label, role, symbol, action, case when role like 'EC %' then 'EC enzyme' when lower(role) like '%receptor%' then 'receptor' when lower(role) like '%kinase%' then 'kinase' when lower(role) like '%channel%' then 'ion channel' else 'other protein' end as class
from best where fold = first"""
_KNOWN = f"""
d as ({_values("drug_name, gene, type, approved, neoplastic", _DRUGS)}),
k as (select distinct trim(regexp_replace(regexp_replace(lower(trim(drug_name)), ' +[0-9]+[a-z]+$', ''), '-[a-z]{{4}}$', '')) as drug, gene, coalesce(type, 'unknown') as type, coalesce(lower(approved) in ('true', '1', 'yes', 't'), false) as approved, coalesce(lower(neoplastic) in ('true', '1', 'yes', 't'), false) as anti_neoplastic
  from d where gene is not null and drug_name not like '%+%' and lower(trim(drug_name)) <> 'null'),
c as ({_values("chemical, name", sorted({(c, n) for c, n, *_ in _ROLES}))})"""
_DRUG_TARGETS = f"with {_KNOWN} select distinct chemical, gene, type, approved, anti_neoplastic from c join k on drug = name"

SQL = {
    "article_paragraphs": _values("pmid, scheme, para_ord, section_type, section_title, text", [
        ("a", "jats", 0, "abstract", "Abstract (short)", "One & two."), ("a", "jats", 1, "abstract", "Summary", "Three."), ("a", "jats", 2, "materials|methods", "How", "First."), ("a", "jats", 3, "materials|methods", "How", "Second.Third."),
        ("a", "jats", 4, "materials|methods", "How", "Third."), ("a", "jats", 5, "(untitled)", "(untitled)", "No title."), ("a", "jats", 6, "(body)", "Body", "Loose text."), ("a", "jats", 7, "figure-legend", "Fig. 1", "Fig. 1 A legend."),
        ("a", "jats", 8, "table-heading", "T1", "T1 Rows"), ("a", "jats", 9, "table-heading", "T1", "ab"), ("b", "tei", 0, "abstract", "Abstract", "Abs &undefined; here."), ("b", "tei", 1, "1. results|discussion", "1. Results and Discussion", "Text one."),
        ("b", "tei", 2, "1. results|discussion", "1. Results and Discussion", "Text two."), ("b", "tei", 3, "figure-legend", "Fig 2", "Fig 2 What it shows"), ("b", "tei", 4, "table-heading", "Table 1", "Table 1 Rows"), ("b", "tei", 5, "table-heading", "Table 1", "xy"),
    ]),
    "section_headings": _values("doc, title, kind", [("a", "How", "materials-and_methods"), ("a", "Inner", ""), ("b", "Results and Discussion", "")]),
    "structure_coverage": _values("part, articles, share", [
        ("all", 2, 1.0), ("title", 1, 0.5), ("abstract", 1, 0.5), ("references", 1, 0.5), ("figures", 1, 0.5), ("tables", 1, 0.5), ("shape: structured", 1, 0.5), ("shape: OCR scanned", 1, 0.5), ("main sections: 0", 1, 0.5), ("main sections: 1", 1, 0.5), ("section: Methods", 1, 0.5), ("no abstract, shape: OCR scanned", 1, 0.5),
    ]),
    "tei_facts": _values("has_title, has_abstract, n_divs, n_refs, sections", [(True, True, 1, 0, "Discussion|Results")]),
    "article_kinds": _values("pmid, kind, text_class", [("a", "research-article", "fulltext"), ("b", "unknown", "fulltext"), ("f", "unknown", "fulltext")]),
    "training_examples": _values("id, place, sentence, label, connecting", [
        ("d1", 0, "@CHEMICAL$ raised @GENE$.", "1", "raised"), ("d1", 1, "@CHEMICAL$ blocked dexamethasone and @GENE$.", "0", "blocked dexamethasone and"), ("d1", 2, "@GENE$ inhibits @CHEMICAL$!", "1", "inhibits"),
    ]),
    "role_targets": _ROLE_SQL,
    "role_counts": f"select class, action, count(*) as roles, count(distinct symbol) as genes from ({_ROLE_SQL}) group by all",
    "drug_targets": _DRUG_TARGETS,
    "uncovered_drugs": f"with {_KNOWN} select * from k where drug not in (select name from c)",
    "targets_by_gene": f"select gene, array_to_string(list_sort(list(distinct chemical)), '|') as chemicals, count(distinct chemical)::int as n_chemicals, gene = 'EGFR' as in_corpus, case when bool_or(approved and anti_neoplastic) then 'approved anti-neoplastic' when bool_or(approved) then 'approved' else 'other' end as tier from ({_DRUG_TARGETS}) group by gene",
    "isotonic_fit": _values('"group", x, y', [("m", 0.2, 0.444444), ("m", 0.5, 0.444444), ("m", 0.8, 1.0)]),
    "top_classes": _values("id, rank, place, p", [(1, 0, 1, 0.7), (1, 1, 2, 0.2), (2, 0, 0, 0.5), (2, 1, 1, 0.5), (3, 0, 0, 1.0)]),
}
