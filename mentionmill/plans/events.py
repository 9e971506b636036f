"""Queries with flags, windows and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionmill.operators import flags
from mentionmill.session import table
from mentionmill.streaming import flows


STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def control_flags(spark: SparkSession, d: str) -> DataFrame:
    """Gene surfaces, and some more, by control class."""
    s = _with(table(spark, d, "clean_genetic_ne").select("clean_genetic_ne").distinct(), "clean_genetic_ne", GENE_EXAMPLES)
    return s.select("clean_genetic_ne", F.coalesce(flags.control_class(F.col("clean_genetic_ne")), F.lit("none")).alias("control"))


def _typed(spark: SparkSession, d: str, kind: str) -> DataFrame:
    e = table(spark, d, "triples").select(F.explode(F.array("subject", "object")).alias("e"))
    return e.where(F.col("e.type") == kind).select(F.col("e.text").alias("surface")).distinct()


#: Surfaces that no test table holds, so that every class is reached.
DISEASE_EXAMPLES = (
    "Metastases", "tumour spheres", "tumourigenesis", "malignancies", "oedema", "hepatotoxicities", "gliomagenesis", "DNA damage", "lesions", "malignant glioma", "radiation necrosis", "breast cancer",
    "er stress", "anoikis", "xgenesis", "injury", "",
)
CHEMICAL_EXAMPLES = ("LINC00152", "circRNA1", "miR-21", "hsa-miR-21", "let-7a", "SNHG1", "MIR17HG", "antisense oligonucleotide", "siRNA", "Chemotherapy", "PDT", "YAP", "TRAIL", "LPA", "aspirin", "lncRNA X", "")
GENE_EXAMPLES = (
    "anti-GFP antibody", "shNC", "MOVCAR-shNCAM", "MOVCAR-shNC", "sh-control", "si-Scr 2", "NTC siRNA", "scramble", "shGFP-1", "sgLuc", "shLucX", "Flag-AKT1-WT", "PTENT277A-GFP", "TUBB3-V5", "Ha-ras", "Ccr2RFP",
    "Cas9n", "β-actin mRNA", "18S rRNA", "Lamin B1 protein", "6xHis", "tubacin", "GFP + antibody", "ad-lenti-LacZ reporter gene", "Beta-Gal staining", "shNCL", "",
)


def _with(surfaces: DataFrame, column: str, examples: tuple[str, ...]) -> DataFrame:
    return surfaces.unionByName(surfaces.sparkSession.createDataFrame([(x,) for x in examples], f"`{column}` string")).distinct()


def phenotype_flags(spark: SparkSession, d: str) -> DataFrame:
    """Disease surfaces, and some more, by the process or state they name."""
    s = _with(_typed(spark, d, "DISEASE"), "surface", DISEASE_EXAMPLES)
    c = flags.phenotype(F.col("surface"))
    return s.select("surface", F.coalesce(c, F.lit("none")).alias("phenotype"), flags.phenotype_tier(c).alias("tier"))


def broad_phenotypes(spark: SparkSession, d: str) -> DataFrame:
    """How many disease surfaces a broad scan for stems would catch, and how many of them are listed."""
    s = _with(_typed(spark, d, "DISEASE"), "surface", DISEASE_EXAMPLES).where(F.col("surface").rlike(flags.BROAD_PHENOTYPES))
    return s.agg(F.count("*").alias("broad"), F.count(flags.phenotype(F.col("surface"))).alias("listed"))


def not_chemical_flags(spark: SparkSession, d: str) -> DataFrame:
    """Chemical surfaces, and some more, by why they are no chemicals; those that an ontology label or synonym equals count as matched."""
    s = _with(_typed(spark, d, "CHEMICAL"), "surface", CHEMICAL_EXAMPLES)
    obo = table(spark, d, "obo_term").where("id like 'CHEBI:%'")
    names = obo.select(F.explode(F.concat(F.array("label"), F.coalesce(F.transform("synonyms", lambda x: x["val"]), F.array()))).alias("surface")).distinct().withColumn("_hit", F.lit(True))
    x = flags.not_chemical(s.join(names, "surface", "left"), "surface", F.col("_hit").isNotNull(), table(spark, d, "hgnc"))
    return x.select("surface", F.coalesce("class", F.lit("none")).alias("class"))


def hourly_events(spark: SparkSession, d: str) -> DataFrame:
    """The windowed count of the stream, over the whole table at once."""
    x = flows.windowed_counts(table(spark, d, "events"), "ts", ["event_type"])
    return x.select(F.date_format("window_start", STAMP).alias("start"), "event_type", "n")


def user_sessions(spark: SparkSession, d: str) -> DataFrame:
    x = flows.sessions(table(spark, d, "events"), "ts", "user_id", "6 hours")
    return x.select("user_id", F.date_format("session_start", STAMP).alias("start"), F.date_format("session_end", STAMP).alias("end"), "n")


QUERIES = {f.__name__: f for f in (control_flags, phenotype_flags, broad_phenotypes, not_chemical_flags, hourly_events, user_sessions)}

_FOLD = "replace(translate(lower({0}), 'ςµİ', 'σμi'), 'ß', 'ss')"
_in = lambda xs: ", ".join(f"'{x}'" for x in xs)
_or = lambda xs: "|".join(xs)
_LEAD, _TRAIL = f"^({_or(flags.IN_FRONT)})+", "( *antibody| *reporter gene| *reporter| *gene| *mrna| *protein| *staining| *complex)+$"
_LOW = _FOLD.format("s")
_CORE = f"trim(regexp_replace(regexp_replace(regexp_replace({_FOLD.format('trim(s)')}, '{_LEAD}', ''), '{_TRAIL}', ''), '^[ +-]+|[ +-]+$', '', 'g'))"
_UNTARGETED = f"(^|[^a-z])({_or(flags.GUIDES)})-?({_or(flags.NO_TARGET)})($|[^a-z])"
_also = lambda examples, c: f"select unnest([{_in(examples)}]) as {c}"
_TYPED = "(select distinct e.text as surface from (select unnest([subject, \"object\"]) as e from triples) where e.type = '{0}' union select * from ({1}))"
_UK = _FOLD.format("surface")
for _a, _b in (("tumour", "tumor"), ("oedema", "edema"), ("oesophag", "esophag"), ("haem", "hem"), ("anaemi", "anemi"), ("leukaemi", "leukemi"), ("ischaemi", "ischemi"), ("paediatr", "pediatr")):
    _UK = f"replace({_UK}, '{_a}', '{_b}')"
_FORMS = "[w, case when w like '%ies' and length(w) > 4 then left(w, -3) || 'y' end, case when w like '%es' and length(w) > 4 then left(w, -2) end, case when w like '%s' and w not like '%ss' and length(w) > 3 then left(w, -1) end]"
_PHENO = ", ".join(f"('{w}', '{c}', '{t}')" for t, v in (("A", flags.PROCESSES), ("B", flags.STATES)) for c, ws in v.items() for w in ws)
_PHENOTYPES = f"""
with s as (select surface, {_UK} as w from {_TYPED.format('DISEASE', _also(DISEASE_EXAMPLES, 'surface'))}),
listed(word, category, tier) as (values {_PHENO}),
forms as (select surface, unnest({_FORMS}) as f, unnest([1, 2, 3, 4]) as k from s),
hits as (select surface, arg_min(category, k) as category, arg_min(tier, k) as tier from forms join listed on f = word group by surface),
classed as (select s.surface, case when category is not null then category when regexp_matches(w, '(toxicity|toxicities|genesis)$') then '{flags.BY_ENDING}' end as category, coalesce(tier, 'A') as t from s left join hits using (surface))
"""

SQL = {
    "control_flags": f"""select s as clean_genetic_ne, case when {_LOW} like '%cas9%' then 'editing nuclease' when regexp_matches({_LOW}, '{_UNTARGETED}') then 'scramble control' when {_LOW} in ('scramble', 'scrambled', 'ntc') then 'scramble control'
      when regexp_full_match({_LOW}, '(ntc|nc) *sirna') then 'scramble control' when regexp_matches({_LOW}, '^(sh|si|sg)-?(gfp|luc|luciferase)(-[a-z0-9_]+)?$') then 'reporter knockdown'
      {" ".join(f"when {_CORE} in ({_in(words)}) then '{name}'" for name, words in flags.MARKERS.items())} else 'none' end as control
      from (select clean_genetic_ne as s from clean_genetic_ne union {_also(GENE_EXAMPLES, 's')})""",
    "phenotype_flags": f"{_PHENOTYPES} select surface, coalesce(category, 'none') as phenotype, case when category is not null then t end as tier from classed",
    "broad_phenotypes": f"{_PHENOTYPES} select count(*) as broad, count(category) as listed from classed where regexp_matches(surface, '{flags.BROAD_PHENOTYPES}')",
    "not_chemical_flags": f"""with s as (select surface from {_TYPED.format('CHEMICAL', _also(CHEMICAL_EXAMPLES, 'surface'))}),
names as (select label as n from obo_term where id like 'CHEBI:%' union select x.val from (select unnest(synonyms) as x from obo_term where id like 'CHEBI:%'))
select surface, case when regexp_matches(surface, '(?i)({_or(flags.NUCLEIC)})') then 'nucleic acid / genetic element' when {_FOLD.format('surface')} in ({_in(flags.THERAPIES)}) then 'process / therapy / concept'
  when surface in ({_in(flags.ALIAS_PROTEINS)}) then 'gene / protein' when surface not in (select n from names where n is not null) and surface in (select symbol from hgnc where symbol is not null) and surface not in ({_in(flags.CHEMICAL_SYMBOLS)}) then 'gene / protein' else 'none' end as class from s""",
    "hourly_events": "select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%f') as start, event_type, count(*) as n from events group by all",
    "user_sessions": """
with m as (select user_id, ts, case when ts - lag(ts) over w < interval 6 hours then 0 else 1 end as first from events window w as (partition by user_id order by ts)),
s as (select *, sum(first) over (partition by user_id order by ts rows unbounded preceding) as k from m)
select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as start, strftime(max(ts) + interval 6 hours, '%Y-%m-%d %H:%M:%S.%f') as "end", count(*) as n from s group by user_id, k""",
}
