"""Queries over sentences, mentions and triples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionmill.functions import scores
from mentionmill.functions import text as T
from mentionmill.operators import relations as R
from mentionmill.session import table

NORMALIZED = "triples_genetic_disease_chemical_normalized"
DASH_SQL = "regexp_replace(regexp_replace({0}, '[-‐‑‒–—―−⁃]', '-', 'g'), '[\\s\\x{{a0}}\\x{{2000}}-\\x{{200a}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]*-[\\s\\x{{a0}}\\x{{2000}}-\\x{{200a}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]*', '-', 'g')"


def dash(c: str) -> str:
    return DASH_SQL.format(c)


def surface_counts(spark: SparkSession, d: str) -> DataFrame:
    """Two-level count: mentions by raw form, then by normalized form, with the number of raw forms."""
    e = table(spark, d, "sentences").select(F.explode("entities").alias("e")).select("e.label", "e.text")
    raw = e.groupBy("label", "text").agg(F.count("*").alias("n"))
    return raw.groupBy("label", T.dash_normalize(F.col("text")).alias("surface")).agg(F.sum("n").alias("occurrences"), F.count("*").alias("n_source_forms"))


def repeated_surfaces(spark: SparkSession, d: str) -> DataFrame:
    return surface_counts(spark, d).where("occurrences > 1")


def adjacent_triples(spark: SparkSession, d: str) -> DataFrame:
    x = R.adjacent_triples(table(spark, d, "sentences"))
    return x.select(F.col("subject.text").alias("subject_text"), F.col("subject.type").alias("subject_type"), F.col("predicate.text").alias("predicate"), F.col("object.text").alias("object_text"), F.col("object.type").alias("object_type"), "pmid", "section", "sentence")


def candidate_pairs(spark: SparkSession, d: str) -> DataFrame:
    x = R.candidate_pairs(table(spark, d, "sentences"))
    cues = F.array_join("assertion_cues", "|").alias("cues")
    return x.select("pair_id", F.col("subject.text").alias("subject_text"), F.col("object.text").alias("object_text"), "type_pair", "connecting", "polarity", "modality", cues, "self_pair", "blinded")


ROUTES = [("CHEMICAL-GENETIC", "relmark-typed", 1), ("DISEASE-GENETIC", "relmark-binary", 1), ("GENETIC", "relmark-binary", 1), ("CHEMICAL", "relmark-legacy", 1), ("GENETIC", "relmark-multi", 2), ("CHEMICAL-DISEASE", "relmark-multi", 2), (None, "relmark-legacy", 9)]


def _routed(spark, d, exclusive):
    routes = spark.createDataFrame(ROUTES, "type_pair string, model string, precedence int")
    x = R.routed(R.candidate_pairs(table(spark, d, "sentences")), routes, exclusive)
    return x.groupBy("type_pair", "model").agg(F.count("*").alias("pairs"))


def route_exclusive(spark: SparkSession, d: str) -> DataFrame:
    return _routed(spark, d, True)


def route_additive(spark: SparkSession, d: str) -> DataFrame:
    return _routed(spark, d, False)


def composite_scores(spark: SparkSession, d: str) -> DataFrame:
    """The composite score of every stored verdict from its parts; cue from the sentence, margin unknown."""
    t = table(spark, d, "triples_re")
    p = F.coalesce("predicate.score_calibrated", "predicate.score")
    s = scores.composite(p, F.col("subject.score"), F.col("object.score"), R.relational(F.array().cast("array<string>"), F.col("sentence")), F.lit(None).cast("double"), F.col("section"), F.coalesce("self_pair", F.lit(False)), F.coalesce("predicate.text", F.lit("")))
    return t.where("predicate is not null").select("ord", s.alias("composite")).where("composite >= 0.5")


def relation_stats(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "triples_re").where("score between 0 and 1")
    types = F.array_join(F.array_sort(F.array_distinct(F.array("subject.type", "object.type"))), "-")
    return t.groupBy(types.alias("type_pair"), F.col("predicate.model").alias("model"), F.col("predicate.text").alias("label"), "polarity", "modality", scores.decile(F.col("score")).alias("decile")).agg(F.count("*").alias("n"))


def triple_stats(spark: SparkSession, d: str) -> DataFrame:
    """Type matrix and sections with distinct papers, as one grouping-sets query."""
    t = table(spark, d, "triples").select(F.col("subject.type").alias("subject_type"), F.col("object.type").alias("object_type"), F.coalesce("section", F.lit("(none)")).alias("section"), T.accession(F.col("pmid")).alias("paper"))
    x = t.groupingSets([["subject_type", "object_type"], ["section"]], "subject_type", "object_type", "section")
    return x.agg(F.count("*").alias("n"), F.countDistinct("paper").alias("papers"))


def predicate_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "triples").groupBy(F.lower("predicate.text").alias("predicate")).agg(F.count("*").alias("n"))


def top_predicates(spark: SparkSession, d: str) -> DataFrame:
    """The 40 commonest predicates, ties by the first triple."""
    g = table(spark, d, "triples").groupBy(F.lower("predicate.text").alias("predicate")).agg(F.count("*").alias("n"), F.min("ord").alias("first_ord"))
    return g.orderBy(F.desc("n"), "first_ord").limit(40)


def lookup_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Endpoint mentions by type, route and control mark, with and without an id."""
    t = table(spark, d, NORMALIZED).select(F.explode(F.array("subject", "object")).alias("e")).select("e.*")
    ids = F.when(F.col("type") == "GENETIC", F.col("hgnc_symbol")).when(F.col("type") == "DISEASE", F.col("mondo_label")).otherwise(F.col("chebi_label"))
    return t.groupBy("type", F.coalesce("hgnc_via", "mondo_via", "chebi_via").alias("via"), "control").agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.size(ids), F.lit(0)) > 0).alias("resolved"))


def symbol_stats(spark: SparkSession, d: str) -> DataFrame:
    """Mentions per gene symbol; an ambiguous mention counts in full for each symbol."""
    t = table(spark, d, NORMALIZED).select(F.explode(F.array("subject", "object")).alias("e")).where("e.type = 'GENETIC'")
    return t.select(F.explode(T.symbols(F.col("e.hgnc_symbol"))).alias("symbol")).groupBy("symbol").agg(F.count("*").alias("mentions"))


def term_stats(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, NORMALIZED).select(F.explode(F.array("subject", "object")).alias("e"))
    one = F.explode(F.concat(F.coalesce("e.mondo_label", F.array().cast("array<string>")), F.coalesce("e.chebi_label", F.array().cast("array<string>")))).alias("label")
    return t.select(F.col("e.type").alias("type"), one).groupBy("type", "label").agg(F.count("*").alias("mentions"))


def gene_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Triple ends looked up in three gene libraries in order of priority: symbols, then aliases, then former symbols."""
    from mentionmill.operators import linking as L

    h = table(spark, d, "hgnc")
    lib = lambda f: h.select(F.explode(f).alias("key"), F.col("symbol").alias("value"), "hgnc_id").select("key", "value", F.substring_index("hgnc_id", ":", -1).cast("bigint").alias("ord"))
    own = h.select(F.col("symbol").alias("key"), F.col("symbol").alias("value"), F.substring_index("hgnc_id", ":", -1).cast("bigint").alias("ord"))
    t = table(spark, d, "triples").select("ord", F.posexplode(F.array("subject", "object")).alias("side", "e")).where("e.type = 'GENETIC'")
    raw = L.FOLDS["as is"]
    x = L.lookup_cascade(t, F.col("e.text"), [("symbol", own, raw), ("alias", lib("alias_symbol"), raw), ("former", lib("prev_symbol"), raw), ("symbol (dash-normalized)", own, T.dash_normalize)])
    return x.select("ord", "side", F.col("e.text").alias("text"), F.col("value").alias("symbol"), "via")


def gene_gene_context(spark: SparkSession, d: str) -> DataFrame:
    """Gene-gene triples whose sentence also names a disease or chemical, with pair count, labels of the sentence and year."""
    sent = ["pmid", "_section", "sentence"]
    keyed = lambda df: df.withColumn("_section", F.coalesce("section", F.lit("")))
    base, t = keyed(table(spark, d, "triples")), keyed(table(spark, d, NORMALIZED))
    other = lambda n: F.col(f"{n}.type").isin("DISEASE", "CHEMICAL")
    context = base.where(other("subject") | other("object")).select(*sent).distinct()
    free = lambda n: (F.col(f"{n}.type") == "GENETIC") & F.col(f"{n}.hgnc_symbol").isNotNull() & (F.col(f"{n}.control") == "no") & ~F.coalesce(F.array_contains(f"{n}.hgnc_symbol", "MKI67"), F.lit(False))
    q = t.where(free("subject") & free("object")).select("ord", *sent, F.array_join("subject.hgnc_symbol", "|").alias("a"), F.array_join("object.hgnc_symbol", "|").alias("b"))
    q = q.join(context, sent, "left_semi")
    ends = t.select(*sent, F.explode(F.array("subject", "object")).alias("e")).join(q.select(*sent).distinct(), sent, "left_semi")
    named = lambda kind, via, c: F.array_sort(F.collect_set(F.when((F.col("e.type") == kind) & via & (F.size(c) > 0), F.array_join(c, "|"))))
    labels = ends.groupBy(*sent).agg(named("DISEASE", F.col("e.mondo_via") == "disease key", F.col("e.mondo_label")).alias("ds"), named("CHEMICAL", F.lit(True), F.col("e.chebi_label")).alias("cs"))
    years = table(spark, d, "pubs").where("pmc_id is not null").groupBy(F.col("pmc_id").alias("paper")).agg(F.min("year").alias("year"))
    x = R.pair_counts(q, "a", "b").join(labels, sent, "left").withColumn("paper", T.accession(F.col("pmid"))).join(years, "paper", "left")
    return x.select("ord", F.col("a").alias("genetic_subject"), F.col("b").alias("genetic_object"), "pair_count", F.array_join("ds", ";").alias("diseases"), F.array_join("cs", ";").alias("chemicals"), "year")


def entity_union(spark: SparkSession, d: str) -> DataFrame:
    """Mentions of a sentence as a set: the highest score per span, label and domain."""
    e = table(spark, d, "sentences").select("pmid", "text", F.explode("entities").alias("e")).where("e.start is not null and e.score >= 0.5 and e.text <> ''")
    x = e.select("pmid", F.md5("text").alias("digest"), "e.start", "e.end", "e.label", "e.domain", "e.text", "e.score")
    return R.entity_union(x, ["pmid", "digest"]).select("pmid", "digest", "start", "end", "label", "domain", "score")


def gazetteer(spark: SparkSession, d: str) -> DataFrame:
    """Drug names of one word and at least seven letters that a sentence holds without a mention of that name, once per sentence."""
    drugs = table(spark, d, "obo_term").where("id like 'CHEBI:%' and not coalesce(deprecated, false)").select(F.lower("label").alias("word")).where("word rlike '^[a-z]{7,}$'").distinct()
    s = table(spark, d, "sentences").select("pmid", "text", F.transform("entities", lambda e: F.lower(e["text"])).alias("known")).distinct()
    w = F.explode(F.array_distinct(F.array_except(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)), F.coalesce("known", F.array().cast("array<string>"))))).alias("word")
    return s.select("pmid", F.md5("text").alias("digest"), w).where("length(word) >= 7").join(drugs, "word", "left_semi").distinct().select("pmid", "digest", "word")


def inverse_targets(spark: SparkSession, d: str) -> DataFrame:
    """Per gene the chemicals stated with it, how many, and whether the gene is mentioned on its own in the corpus; most first."""
    t = table(spark, d, NORMALIZED)
    end = lambda a, b: F.when((F.col(f"{a}.type") == "GENETIC") & (F.col(f"{b}.type") == "CHEMICAL"), F.struct(T.single(F.col(f"{a}.hgnc_symbol")).alias("gene"), T.single(F.col(f"{b}.chebi_label")).alias("chemical")))
    p = t.select(F.coalesce(end("subject", "object"), end("object", "subject")).alias("p")).select("p.*").where("gene is not null and chemical is not null")
    g = p.groupBy("gene", "chemical").agg(F.count("*").alias("n")).groupBy("gene").agg(F.array_join(F.array_sort(F.collect_list("chemical")), ";").alias("chemicals"), F.count("*").alias("n_chemicals"))
    corpus = table(spark, d, "clean_genetic_ne").select(F.col("clean_genetic_ne").alias("gene")).distinct().withColumn("in_corpus", F.lit(True))
    x = g.join(corpus, "gene", "left").withColumn("in_corpus", F.coalesce("in_corpus", F.lit(False)))
    return x.orderBy(F.desc("in_corpus"), F.desc("n_chemicals"), "gene")


def top_surfaces(spark: SparkSession, d: str) -> DataFrame:
    """The 100 commonest surfaces by falling count, then by name."""
    return surface_counts(spark, d).orderBy(F.desc("occurrences"), "surface", "label").limit(100)


def top_symbols(spark: SparkSession, d: str) -> DataFrame:
    """The 40 gene symbols with the most mentions, ties by name without regard to case."""
    return symbol_stats(spark, d).orderBy(F.desc("mentions"), F.lower("symbol"), "symbol").limit(40)


def numeric_ids(spark: SparkSession, d: str) -> DataFrame:
    """The first 50 genes in the numeric order of their ids."""
    number = F.regexp_extract("hgnc_id", "([0-9]+)$", 1).try_cast("bigint")
    return table(spark, d, "hgnc").select("hgnc_id", number.alias("number")).orderBy("number", "hgnc_id").limit(50)


def all_articles(spark: SparkSession, d: str) -> DataFrame:
    """Articles of sentences, triples and publications, each once."""
    of = lambda t, c: table(spark, d, t).select(T.accession(F.col(c)).alias("article"))
    return of("sentences", "pmid").unionByName(of("triples", "pmid")).unionByName(of("pubs", "pmc_id")).where("article is not null").distinct()


def symbol_groups(spark: SparkSession, d: str) -> DataFrame:
    """Gene symbols by the groups they stand in: subjects, objects and listed surfaces."""
    of = lambda n: table(spark, d, NORMALIZED).where(f"{n}.type = 'GENETIC'").select(F.explode(T.symbols(F.col(f"{n}.hgnc_symbol"))).alias("symbol"), F.lit(n).alias("part"))
    surfaces = table(spark, d, "clean_genetic_ne").select(F.col("clean_genetic_ne").alias("symbol"), F.lit("surface").alias("part"))
    x = of("subject").unionByName(of("object")).unionByName(surfaces).where("symbol is not null")
    groups = x.groupBy("symbol").agg(F.array_join(F.array_sort(F.collect_set("part")), "|").alias("parts"))
    return groups.groupBy("parts").agg(F.count("*").alias("symbols"), F.min("symbol").alias("first"))


def set_operations(spark: SparkSession, d: str) -> DataFrame:
    """Genes of subjects against genes of objects: in both, only in one."""
    of = lambda n: table(spark, d, NORMALIZED).where(f"{n}.type = 'GENETIC'").select(F.explode(T.symbols(F.col(f"{n}.hgnc_symbol"))).alias("symbol"))
    a, b = of("subject"), of("object")
    tag = lambda df, s: df.withColumn("part", F.lit(s))
    return tag(a.intersect(b), "both").unionByName(tag(a.subtract(b), "subject only")).unionByName(tag(b.subtract(a), "object only"))


def result_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Sentences past the margin gate, the first of each text in an article; late repeats drop out."""
    s = table(spark, d, "sentences").where("sim_pos - sim_neg >= 0.01").select(T.accession(F.col("pmid")).alias("paper"), "text", "sent_ord", (F.col("sim_pos") - F.col("sim_neg")).alias("margin"))
    return s.groupBy("paper", "text").agg(F.min("sent_ord").alias("sent_ord"), F.max("margin").alias("margin")).select("paper", F.md5("text").alias("digest"), "sent_ord", scores.round4(F.col("margin")).alias("margin"))


QUERIES = {f.__name__: f for f in (surface_counts, repeated_surfaces, adjacent_triples, candidate_pairs, route_exclusive, route_additive, composite_scores, relation_stats, triple_stats, predicate_counts, top_predicates, lookup_coverage, symbol_stats, term_stats, gene_lookup, gene_gene_context, entity_union, gazetteer, inverse_targets, set_operations, top_surfaces, top_symbols, numeric_ids, all_articles, symbol_groups, result_sentences)}

_SURFACES = f"select label, {dash('text')} as surface, sum(n)::bigint as occurrences, count(*) as n_source_forms from (select e.label as label, e.text as text, count(*) as n from (select unnest(entities) as e from sentences) group by all) group by all"

_ORDERED = """
placed as (
  select rid, pmid, section_type as section, text as sentence, e.text as etext, e.label as elabel, e.score as escore, e."start" as s, e."end" as t, pos
  from (select row_number() over () as rid, pmid, section_type, text, unnest(entities) as e, generate_subscripts(entities, 1) as pos from sentences)
  where e."start" is not null and e."end" is not null)
"""
_CUE = R.RELATION_CUE.replace("'", "''")


def _entity_text(label: str, text: str) -> str:
    return f"case when {label} = 'GENETIC' then {dash(text)} else {text} end"


_SQUEEZE = "trim(regexp_replace({0}, '[\\s\\x{{a0}}\\x{{2000}}-\\x{{200a}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+', ' ', 'g'))"
_ADJACENT = f"""
with {_ORDERED},
nxt as (
  select *, lead(etext) over w as btext, lead(elabel) over w as blabel, lead(s) over w as bs from placed window w as (partition by rid order by s, pos)),
pred as (select *, {_SQUEEZE.format("case when bs > t then substr(sentence, t + 1, bs - t) else '' end")} as predicate from nxt where bs is not null)
select {_entity_text('elabel', 'etext')} as subject_text, elabel as subject_type, predicate, {_entity_text('blabel', 'btext')} as object_text, blabel as object_type, pmid, section, sentence
from pred where predicate <> '' and length(predicate) <= 120 and regexp_matches(predicate, '[A-Za-z]') and regexp_matches(predicate, '{_CUE}')"""

_NEG, _SPEC = ["(?i)" + x.replace("'", "''") for x in (R.NEGATION, R.SPECULATION)]
# word boundaries in RE2 know ASCII letters only, so other letters are made some letter first
_PAIRS = f"""
with {_ORDERED},
both_ends as (
  select a.pmid, a.sentence, a.etext as ax, a.elabel as al, a.s as as_, a.t as at_, b.etext as bx, b.elabel as bl, b.s as bs, b.t as bt,
    case when b.t + 30 > greatest(0, a.s - 40) then regexp_replace(substr(a.sentence, greatest(0, a.s - 40) + 1, b.t + 30 - greatest(0, a.s - 40)), '[\\p{{Greek}}\\p{{Cyrillic}}À-ÖØ-öø-ɏ０-９Ａ-Ｚａ-ｚ]', 'q', 'g') else '' end as region
  from placed a join placed b on a.rid = b.rid and (a.s < b.s or (a.s = b.s and a.pos < b.pos)) and b.s >= a.t and b.s - a.t <= 300),
cues as (select *, list_transform(regexp_extract_all(region, '{_NEG}'), lambda x: lower(x)) as neg, list_transform(regexp_extract_all(region, '{_SPEC}'), lambda x: lower(x)) as spec from both_ends)
select concat_ws(':', pmid, left(md5(sentence), 8), as_ || '-' || at_, bs || '-' || bt) as pair_id, {_entity_text('al', 'ax')} as subject_text, {_entity_text('bl', 'bx')} as object_text,
  case when al = bl then al else concat_ws('-', least(al, bl), greatest(al, bl)) end as type_pair, {_SQUEEZE.format("case when bs > at_ then substr(sentence, at_ + 1, bs - at_) else '' end")} as connecting,
  case when len(neg) > 0 then 'negated' else 'positive' end as polarity, case when len(spec) > 0 then 'speculated' else 'asserted' end as modality,
  array_to_string(list_sort(list_distinct(list_concat(neg, spec))), '|') as cues, al = bl and {_entity_text('al', 'ax')} = {_entity_text('bl', 'bx')} as self_pair,
  substr(sentence, 1, as_) || '@' || case al when 'GENETIC' then 'GENE' else al end || '$' || substr(sentence, at_ + 1, bs - at_) || '@' || case bl when 'GENETIC' then 'GENE' else bl end || '$' || substr(sentence, bt + 1) as blinded
from cues"""

_ROUTES = "(values " + ", ".join(f"({'null' if t is None else repr(t)}, {m!r}, {p})" for t, m, p in ROUTES) + ") as r(type_pair, model, precedence)"
_PAIR_TYPES = f"""
with {_ORDERED},
pairs as (
  select row_number() over () as pid, case when a.elabel = b.elabel then a.elabel else concat_ws('-', least(a.elabel, b.elabel), greatest(a.elabel, b.elabel)) end as type_pair
  from placed a join placed b on a.rid = b.rid and (a.s < b.s or (a.s = b.s and a.pos < b.pos)) and b.s >= a.t and b.s - a.t <= 300)
"""
_EXCLUSIVE = f"""{_PAIR_TYPES}, routed as (select pairs.type_pair, r.model, row_number() over (partition by pid order by precedence, r.model) as k from pairs join {_ROUTES} on r.type_pair is null or r.type_pair = pairs.type_pair)
select type_pair, model, count(*) as pairs from routed where k = 1 group by all"""
_ADDITIVE = f"{_PAIR_TYPES}, routed as (select distinct pid, pairs.type_pair, r.model from pairs join {_ROUTES} on r.type_pair is null or r.type_pair = pairs.type_pair) select type_pair, model, count(*) as pairs from routed group by all"

_COMPOSITE = f"""
select ord, composite from (
  select ord, round(least(1.0, coalesce(predicate.score_calibrated, predicate.score) * least(coalesce(nullif(subject.score, 0), 1.0), coalesce(nullif("object".score, 0), 1.0))
    * case when regexp_matches(sentence, '{_CUE}') then 1.0::double else 0.85::double end * 1.0::double
    * case when regexp_matches(lower(coalesce(section, '')), 'result|abstract|figure') then 1.0::double when lower(section) like '%discussion%' then 0.97::double when lower(section) like '%intro%' then 0.9::double else 0.95::double end
    * case when coalesce(self_pair, false) and lower(coalesce(predicate.text, '')) not in ('interacts', 'binds', 'phosphorylates', 'dimerizes', 'oligomerizes') then 0.5::double else 1.0::double end) * 10000.0::double) / 10000.0::double as composite
  from triples_re where predicate is not null) where composite >= 0.5"""

_ENDS = "(select unnest([subject, \"object\"]) as e from triples_genetic_disease_chemical_normalized)"
_SYMBOLS = "(select distinct rid, kind, trim(u) as symbol from (select rid, kind, unnest(string_split(one, '|')) as u from (select rid, kind, unnest(ids) as one from (select row_number() over () as rid, kind, ids from {0}))) where trim(u) <> '')"
_KEYED = """
base as (select distinct pmid, coalesce(section, '') as sec, sentence from triples where subject.type in ('DISEASE', 'CHEMICAL') or "object".type in ('DISEASE', 'CHEMICAL')),
norm as (select *, coalesce(section, '') as sec from triples_genetic_disease_chemical_normalized),
q as (
  select ord, pmid, sec, sentence, array_to_string(subject.hgnc_symbol, '|') as a, array_to_string("object".hgnc_symbol, '|') as b from norm semi join base using (pmid, sec, sentence)
  where subject.type = 'GENETIC' and "object".type = 'GENETIC' and subject.hgnc_symbol is not null and "object".hgnc_symbol is not null and subject.control = 'no' and "object".control = 'no'
    and not list_contains(subject.hgnc_symbol, 'MKI67') and not list_contains("object".hgnc_symbol, 'MKI67')),
labels as (
  select pmid, sec, sentence, array_to_string(list_sort(list(distinct array_to_string(e.mondo_label, '|')) filter (where e.type = 'DISEASE' and e.mondo_via = 'disease key' and len(e.mondo_label) > 0)), ';') as ds,
    array_to_string(list_sort(list(distinct array_to_string(e.chebi_label, '|')) filter (where e.type = 'CHEMICAL' and len(e.chebi_label) > 0)), ';') as cs
  from (select pmid, sec, sentence, unnest([subject, "object"]) as e from norm) group by pmid, sec, sentence)
"""

SQL = {
    "surface_counts": _SURFACES,
    "top_surfaces": f"select * from ({_SURFACES}) order by occurrences desc, surface, label limit 100",
    "top_symbols": "select * from (select symbol, count(*) as mentions from " + _SYMBOLS.format(f"(select e.type as kind, e.hgnc_symbol as ids from {_ENDS} where e.type = 'GENETIC')") + " group by symbol) order by mentions desc, lower(symbol), symbol limit 40",
    "numeric_ids": "select hgnc_id, try_cast(regexp_extract(hgnc_id, '([0-9]+)$', 1) as bigint) as number from hgnc order by number, hgnc_id limit 50",
    "all_articles": "select split_part(pmid, '.', 1) as article from sentences where pmid is not null union select split_part(pmid, '.', 1) from triples where pmid is not null union select split_part(pmc_id, '.', 1) from pubs where pmc_id is not null",
    "symbol_groups": """with x as (select distinct trim(s) as symbol, part from (
  select unnest(string_split(u, '|')) as s, part from (select unnest(subject.hgnc_symbol) as u, 'subject' as part from triples_genetic_disease_chemical_normalized where subject.type = 'GENETIC'
    union all select unnest("object".hgnc_symbol), 'object' from triples_genetic_disease_chemical_normalized where "object".type = 'GENETIC')) where trim(s) <> ''
  union select clean_genetic_ne, 'surface' from clean_genetic_ne where clean_genetic_ne is not null),
g as (select symbol, array_to_string(list_sort(list(part)), '|') as parts from x group by symbol)
select parts, count(*) as symbols, min(symbol) as first from g group by parts""",
    "repeated_surfaces": f"select * from ({_SURFACES}) where occurrences > 1",
    "adjacent_triples": _ADJACENT,
    "candidate_pairs": _PAIRS,
    "route_exclusive": _EXCLUSIVE,
    "route_additive": _ADDITIVE,
    "composite_scores": _COMPOSITE,
    "relation_stats": "select case when subject.type = \"object\".type then subject.type else concat_ws('-', least(subject.type, \"object\".type), greatest(subject.type, \"object\".type)) end as type_pair, predicate.model as model, predicate.text as label, polarity, modality, (floor(score * 10) * 10)::int as decile, count(*) as n from triples_re where score between 0 and 1 group by all",
    "triple_stats": "select subject_type, object_type, section, count(*) as n, count(distinct paper) as papers from (select subject.type as subject_type, \"object\".type as object_type, coalesce(section, '(none)') as section, split_part(pmid, '.', 1) as paper from triples) group by grouping sets ((subject_type, object_type), (section))",
    "predicate_counts": "select lower(predicate.text) as predicate, count(*) as n from triples group by all",
    "top_predicates": "select lower(predicate.text) as predicate, count(*) as n, min(ord) as first_ord from triples group by 1 order by n desc, first_ord limit 40",
    "lookup_coverage": f"select e.type as type, coalesce(e.hgnc_via, e.mondo_via, e.chebi_via) as via, e.control as control, count(*) as n, count(*) filter (where len(case e.type when 'GENETIC' then e.hgnc_symbol when 'DISEASE' then e.mondo_label else e.chebi_label end) > 0) as resolved from {_ENDS} group by all",
    "symbol_stats": "select symbol, count(*) as mentions from " + _SYMBOLS.format(f"(select e.type as kind, e.hgnc_symbol as ids from {_ENDS} where e.type = 'GENETIC')") + " group by symbol",
    "term_stats": f"select type, label, count(*) as mentions from (select e.type as type, unnest(list_concat(coalesce(e.mondo_label, []), coalesce(e.chebi_label, []))) as label from {_ENDS}) group by all",
    "gene_lookup": f"""
with lib as (
  select 0 as i, 'symbol' as via, symbol as key, min_by(symbol, split_part(hgnc_id, ':', 2)::bigint) as value from hgnc group by symbol
  union all select 1, 'alias', key, min_by(symbol, o) from (select unnest(alias_symbol) as key, symbol, split_part(hgnc_id, ':', 2)::bigint as o from hgnc) group by key
  union all select 2, 'former', key, min_by(symbol, o) from (select unnest(prev_symbol) as key, symbol, split_part(hgnc_id, ':', 2)::bigint as o from hgnc) group by key),
ends as (select ord, unnest([0, 1]) as side, unnest([subject, "object"]) as e from triples),
tries as (
  select ord, side, e.text as text, lib.i, lib.via, lib.value from ends join lib on lib.key = e.text where e.type = 'GENETIC'
  union all select ord, side, e.text, 3, 'symbol (dash-normalized)', lib.value from ends join lib on lib.i = 0 and lib.key = {dash('e.text')} where e.type = 'GENETIC'),
best as (select *, row_number() over (partition by ord, side order by i) as r from tries)
select ends.ord, ends.side, ends.e.text as text, best.value as symbol, best.via as via from ends left join best on best.ord = ends.ord and best.side = ends.side and best.r = 1 where ends.e.type = 'GENETIC'""",
    "gene_gene_context": f"""
with {_KEYED}, counts as (select a, b, count(*) as pair_count from q group by a, b), years as (select pmc_id, min(year) as year from pubs where pmc_id is not null group by pmc_id)
select ord, q.a as genetic_subject, q.b as genetic_object, pair_count, coalesce(ds, '') as diseases, coalesce(cs, '') as chemicals, year
from q join counts using (a, b) left join labels using (pmid, sec, sentence) left join years on years.pmc_id = split_part(pmid, '.', 1)""",
    "entity_union": "select pmid, digest, \"start\", \"end\", label, domain, max(score) as score from (select pmid, md5(text) as digest, e.\"start\" as \"start\", e.\"end\" as \"end\", e.label as label, e.domain as domain, e.score as score from (select pmid, text, unnest(entities) as e from sentences) where e.\"start\" is not null and e.score >= 0.5 and e.text <> '') group by all",
    "gazetteer": """
with drugs as (select distinct lower(label) as word from obo_term where id like 'CHEBI:%' and not coalesce(deprecated, false) and regexp_matches(lower(label), '^[a-z]{7,}$')),
s as (select distinct pmid, text, list_transform(entities, lambda e: lower(e.text)) as known from sentences),
w as (select pmid, md5(text) as digest, known, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) as word from s)
select distinct pmid, digest, word from w semi join drugs using (word) where length(word) >= 7 and not coalesce(list_contains(known, word), false)""",
    "inverse_targets": """
with p as (
  select case when subject.type = 'GENETIC' then subject.hgnc_symbol else "object".hgnc_symbol end as g, case when subject.type = 'GENETIC' then "object".chebi_label else subject.chebi_label end as c
  from triples_genetic_disease_chemical_normalized where (subject.type = 'GENETIC' and "object".type = 'CHEMICAL') or (subject.type = 'CHEMICAL' and "object".type = 'GENETIC')),
one as (select distinct trim(g[1]) as gene, trim(c[1]) as chemical from p where len(g) = 1 and len(c) = 1 and trim(g[1]) <> '' and trim(c[1]) <> '')
select gene, array_to_string(list_sort(list(chemical)), ';') as chemicals, count(*) as n_chemicals, gene in (select clean_genetic_ne from clean_genetic_ne) as in_corpus from one group by gene""",
    "set_operations": """
with s as (select distinct trim(unnest(string_split(u, '|'))) as symbol from (select unnest(subject.hgnc_symbol) as u from triples_genetic_disease_chemical_normalized where subject.type = 'GENETIC')),
o as (select distinct trim(unnest(string_split(u, '|'))) as symbol from (select unnest("object".hgnc_symbol) as u from triples_genetic_disease_chemical_normalized where "object".type = 'GENETIC'))
select symbol, 'both' as part from (select symbol from s intersect select symbol from o) union all select symbol, 'subject only' from (select symbol from s except select symbol from o)
union all select symbol, 'object only' from (select symbol from o except select symbol from s)""",
    "result_sentences": "select split_part(pmid, '.', 1) as paper, md5(text) as digest, min(sent_ord) as sent_ord, round(max(sim_pos - sim_neg) * 10000.0::double) / 10000.0::double as margin from sentences where sim_pos - sim_neg >= 0.01::double group by paper, text",
}
