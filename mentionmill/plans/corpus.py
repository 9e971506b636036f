"""Queries of the corpus stage, text filters, vectors and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionmill.functions import scores
from mentionmill.functions import text as T
from mentionmill.operators import corpus as C
from mentionmill.operators import evaluate as E
from mentionmill.operators import graph as G
from mentionmill.operators import segment as S
from mentionmill.plans.graphs import GATE, TYPED
from mentionmill.session import table


def selected_articles(spark: SparkSession, d: str) -> DataFrame:
    """Articles at or above the 90th article-weighted percentile of impact."""
    return C.selected(table(spark, d, "pubs"), 0.9).select("pmid", "pmc_id", "journal", "impact_factor", "year")


def impact_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of impact by index."""
    p = table(spark, d, "pubs")
    ps = [0.0, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
    return spark.createDataFrame(list(zip(ps, C.index_percentiles(p, "impact_factor", ps), strict=True)), "p double, impact double")


def key_fallback_join(spark: SparkSession, d: str) -> DataFrame:
    """Articles with the impact of their ISSN, else of their journal's name; a listed key without a value ends the search."""
    p = table(spark, d, "pubs")
    by = lambda k: p.where(f"{k} is not null").groupBy(F.concat(F.lit(f"{k}:"), F.col(k)).alias("key")).agg(F.max("impact_factor").alias("impact"))
    keys = [F.concat(F.lit(f"{k}:"), F.col(k)) for k in ("issn", "journal")]
    x = C.with_fallback(p, keys, by("issn").unionByName(by("journal")), "key", "impact", "impact")
    return x.select("pmid", "journal", "issn", F.unix_micros("added_at").alias("added"), "impact_factor", "impact")


def source_preferred_union(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of the TEI form of an article where it exists, else of the other."""
    s = table(spark, d, "sentences").select(T.without_scheme(F.col("pmid")).alias("article"), F.col("pmid").endswith(".grobid.tei").alias("tei"), "sent_ord", F.md5("text").alias("digest"))
    return C.preferred_union(s.where("tei"), s.where("not tei"), "article")


def default_category_join(spark: SparkSession, d: str) -> DataFrame:
    """Documents by the journal of their article, or unknown."""
    one = table(spark, d, "pubs").where("pmc_id is not null").groupBy(F.col("pmc_id").alias("article")).agg(F.min("journal").alias("journal"))
    x = table(spark, d, "documents").select(T.accession(F.col("pmid")).alias("article")).join(one, "article", "left")
    return x.groupBy(F.coalesce("journal", F.lit("unknown")).alias("journal")).agg(F.count("*").alias("documents"))


def pubs_by_year(spark: SparkSession, d: str) -> DataFrame:
    """Articles per year and per decade, with those that have a PMC id."""
    p = table(spark, d, "pubs").select("year", (F.floor(F.col("year") / 10) * 10).cast("int").alias("decade"), "pmc_id")
    return p.groupingSets([["decade", "year"], ["decade"], []], "decade", "year").agg(F.grouping_id().alias("level"), F.count("*").alias("articles"), F.count("pmc_id").alias("in_pmc"))


def impact_bands(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pubs").where("impact_factor is not null").groupBy(C.impact_band(F.col("impact_factor")).alias("band")).agg(F.count("*").alias("articles"))


def top_journals(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pubs").where("journal is not null").groupBy("journal").agg(F.count("*").alias("articles")).orderBy(F.desc("articles"), "journal").limit(25)


def uncached_articles(spark: SparkSession, d: str) -> DataFrame:
    """Articles of the triples that the list of publications lacks."""
    need = table(spark, d, "triples").select(T.accession(F.col("pmid")).alias("article")).distinct()
    return need.join(table(spark, d, "pubs").select(F.col("pmc_id").alias("article")), "article", "left_anti")


def format_stats(spark: SparkSession, d: str) -> DataFrame:
    """Per form of the article: sentences, articles, entities, and sentences with a cue."""
    s = table(spark, d, "sentences").select(F.when(F.col("pmid").endswith(".grobid.tei"), "tei").otherwise("jats").alias("format"), "pmid", F.size(F.coalesce("entities", F.array().cast("array<struct<text:string,label:string,domain:string,score:double,start:int,end:int>>"))).alias("n"), "cues")
    return s.groupBy("format").agg(F.count("*").alias("sentences"), F.countDistinct("pmid").alias("articles"), F.sum("n").alias("entities"), F.count_if(F.size("cues") > 0).alias("with_cue"))


def format_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Section types against the two forms of articles, with totals."""
    s = table(spark, d, "sentences").select(F.coalesce("section_type", F.lit("(none)")).alias("section_type"), F.when(F.col("pmid").endswith(".grobid.tei"), "tei").otherwise("jats").alias("format"))
    return s.groupBy("section_type").pivot("format", ["jats", "tei"]).count().select("section_type", F.coalesce("jats", F.lit(0)).alias("jats"), F.coalesce("tei", F.lit(0)).alias("tei"), (F.coalesce("jats", F.lit(0)) + F.coalesce("tei", F.lit(0))).alias("total"))


def doc_frequency_titles(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sentences").where("section_title is not null")
    return C.document_frequency(s, T.accession(F.col("pmid")), F.col("section_title"))


def section_types(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sentences").groupBy(T.section_type(F.col("section_type")).alias("section_type")).agg(F.count("*").alias("n"))


def sentence_filter(spark: SparkSession, d: str) -> DataFrame:
    """Sentences by whether they pass the surface filter and speak of earlier work."""
    s = table(spark, d, "sentences").select("pmid", "sent_ord", F.md5("text").alias("digest"), S.is_sentence(F.col("text")).alias("is_sentence"), S.is_prior(F.col("text")).alias("is_prior"))
    return s


def cue_tags(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "sentences").select("pmid", "sent_ord", F.md5("text").alias("digest"), F.array_join(S.cues(F.col("text")), "|").alias("cues"))
    return x.where("cues <> ''")


def sentence_split(spark: SparkSession, d: str) -> DataFrame:
    """Documents through the simple splitter, which is made for English but takes any text."""
    x = table(spark, d, "documents").select("doc_id", F.posexplode(S.split(F.col("text"))).alias("place", "sentence"))
    return x.select("doc_id", "place", F.md5("sentence").alias("digest"), F.length("sentence").alias("n_chars"))


def centroid_margin(spark: SparkSession, d: str) -> DataFrame:
    """Cosine of each vector to the centroid of label 0 less that to the centroid of label 1, where it is at least 0.01."""
    e = table(spark, d, "embeddings")
    zero, one = (scores.centroid(e.where(F.col("label") == k), "embedding") for k in (0, 1))
    x = e.select("vec_id", "label", (scores.cosine(F.col("embedding"), zero) - scores.cosine(F.col("embedding"), one)).alias("margin"))
    return x.where("margin >= 0.01").select("vec_id", "label", F.round("margin", 6).alias("margin"))


def _judged(spark, d):
    """Pairs that two models scored: the typed label as gold, the other's as prediction."""
    x = G.compared_verdicts(table(spark, d, "triples_re"), TYPED, GATE).where("side = 'both' and score_b between 0 and 1")
    text = lambda c: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("no_relation"))
    return x.select("key", text("label_a").alias("gold"), text("label_b").alias("pred"), F.col("score_b").alias("p"))


def confusion(spark: SparkSession, d: str) -> DataFrame:
    return E.confusion(_judged(spark, d), "gold", "pred")


def micro_scores(spark: SparkSession, d: str) -> DataFrame:
    return E.micro_scores(_judged(spark, d), "gold", "pred", "no_relation").select("tp", "fp", "fn", "n", "right", F.round("f1", 6).alias("f1"))


def _agreed(spark, d):
    positive = F.col("gold") != "no_relation"
    return _judged(spark, d).select(F.col("p"), positive.alias("hit"), (positive & (F.col("pred") != "no_relation")).alias("right"))


def calibration_error(spark: SparkSession, d: str) -> DataFrame:
    return E.calibration_error(_agreed(spark, d), "p", "hit").select(F.round("ece", 6).alias("ece"))


def best_threshold(spark: SparkSession, d: str) -> DataFrame:
    return E.best_threshold(_agreed(spark, d), "p", "hit", "right").select("threshold", F.round("f1", 6).alias("f1"))


def calibrators(spark: SparkSession, d: str) -> DataFrame:
    """An isotonic calibrator per model, fitted on agreement with the typed model."""
    x = _agreed(spark, d).withColumn("model", F.lit(GATE))
    return E.fitted(x, "model", "p", "hit").select("group", "method", F.size("x").alias("points"), F.array_min("y").alias("lowest"), F.array_max("y").alias("highest"))


def calibrated(spark: SparkSession, d: str) -> DataFrame:
    """Stored verdicts with a logistic and a piecewise linear calibration."""
    x = table(spark, d, "triples_re").where("predicate.score between 0 and 1").select("ord", F.col("predicate.score").alias("p"))
    return x.select("ord", F.round(scores.platt(F.col("p"), 1.2, -0.1), 9).alias("platt"), F.round(scores.interpolated(F.col("p"), [0.0, 0.5, 0.9, 1.0], [0.1, 0.4, 0.85, 0.97]), 9).alias("linear"))


def triple_schema(spark: SparkSession, d: str) -> DataFrame:
    """Fields of the ends of normalized triples: in how many rows each is present, empty or absent."""
    e = table(spark, d, "triples_genetic_disease_chemical_normalized").select(F.explode(F.array("subject", "object")).alias("e")).select("e.*")
    state = lambda c, kind: F.when(F.col(c).isNull(), "absent").when((F.size(c) == 0) if kind.startswith("array") else F.lit(False), "empty").otherwise("present")
    each = F.array(*[F.struct(F.lit(c).alias("field"), F.lit(kind).alias("type"), state(c, kind).alias("state")) for c, kind in e.dtypes])
    return e.select(F.explode(each).alias("f")).select("f.*").groupBy("field", "type", "state").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (selected_articles, impact_percentiles, key_fallback_join, source_preferred_union, default_category_join, pubs_by_year, impact_bands, top_journals, uncached_articles, format_stats, format_pivot, doc_frequency_titles, section_types, sentence_filter, cue_tags, sentence_split, centroid_margin, confusion, micro_scores, calibration_error, best_threshold, calibrators, calibrated, triple_schema)}

_SPACE = "[\\s\\x{a0}\\x{2000}-\\x{200a}\\x{202f}\\x{205f}\\x{3000}]+"
_TRIMMED = "trim(text)"
_ALPHA = "length(regexp_replace(s, '[^\\p{L}]', '', 'g'))::double / nullif(length(regexp_replace(s, '[\\s\\x{a0}\\x{2000}-\\x{200a}\\x{202f}\\x{205f}\\x{3000}]', '', 'g')), 0)"


def _q(p: str) -> str:
    return p.replace("'", "''")


_KEY = "coalesce(pair_id, concat_ws(chr(1), pmid, sentence, subject.text, \"object\".text))"
_JUDGED = f"""
x as (select {_KEY} as key, ord, predicate.model as model, coalesce(nullif(trim(predicate.text), ''), 'no_relation') as label, case when isnan(score) then 0 else coalesce(score, 0) end as score from triples_re where predicate.model in ('{TYPED}', '{GATE}')),
per as (select * from (select *, row_number() over (partition by key, model order by score desc, ord) as r from x) where r = 1),
judged as (select a.key, a.label as gold, b.label as pred, b.score as p from per a join per b on a.key = b.key and a.model = '{TYPED}' and b.model = '{GATE}' where b.score between 0 and 1),
agreed as (select p, gold <> 'no_relation' as hit, gold <> 'no_relation' and pred <> 'no_relation' as right_ from judged)
"""
_START = "(^|[^\\p{L}\\p{N}_])"  # a word's start; RE2's own knows ASCII letters only
_SPLIT = f"trim(regexp_replace(text, '{_SPACE}', ' ', 'g'))"
for _p, _r, _n in (("([0-9])\\.([0-9])", "\\1\x02\\2", 2), (f"(?i){_START}({'|'.join(S.ABBREVIATIONS)})\\.", "\\1\\2\x02", 2), (f"{_START}([A-Z])\\.", "\\1\\2\x02", 2)):
    for _ in range(_n):  # twice, as one match may take the start of the next
        _SPLIT = f"regexp_replace({_SPLIT}, '{_p}', '{_r}', 'g')"
_MEANS = "select label, i, avg(v::double) as m from (select label, unnest(embedding) as v, generate_subscripts(embedding, 1) as i from embeddings where label in (0, 1)) group by label, i"

# word boundaries in RE2 know ASCII letters only, so other letters are made some letter first
_LETTERS = "regexp_replace(text, '[\\p{Greek}\\p{Cyrillic}À-ÖØ-öø-ɏ０-９Ａ-Ｚａ-ｚ]', 'q', 'g')"

SQL = {
    "selected_articles": "select pmid, pmc_id, journal, impact_factor, year from pubs where pmc_id is not null and trim(pmc_id) <> '' and impact_factor >= (select impact_factor from (select impact_factor, row_number() over (order by impact_factor) as r, count(*) over () as n from pubs where impact_factor is not null) where r = least(n - 1, floor(0.9::double * n)) + 1)",
    "impact_percentiles": "select p, impact_factor as impact from (select impact_factor, row_number() over (order by impact_factor) as r, count(*) over () as n from pubs where impact_factor is not null) join (values (0.0::double), (0.25), (0.5), (0.75), (0.9), (0.99), (1.0)) v(p) on r = least(n - 1, floor(p * n)) + 1",
    "key_fallback_join": """
with i as (select issn, max(impact_factor) as impact from pubs where issn is not null group by issn), j as (select journal, max(impact_factor) as impact from pubs where journal is not null group by journal)
select pmid, p.journal, p.issn, epoch_us(added_at) as added, impact_factor, case when i.issn is not null then i.impact else j.impact end as impact from pubs p left join i on i.issn = p.issn left join j on j.journal = p.journal""",
    "source_preferred_union": """
with s as (select regexp_replace(pmid, '\\.grobid\\.tei$', '') as article, pmid like '%.grobid.tei' as tei, sent_ord, md5(text) as digest from sentences)
select * from s where tei union all select * from s where not tei and article not in (select article from s where tei)""",
    "default_category_join": "select coalesce(journal, 'unknown') as journal, count(*) as documents from documents left join (select pmc_id, min(journal) as journal from pubs where pmc_id is not null group by pmc_id) p on p.pmc_id = split_part(documents.pmid, '.', 1) group by 1",
    "pubs_by_year": "select decade, year, grouping(decade, year) as level, count(*) as articles, count(pmc_id) as in_pmc from (select year, (floor(year / 10) * 10)::int as decade, pmc_id from pubs) group by grouping sets ((decade, year), (decade), ())",
    "impact_bands": "select case when impact_factor < 0 then null when impact_factor < 1 then '0-1' when impact_factor < 2 then '1-2' when impact_factor < 3 then '2-3' when impact_factor < 5 then '3-5' when impact_factor < 10 then '5-10' when impact_factor < 20 then '10-20' when impact_factor < 50 then '20-50' else '50+' end as band, count(*) as articles from pubs where impact_factor is not null group by 1",
    "top_journals": "select journal, count(*) as articles from pubs where journal is not null group by 1 order by articles desc, journal limit 25",
    "uncached_articles": "select distinct split_part(pmid, '.', 1) as article from triples where split_part(pmid, '.', 1) not in (select pmc_id from pubs where pmc_id is not null)",
    "format_stats": "select case when pmid like '%.grobid.tei' then 'tei' else 'jats' end as format, count(*) as sentences, count(distinct pmid) as articles, sum(coalesce(len(entities), 0))::bigint as entities, count(*) filter (where len(cues) > 0) as with_cue from sentences group by 1",
    "format_pivot": "select coalesce(section_type, '(none)') as section_type, count(*) filter (where pmid not like '%.grobid.tei') as jats, count(*) filter (where pmid like '%.grobid.tei') as tei, count(*) as total from sentences group by 1",
    "doc_frequency_titles": """
with x as (select split_part(pmid, '.', 1) as doc, trim(regexp_replace(section_title, '^(\\d+(\\.\\d+)*\\.?|[IVXLC]+\\.)\\s+', '')) as shown from sentences where section_title is not null),
k as (select doc, regexp_replace(lower(shown), '^[ .:;-]+|[ .:;-]+$', '', 'g') as key, shown from x)
select key, min_by(shown, {'small': not regexp_matches(left(shown, 1), '\\p{Lu}'), 'shown': shown}) as display, count(distinct doc) as docs from k where key <> '' group by key""",
    "section_types": "select coalesce(array_to_string(list_sort(list_filter(list_transform(string_split(regexp_replace(replace(replace(lower(trim(section_type)), '-', ' '), '_', ' '), '\\s*(\\band\\b|&|/|\\+|\\||,)\\s*', '|', 'g'), '|'), lambda p: trim(regexp_replace(p, '\\s+', ' ', 'g'))), lambda p: p <> '')), '|'), '') as section_type, count(*) as n from sentences group by 1",
    "sentence_filter": f"""
select pmid, sent_ord, md5(text) as digest, coalesce(length(s) >= 25 and len(list_filter(regexp_split_to_array(s, '{_SPACE}'), lambda w: w <> '')) >= 4 and {_ALPHA} >= 0.5 and len(regexp_extract_all(s, '[A-Za-z]{{2,}}')) >= 2
  and regexp_matches(s, '[.!?]["’”)\\]]*$') and regexp_matches(s, '^["“(\\[A-Z0-9]') and regexp_matches(s, '\\p{{Ll}}'), false) as is_sentence,
  coalesce(regexp_matches(text, '(?i){_q('|'.join(S.REFERENCES))}') or regexp_matches(text, '(?i)\\b(?:{_q('|'.join(S.PRIOR_WORK))})\\b'), false) as is_prior from (select *, {_TRIMMED} as s from sentences)""",
    "cue_tags": "select * from (select pmid, sent_ord, md5(text) as digest, concat_ws('|', " + ", ".join(f"case when regexp_matches({_LETTERS}, '(?i){_q(p)}') then '{n}' end" for n, p in S.CUES.items()) + ") as cues from sentences) where cues <> ''",
    "sentence_split": f"""
with cut as (select doc_id, string_split(regexp_replace(regexp_replace({_SPLIT}, '([.!?]) (["“(\\[]?[A-Z0-9])', '\\1\x03\\2', 'g'), '([.!?]) (["“(\\[]?[A-Z0-9])', '\\1\x03\\2', 'g'), '\x03') as parts from documents),
kept as (select doc_id, list_filter(list_transform(parts, lambda p: trim(replace(p, '\x02', '.'))), lambda p: p <> '') as parts from cut)
select doc_id, place - 1 as place, md5(sentence) as digest, length(sentence) as n_chars from (select doc_id, unnest(parts) as sentence, generate_subscripts(parts, 1) as place from kept)""",
    "centroid_margin": f"""
with m as ({_MEANS}), c as (select label, list(m order by i) as c from m group by label),
x as (select vec_id, e.label as label, list_cosine_similarity(list_transform(embedding, lambda v: v::double), (select c from c where label = 0)) - list_cosine_similarity(list_transform(embedding, lambda v: v::double), (select c from c where label = 1)) as margin from embeddings e)
select vec_id, label, round(margin, 6) as margin from x where margin >= 0.01""",
    "confusion": f"with {_JUDGED} select gold, pred, count(*) as n from judged group by all",
    "micro_scores": f"with {_JUDGED}, t as (select count(*) filter (where gold = pred and pred <> 'no_relation') as tp, count(*) filter (where gold <> pred and pred <> 'no_relation') as fp, count(*) filter (where gold <> pred and gold <> 'no_relation') as fn, count(*) as n, count(*) filter (where gold = pred) as \"right\" from judged) select *, round(coalesce(2.0::double * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1 from t",
    "calibration_error": f"with {_JUDGED}, b as (select greatest(1, ceil(p * 10)) as bin, count(*) as n, avg(p) as conf, avg(hit::int::double) as acc from agreed group by 1) select round(coalesce(sum(n * abs(acc - conf)) / sum(n), 0), 6) as ece from b",
    "best_threshold": f"""with {_JUDGED}, a as (select p as t, count(*) as n, count(*) filter (where right_) as tp, count(*) filter (where hit) as pos from agreed group by 1),
f as (select t, sum(tp) over w as hit, sum(n) over w as called, sum(pos) over () as pos from a window w as (order by t desc)),
g as (select t as threshold, coalesce(2.0::double * hit / nullif(called + pos, 0), 0) as f1 from f union all select 0.0::double, f1 from (select coalesce(2.0::double * hit / nullif(called + pos, 0), 0) as f1 from f order by t limit 1))
select threshold, round(f1, 6) as f1 from g order by g.f1 desc, threshold limit 1""",
    "calibrated": "select ord, round(1.0::double / (1.0::double + exp(-(1.2::double * ln(q / (1.0::double - q)) + -0.1::double))), 9) as platt, round(case when p < 0.5 then 0.1::double + (0.4::double - 0.1::double) * (p - 0::double) / (0.5::double - 0::double) when p < 0.9 then 0.4::double + (0.85::double - 0.4::double) * (p - 0.5::double) / (0.9::double - 0.5::double) when p < 1 then 0.85::double + (0.97::double - 0.85::double) * (p - 0.9::double) / (1::double - 0.9::double) else 0.97::double end, 9) as linear from (select ord, predicate.score as p, greatest(1e-6::double, least(1::double - 1e-6::double, predicate.score)) as q from triples_re where predicate.score between 0 and 1)",
    "triple_schema": "with e as (select unnest([subject, \"object\"]) as e from triples_genetic_disease_chemical_normalized) " + " union all ".join(
        f"select '{c}' as field, '{k}' as type, case when e.{c} is null then 'absent' {f'when len(e.{c}) = 0 then $$empty$$' if k.startswith('array') else ''} else 'present' end as state, count(*) as n from e group by all"
        for c, k in (("text", "string"), ("type", "string"), ("hgnc_symbol", "array<string>"), ("hgnc_via", "string"), ("control", "string"), ("mondo_label", "array<string>"), ("mondo_via", "string"), ("chebi_label", "array<string>"), ("chebi_via", "string"))
    ),
}
