"""Queries over merged verdicts and the entity graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mentionmill.operators import graph as G
from mentionmill.session import table
from mentionmill.staging import staged

TYPED, GATE = "relmark-typed", "relmark-binary"
STEPS = [0.5, 0.75, 0.9]


def _merged(policy: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        x = G.merged_verdicts(table(spark, d, "triples_re"), TYPED, GATE, policy)
        return x.select("key", "ord", "score", F.array_join("models", "|").alias("models"), "corroborated", "label_model")

    run.__name__ = f"merge_{policy}"
    run.__doc__ = f"One verdict per pair under the policy {policy}."
    return run


merge_union, merge_gate, merge_typed = map(_merged, ("union", "gate", "typed"))


def verdict_compare(spark: SparkSession, d: str) -> DataFrame:
    return G.compared_verdicts(table(spark, d, "triples_re"), TYPED, GATE)


def label_crosstab(spark: SparkSession, d: str) -> DataFrame:
    """Labels of one model against the other's on shared pairs, with the sums of their scores in ten-thousandths."""
    x = verdict_compare(spark, d).where("side = 'both'")
    return x.groupBy("label_a", "label_b").agg(F.count("*").alias("n"), F.sum(F.round(F.col("score_a") * 10000).cast("bigint")).alias("sum_a"), F.sum(F.round(F.col("score_b") * 10000).cast("bigint")).alias("sum_b"))


def threshold_stats(spark: SparkSession, d: str) -> DataFrame:
    """Triples and distinct sentences at several score thresholds, all and control-free; one pass for all thresholds."""
    t = table(spark, d, "triples_re").select("score", "sentence", G.control_free(F.col("subject"), F.col("object")).alias("free")).where("score >= 0 and not isnan(score)")
    x = t.withColumn("threshold", F.explode(F.array(*[F.lit(v) for v in (0.5, 0.8, 0.95, 0.99)]))).where("score >= threshold")
    return x.groupBy("threshold").agg(F.count("*").alias("triples"), F.countDistinct("sentence").alias("sentences"), F.count_if("free").alias("kept"), F.countDistinct(F.when(F.col("free"), F.col("sentence"))).alias("kept_sentences"))


def node_drops(spark: SparkSession, d: str) -> DataFrame:
    """Ends of triples that are no nodes, by reason."""
    e = table(spark, d, "triples_re").select(F.explode(F.array("subject", "object")).alias("e"))
    return e.select(F.coalesce(G.drop_reason(F.col("e")), F.lit("kept")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def _relations(spark, d, genes_only, min_score=0.5):
    return G.relations(table(spark, d, "triples_re"), min_score, genes_only)


def gene_edges(spark: SparkSession, d: str) -> DataFrame:
    return G.edges(_relations(spark, d, True)).withColumn("roles", F.array_join("roles", "|"))


def typed_edges(spark: SparkSession, d: str) -> DataFrame:
    return G.edges(_relations(spark, d, False)).withColumn("roles", F.array_join("roles", "|"))


def typed_nodes(spark: SparkSession, d: str) -> DataFrame:
    return G.nodes(_relations(spark, d, False))


def edge_sentences(spark: SparkSession, d: str) -> DataFrame:
    return G.edge_sentences(_relations(spark, d, False)).select("lo", "hi", F.md5("sentence").alias("digest"), "sc", "pmid", "cat", "spec", "role")


def _sents_with_year(spark, d, genes_only=False):
    years = table(spark, d, "pubs").where("pmc_id is not null").groupBy(F.col("pmc_id").alias("pmid")).agg(F.min("year").alias("year"))
    return G.edge_sentences(_relations(spark, d, genes_only)).join(years, "pmid", "left")


def view_edges(spark: SparkSession, d: str) -> DataFrame:
    """Pairs in a view: score at least 0.6, years 2012 to 2024, sentence text by pattern, relation kept; with sentences and papers."""
    v = G.visible(_sents_with_year(spark, d), 0.6, (2012, 2024), (1900, 2026), "/(increas|reduc|inhibit)/")
    v = v.where(~F.col("cat").startswith("not "))
    return v.groupBy("lo", "hi").agg(F.countDistinct("sentence").alias("sentences"), F.countDistinct("pmid").alias("papers"))


def node_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Distinct sentences per node in the view."""
    v = G.visible(_sents_with_year(spark, d), 0.6, (2012, 2024), (1900, 2026))
    return v.select(F.explode(F.array("lo", "hi")).alias("id"), "sentence").groupBy("id").agg(F.countDistinct("sentence").alias("sentences"))


def _pairs(spark, d):
    """All pairs of the graph, once."""
    return staged(_relations(spark, d, False).select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "pairs")


def k_hop(spark: SparkSession, d: str) -> DataFrame:
    """Nodes within two steps of the node with the most neighbours."""
    p = _pairs(spark, d)
    seeds = G.undirected(p).groupBy(F.col("u").alias("id")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "id").limit(1)
    return G.neighbourhood(p, seeds, 2)


def gene_neighbourhood(spark: SparkSession, d: str) -> DataFrame:
    """Pairs among a gene, found by the start of its name, and its neighbours."""
    p, rel = _pairs(spark, d), _relations(spark, d, False)
    seeds = G.seed_nodes(G.nodes(rel).where("kind = 'gene'"), "tm")
    return G.induced(p, G.neighbourhood(p, seeds, 1)).select("lo", "hi")


def filtered_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of genes and chemicals that the typed model finds to activate or inhibit, with two sentences of a score of 0.6 or more."""
    rel = _relations(spark, d, False)
    return G.filtered_pairs(rel, G.edge_sentences(rel).where("sc >= 0.6"), ["activates", "inhibits"], [TYPED], ["gene", "chemical"], 2)


def edge_counts(spark: SparkSession, d: str) -> DataFrame:
    return G.edge_counts(_relations(spark, d, False))


def best_edge_sentences(spark: SparkSession, d: str) -> DataFrame:
    """The ten best sentences of each pair, by falling score, article and sentence."""
    x = G.edge_sentences(_relations(spark, d, False)).withColumn("digest", F.md5("sentence"))
    rank = F.row_number().over(Window.partitionBy("lo", "hi").orderBy(F.desc("sc"), "pmid", "digest"))
    return x.withColumn("rank", rank).where("rank <= 10").select("lo", "hi", "rank", "sc", "pmid", "digest")


def top_relations(spark: SparkSession, d: str) -> DataFrame:
    """The 60 relations of the highest scores."""
    return _relations(spark, d, False).orderBy(F.desc("sc"), "ord").limit(60).select("ord", "a", "b", "cat", "sc")


def polarity_edges(spark: SparkSession, d: str) -> DataFrame:
    return G.polarity_edges(_relations(spark, d, False))


def components(spark: SparkSession, d: str) -> DataFrame:
    return G.components(_pairs(spark, d))


def min_degree_pairs(spark: SparkSession, d: str) -> DataFrame:
    return G.min_degree(_pairs(spark, d), 3)


def min_cluster_pairs(spark: SparkSession, d: str) -> DataFrame:
    return G.min_cluster(_pairs(spark, d), 3)


def _halves(spark, d):
    s = _sents_with_year(spark, d).where("year is not null")
    return s.where("year < 2018"), s.where("year >= 2018")


def graph_diff(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of the graph before 2018 against those since, at each score step."""
    return G.diff(*_halves(spark, d), STEPS)


def balance_index(spark: SparkSession, d: str) -> DataFrame:
    b = G.balance(G.diff(*_halves(spark, d), STEPS, 1))
    return b.select("step", "id", "degree_1", "degree_2", F.round("balance", 6).alias("balance"))


QUERIES = {f.__name__: f for f in (merge_union, merge_gate, merge_typed, verdict_compare, label_crosstab, threshold_stats, node_drops, gene_edges, typed_edges, typed_nodes, edge_sentences, view_edges, node_sizes, k_hop, gene_neighbourhood, filtered_pairs, edge_counts, best_edge_sentences, top_relations, polarity_edges, components, min_degree_pairs, min_cluster_pairs, graph_diff, balance_index)}

_CLEAN = "case when isnan(score) then 0 else coalesce(score, 0) end"
_KEY = "coalesce(pair_id, concat_ws(chr(1), pmid, sentence, subject.text, \"object\".text))"


def _merge_sql(policy: str) -> str:
    only = f"where model = '{TYPED}'" if policy == "typed" else ""
    gate = "where gated" if policy == "gate" else ""
    return f"""
with x as (select {_KEY} as key, ord, predicate.model as model, {_CLEAN} as score from triples_re),
first as (select key, model, min(ord) as first from x group by all),
per as (select * from (select *, row_number() over (partition by key, model order by score desc, ord) as r from x) join first using (key, model) where r = 1),
kept as (select * from per {only}),
based as (select *, row_number() over (partition by key order by case model when '{TYPED}' then 0 when '{GATE}' then 1 else 2 end, first) as b from kept),
grouped as (select key, max(score) as score, array_to_string(list_sort(list(model)), '|') as models, count(*) > 1 as corroborated, bool_or(model = '{GATE}') as gated from kept group by key)
select key, based.ord, grouped.score, models, corroborated, based.model as label_model from grouped join based using (key) {gate} {"and" if gate else "where"} b = 1"""


_COMPARE = f"""
with x as (select {_KEY} as key, ord, predicate.model as model, predicate.text as label, {_CLEAN} as score from triples_re where predicate.model in ('{TYPED}', '{GATE}')),
per as (select * from (select *, row_number() over (partition by key, model order by score desc, ord) as r from x) where r = 1),
a as (select * from per where model = '{TYPED}'), b as (select * from per where model = '{GATE}')
select coalesce(a.key, b.key) as key, a.label as label_a, a.score as score_a, b.label as label_b, b.score as score_b, case when b.key is null then 'only_a' when a.key is null then 'only_b' else 'both' end as side
from a full join b on a.key = b.key"""

_FREE = """((coalesce(subject.control, '') = 'no' or coalesce("object".control, '') = 'no') and coalesce(subject.control, '') <> 'yes' and coalesce("object".control, '') <> 'yes'
  and not list_contains(string_split(array_to_string(list_concat(coalesce(subject.symbols, []), coalesce("object".symbols, [])), '|'), '|'), 'MKI67'))"""


def _node_sql(e: str) -> str:
    gene = f"case when len({e}.symbols) = 1 then nullif(trim({e}.symbols[1]), '') end"
    other = f"case when len({e}.labels) = 1 then nullif(trim({e}.labels[1]), '') end"
    return f"""case {e}.type when 'GENETIC' then case when {gene} <> 'MKI67' and coalesce({e}.control, '') <> 'yes' then {{{{'kind': 'gene', 'id': {gene}}}}} end
      when 'DISEASE' then case when lower({other}) not in ('neoplasm', 'cancer', 'os') and lower(trim({e}.text)) not in ('neoplasm', 'cancer', 'os') then {{{{'kind': 'disease', 'id': {other}}}}} end
      when 'CHEMICAL' then case when {other} is not null then {{{{'kind': 'chemical', 'id': {other}}}}} end end""".replace("{{", "{").replace("}}", "}")


def _cat_sql() -> str:
    when = " ".join(f"when '{k}' then '{v}'" for k, v in G.CATEGORIES.items())
    low = "lower(trim(coalesce(predicate.text, '')))"
    return f"case when polarity = 'negated' then 'not ' else '' end || case {low} {when} else coalesce(nullif({low}, ''), 'interacts') end"


def _rel(genes_only: bool = False) -> str:
    only = "and na.kind = 'gene' and nb.kind = 'gene'" if genes_only else ""
    return f"""
pre as (select *, {_node_sql('subject')} as na, {_node_sql('"object"')} as nb, {_FREE} as free, {_cat_sql()} as cat from triples_re where score >= 0.5 and not isnan(score)),
rel as (
  select na.id as a, na.kind as a_kind, nb.id as b, nb.kind as b_kind, cat, score as sc, sentence, split_part(pmid, '.', 1) as pmid, coalesce(modality, '') = 'speculated' as spec, predicate.model as role, ord
  from pre where na is not null and nb is not null and (na.id <> nb.id or na.kind <> nb.kind) and ((na.kind <> 'gene' and nb.kind <> 'gene') or free) {only}),
es as (
  select least(a, b) as lo, greatest(a, b) as hi, sentence, sc, pmid, cat, spec, role from
    (select *, row_number() over (partition by least(a, b), greatest(a, b), sentence order by case when isnan(sc) then 1e9 else sc end desc, ord) as r from rel) where r = 1),
years as (select pmc_id as pmid, min(year) as year from pubs where pmc_id is not null group by pmc_id),
dated as (select es.*, year from es left join years using (pmid))"""


def _edges_sql(genes_only: bool) -> str:
    return f"""with {_rel(genes_only)},
stated as (select a, b, cat, count(distinct sentence) as n from rel group by all),
best as (select *, row_number() over (partition by least(a, b), greatest(a, b) order by n desc, a desc, b desc, cat desc) as r from stated),
per as (select least(a, b) as lo, greatest(a, b) as hi, count(distinct sentence) as sentences, array_to_string(list_sort(list(distinct role)), '|') as roles, max(sc) as best from rel group by all)
select a as src, b as dst, cat, n as support, sentences, roles, per.best as best, cat like 'not %' as negative from best join per on per.lo = least(a, b) and per.hi = greatest(a, b) where r = 1"""


def _pairs_sql() -> str:
    return f"{_rel()}, p as (select distinct lo, hi from es), both_ways as (select lo as u, hi as v from p union select hi, lo from p)"


_COMPONENTS = f"with recursive {_pairs_sql()}, reach as (select u as id, u as other from both_ways union select reach.id, both_ways.v from reach join both_ways on both_ways.u = reach.other), comp as (select id, min(other) as component from reach group by id)"
_DIFF = f"""
with {_rel()},
tagged as (select lo, hi, sc, pmid, case when year < 2018 then 1 else 2 end as g from dated where year is not null),
stepped as (select s.step, t.* from tagged t join (values {", ".join(f"({v}::double)" for v in STEPS)}) s(step) on t.sc >= s.step),
p as (select step, lo, hi, count(distinct pmid) filter (where g = 1) as pubs_1, count(distinct pmid) filter (where g = 2) as pubs_2, bool_or(g = 1) as in_1, bool_or(g = 2) as in_2 from stepped group by all),
sided as (select *, case when in_1 and in_2 then 'shared' when in_1 then 'only_1' else 'only_2' end as side from p)
"""

_KINDS = "kinds as (select id, min(kind) as kind from (select a as id, a_kind as kind from rel union all select b, b_kind from rel) group by id)"
SQL = {
    "gene_neighbourhood": f"""with {_pairs_sql()}, seed as (select a as id from (select a, a_kind as k from rel union select b, b_kind from rel) where k = 'gene' and lower(a) like 'tm%' order by lower(a) <> 'tm', a limit 1),
near as (select id from seed union select v from both_ways join seed on u = id) select lo, hi from p where lo in (select id from near) and hi in (select id from near)""",
    "filtered_pairs": f"""with e as ({_edges_sql(False)}), s as (with {_rel()} select lo, hi, count(distinct sentence) as sentences from es where sc >= 0.6 group by all having count(distinct sentence) >= 2),
k as (with {_rel()} select a as id from rel where a_kind in ('gene', 'chemical') union select b from rel where b_kind in ('gene', 'chemical'))
select s.* from s join e on least(src, dst) = lo and greatest(src, dst) = hi where cat in ('activates', 'inhibits') and list_contains(string_split(roles, '|'), '{TYPED}') and lo in (select id from k) and hi in (select id from k)""",
    "edge_counts": f"""with e as ({_edges_sql(False)}), k as (with {_rel()}, {_KINDS} select * from kinds)
select cat, least(x.kind, y.kind) || '-' || greatest(x.kind, y.kind) as kinds, negative, count(*) as edges from e join k x on x.id = src join k y on y.id = dst group by all""",
    "best_edge_sentences": f"with {_rel()} select lo, hi, rank, sc, pmid, digest from (select *, md5(sentence) as digest, row_number() over (partition by lo, hi order by sc desc, pmid, md5(sentence)) as rank from es) where rank <= 10",
    "top_relations": f"with {_rel()} select ord, a, b, cat, sc from rel order by sc desc, ord limit 60",
    "polarity_edges": f"with {_rel()} select a as src, b as dst, cat like 'not %' as negative, count(distinct sentence) as sentences from rel group by all",
    "merge_union": _merge_sql("union"),
    "merge_gate": _merge_sql("gate"),
    "merge_typed": _merge_sql("typed"),
    "verdict_compare": _COMPARE,
    "label_crosstab": f"select label_a, label_b, count(*) as n, sum(round(score_a * 10000)::bigint)::bigint as sum_a, sum(round(score_b * 10000)::bigint)::bigint as sum_b from ({_COMPARE}) where side = 'both' group by all",
    "threshold_stats": f"select threshold, count(*) as triples, count(distinct sentence) as sentences, count(*) filter (where free) as kept, count(distinct sentence) filter (where free) as kept_sentences from (select score, sentence, {_FREE} as free from triples_re where score >= 0 and not isnan(score)) join (values (0.5::double), (0.8::double), (0.95::double), (0.99::double)) v(threshold) on score >= threshold group by threshold",
    "node_drops": f"""
select coalesce(case when {_node_sql('e')} is not null then null when (case e.type when 'GENETIC' then case when len(e.symbols) = 1 then nullif(trim(e.symbols[1]), '') end else case when len(e.labels) = 1 then nullif(trim(e.labels[1]), '') end end) is null then lower(e.type) || ': no single id'
  when e.type = 'GENETIC' then 'genetic: control' else lower(e.type) || ': too general' end, 'kept') as reason, count(*) as n from (select unnest([subject, "object"]) as e from triples_re) group by all""",
    "gene_edges": _edges_sql(True),
    "typed_edges": _edges_sql(False),
    "typed_nodes": f"with {_rel()}, each as (select a as id, a_kind as kind, sentence, sc from rel union all select b, b_kind, sentence, sc from rel), per as (select id, kind, sentence, max(sc) as sc from each group by all) select id, kind, count(*) as sentences, count(*) filter (where sc >= 0.99) as strong from per group by all",
    "edge_sentences": f"with {_rel()} select lo, hi, md5(sentence) as digest, sc, pmid, cat, spec, role from es",
    "view_edges": f"with {_rel()} select lo, hi, count(distinct sentence) as sentences, count(distinct pmid) as papers from dated where sc >= 0.6 and year between 2012 and 2024 and regexp_matches(sentence, '(?i)(increas|reduc|inhibit)') and cat not like 'not %' group by all",
    "node_sizes": f"with {_rel()} select id, count(distinct sentence) as sentences from (select unnest([lo, hi]) as id, sentence from dated where sc >= 0.6 and year between 2012 and 2024) group by id",
    "k_hop": f"""with {_pairs_sql()}, h0 as (select u as id, 0 as hop from both_ways group by u order by count(*) desc, u limit 1),
h1 as (select id, min(hop) as hop from (select * from h0 union all select v, 1 from both_ways join h0 on id = u) group by id), h2 as (select id, min(hop) as hop from (select * from h1 union all select v, 2 from both_ways join h1 on id = u where hop = 1) group by id) select * from h2""",
    "components": f"{_COMPONENTS} select id, component from comp",
    "min_degree_pairs": f"with {_pairs_sql()}, ok as (select u from both_ways group by u having count(*) >= 3) select lo, hi from p where lo in (select u from ok) and hi in (select u from ok)",
    "min_cluster_pairs": f"{_COMPONENTS}, ok as (select id from comp where component in (select component from comp group by component having count(*) >= 3)) select lo, hi from p where lo in (select id from ok)",
    "graph_diff": f"{_DIFF} select step, lo, hi, side, pubs_1, pubs_2 from sided where side = 'shared' or greatest(pubs_1, pubs_2) >= 2",
    "balance_index": f"""{_DIFF}, ends as (select step, unnest([lo, hi]) as id, side from sided),
deg as (select step, id, count(*) filter (where side <> 'only_2') as degree_1, count(*) filter (where side <> 'only_1') as degree_2 from ends group by all),
tot as (select step, sum(degree_1) as t1, sum(degree_2) as t2 from deg group by step),
sh as (select deg.*, coalesce(degree_1 / nullif(t1, 0)::double, 0) as a, coalesce(degree_2 / nullif(t2, 0)::double, 0) as b from deg join tot using (step))
select step, id, degree_1, degree_2, round((a - b) / nullif(a + b, 0), 6) as balance from sh""",
}
