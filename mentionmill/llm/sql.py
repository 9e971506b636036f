"""SQL for the queries that it can express on whole tables."""

from __future__ import annotations

_ITEMS = """
with row_symbols as (
  select split_part(pmid, '.', 1) as article, sentence, unnest(list_concat(coalesce(subject.hgnc_symbol, []), coalesce("object".hgnc_symbol, []))) as joined
  from triples_genetic_disease_chemical_normalized),
items as (
  select distinct article, sentence, trim(s) as item
  from (select article, sentence, unnest(string_split(joined, '|')) as s from row_symbols) where trim(s) <> ''),
singles as (select item, count(*) as k from items group by item),
total as (select count(*) as n from (select distinct article, sentence from items)),
pairs as (
  select x.item as a, y.item as b, count(*) as n_ab
  from items x join items y on x.article is not distinct from y.article and x.sentence is not distinct from y.sentence and x.item < y.item
  group by x.item, y.item)
"""

_P1 = f"""{_ITEMS}
select a as symbol_a, b as symbol_b from pairs, total
join singles sa on sa.item = a join singles sb on sb.item = b
where n_ab >= 5 and n_ab::hugeint * n >= 8 * sa.k::hugeint * sb.k"""

_P1_PAIRS = f"""{_ITEMS}
select a as symbol_a, b as symbol_b, n_ab, sa.k as n_a, sb.k as n_b, round(n_ab::double * n / sa.k / sb.k, 3) as lift
from pairs, total join singles sa on sa.item = a join singles sb on sb.item = b"""

_P1_ARTICLES = _P1_PAIRS.replace("article, sentence, ", "article, ").replace("article, sentence from items", "article from items").replace("and x.sentence is not distinct from y.sentence ", "") + " where n_ab >= 2"

_P2 = r"""
with parts as (
  select ord, score, polarity, scored_at, predicate.text as predicate, pair_id, lower(trim(pair_id, E' \t\n\r')) as p,
    regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce(model, predicate.model), E' \t\n\r')), '^.*/', ''), '@.*$', ''), '[_\s]+', '-', 'g') as m
  from triples_re where pair_id is not null),
keyed as (
  select *, list_filter(string_split_regex(p, '[^a-z0-9.]+|\.\.'), lambda x: x <> '') as t from parts),
grouped as (
  select *, split_part(t[1], '.', 1) || ':' || t[2] || ':' || case when (t[3]::bigint, t[4]::bigint) <= (t[5]::bigint, t[6]::bigint)
    then concat_ws('-', t[3]::bigint, t[4]::bigint, t[5]::bigint, t[6]::bigint) else concat_ws('-', t[5]::bigint, t[6]::bigint, t[3]::bigint, t[4]::bigint) end as g
  from keyed),
ranked as (select grouped.*, trust_rank as trust from grouped left join relation_models on relation_models.model = m),
groups as (select g, min(ord) as group_ord from ranked group by g having count(*) >= 2),
candidates as (
  select g, ord, 'score' as field, -score as k0, coalesce(trust, 1e9)::double as k1, scored_at as late from ranked where score between 0 and 1 and not isnan(score)
  union all
  select g, ord, 'predicate', 0, coalesce(trust, 1e9)::double, scored_at from ranked where lower(trim(predicate)) not in ('', '-', '--', '?', 'n/a', 'na', 'nan', 'none', 'null', 'unknown', 'undefined', 'tbd')
  union all
  select g, ord, 'polarity', 0, 0, scored_at from ranked where lower(trim(polarity)) not in ('', '-', '--', '?', 'n/a', 'na', 'nan', 'none', 'null', 'unknown', 'undefined', 'tbd')),
best as (select *, row_number() over (partition by g, field order by k0, k1, late desc nulls last, ord) as r from candidates)
select group_ord, field, ord as from_ord from best join groups using (g) where r = 1"""

_COUNTS = """
with counting as (
  select split_part(pmid, '.', 1) as article, clean_genetic_ne, occurrences,
    row_number() over (partition by split_part(pmid, '.', 1), clean_genetic_ne order by counted_at desc nulls last, row_id desc) as r
  from clean_genetic_ne where occurrences > 0 and clean_genetic_ne is not null and pmid is not null),
kept as (select * from counting where r = 1),
articles as (select count(distinct article) as d from kept),
counted as (select clean_genetic_ne, sum(occurrences)::bigint as total, count(*) as records from kept group by clean_genetic_ne),
marked as (select clean_genetic_ne, total, records, case when 20 * records >= d then 'common' when total <= 2 then 'rare' end as mark from counted, articles)
"""

_P4 = f"{_COUNTS} select clean_genetic_ne, mark from marked where mark is not null"
_P4_COUNTS = f"{_COUNTS} select clean_genetic_ne, total, records, mark from marked"


def oracle_sql() -> dict[str, str]:
    return {"p1_found": _P1, "p1_pairs": _P1_PAIRS, "p1_articles": _P1_ARTICLES, "p2_found": _P2, "p4_found": _P4, "p4_counts": _P4_COUNTS}
