"""Queries that link surfaces to gene and ontology lists by priority cascades."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionmill.functions import text as T
from mentionmill.operators import genesets as G
from mentionmill.operators import linking as L
from mentionmill.plans.mentions import dash
from mentionmill.session import table


def _surfaces(spark, d, label, fold=lambda c: c):
    e = table(spark, d, "sentences").select(F.explode("entities").alias("e")).where(F.col("e.label") == label)
    return e.groupBy(fold(F.col("e.text")).alias("surface")).agg(F.count("*").alias("occurrences"))


def _shown(x: DataFrame) -> DataFrame:
    return x.select("surface", "occurrences", "status", "match_mode", "match_field", F.array_join("ids", "|").alias("ids"))


#: Surfaces that no test table holds, so that the passes over gene sets, oncogenes and histones, exclusions and corrections are reached.
GENE_EXAMPLES = (
    "IL-12", "IL-12 p40 mRNA", "AP-1 protein", "VEGF receptors", "Trk", "HER family", "c-Ets", "c-ras", "NF-kB", "NF-kappaB complex", "NFKB1", "NFKBIA", "NF-kB p65", "shNFkB", "H3K27me3", "histone 3", "H2A.X", "phospho-H2AX",
    "H3.3K27M", "macroH2A", "HDAC histone deacetylase", "H358", "H3-5HT", "cKit", "c-Jun N-terminal kinase", "c-erbB-2 protein", "c-Ha-ras", "HGF receptor", "c-Ets-1", "KYA1797K", "pMIR", "pYAP", "YAP target genes",
    "CAR-T", "THP-1", "",
)


def gene_links(spark: SparkSession, d: str) -> DataFrame:
    """Every gene surface through the gene cascade."""
    more = spark.createDataFrame([(x, 0) for x in GENE_EXAMPLES], "surface string, occurrences bigint")
    s = _surfaces(spark, d, "GENETIC", T.dash_normalize).unionByName(more).groupBy("surface").agg(F.sum("occurrences").alias("occurrences"))
    return _shown(L.link_genes(s, "surface", table(spark, d, "hgnc")))


def disease_links(spark: SparkSession, d: str) -> DataFrame:
    return _shown(L.link_terms(_surfaces(spark, d, "DISEASE"), "surface", table(spark, d, "obo_term"), "MONDO:"))


def chemical_links(spark: SparkSession, d: str) -> DataFrame:
    return _shown(L.link_terms(_surfaces(spark, d, "CHEMICAL"), "surface", table(spark, d, "obo_term"), "CHEBI:"))


def link_summary(spark: SparkSession, d: str) -> DataFrame:
    """Surfaces and occurrences by status and mode, with totals by status."""
    x = disease_links(spark, d).unionByName(chemical_links(spark, d))
    g = x.groupingSets([["status", "match_mode"], ["status"]], "status", "match_mode")
    return g.agg(F.grouping_id().alias("level"), F.count("*").alias("surfaces"), F.sum("occurrences").alias("occurrences"))


def link_credit(spark: SparkSession, d: str) -> DataFrame:
    """Occurrences per linked id; an ambiguous surface counts in full for each of its ids."""
    x = disease_links(spark, d).where("status <> 'unmatched'")
    return x.select(F.explode(F.split("ids", r"\|")).alias("id"), "occurrences").groupBy("id").agg(F.sum("occurrences").alias("occurrences"), F.count("*").alias("surfaces"))


def word_cosine(spark: SparkSession, d: str) -> DataFrame:
    """Surfaces whose words are those of a term name in another order."""
    names = L.term_names(table(spark, d, "obo_term"), "MONDO:").select("id", "name")
    x = L.bag_cosine(_surfaces(spark, d, "DISEASE"), "surface", names, 0.99)
    return x.select("surface", "id", "name", F.round("cosine", 6).alias("cosine"))


def word_cosine_all(spark: SparkSession, d: str) -> DataFrame:
    """All surfaces and term names with a word cosine of 0.6 or more, found without blocking by rare words."""
    names = L.term_names(table(spark, d, "obo_term"), "MONDO:").select("id", "name")
    x = L.bag_cosine(_surfaces(spark, d, "DISEASE"), "surface", names, 0.6, None)
    return x.select("surface", "id", "name", F.round("cosine", 6).alias("cosine"))


def greek_links(spark: SparkSession, d: str) -> DataFrame:
    """Gene surfaces with Greek letters through the Greek cascade."""
    return _shown(L.link_greek_genes(greek_surfaces(spark, d), "surface", table(spark, d, "hgnc")))


def greek_surfaces(spark: SparkSession, d: str) -> DataFrame:
    """Gene surfaces with Greek letters, as symbol or word."""
    return _surfaces(spark, d, "GENETIC").where(T.is_greek(F.col("surface")))


QUERIES = {f.__name__: f for f in (gene_links, disease_links, chemical_links, link_summary, link_credit, word_cosine, word_cosine_all, greek_surfaces, greek_links)}

_FOLD = "replace(translate(lower({0}), 'ςµİ', 'σμi'), 'ß', 'ss')"


def _fold(c: str) -> str:
    return _FOLD.format(c)


def _hs(c: str) -> str:
    return f"replace({_fold(c)}, '-', ' ')"


def _joined(c: str) -> str:
    return f"replace(replace({_fold(c)}, '-', ''), ' ', '')"


def _us(c: str) -> str:
    for a, b in T.BRITISH:
        c = f"replace({c}, '{a}', '{b}')"
    return c


def _singulars(c: str) -> list[str]:
    listed = f"case {c} " + " ".join(f"when '{a}' then '{b}'" for a, b in T.IRREGULAR.items()) + " end"
    forms = (listed, f"case when {c} like '%ies' and length({c}) > 4 then left({c}, length({c}) - 3) || 'y' end", f"case when {c} like '%es' and length({c}) > 4 then left({c}, length({c}) - 2) end", f"case when {c} like '%s' and {c} not like '%ss' and length({c}) > 3 then left({c}, length({c}) - 1) end")
    every = f"list_filter([{', '.join(forms)}], lambda z: z is not null)"
    return [f"({every})[{i}]" for i in (1, 2, 3)]


def _cascade(surfaces: str, names: str, passes: list[tuple[int, str, str, str, str, bool]], main: str) -> str:
    """passes: (rank, mode SQL, fields, surface key, name key, guard)."""
    hits = " union all ".join(f"select s.surface, {r} as rank, {m} as mode, n.field, n.field_rank, n.name, n.id, {str(g).lower()} as guard from s join n on {sk} = {nk} and {sk} <> '' where n.field in ({fs})" for r, m, fs, sk, nk, g in passes)
    return f"""
with s as ({surfaces}), n as ({names}),
hits as ({hits}),
won as (select * from (select *, min(rank) over (partition by surface) as first from hits) where rank = first),
best as (select *, row_number() over (partition by surface order by field_rank, name, field, id) as r from won),
main as (select surface, list_sort(list(distinct id)) as ids from won where field = '{main}' group by surface),
ids as (select surface, bool_or(guard) as guard, list_sort(list(distinct id)) as ids from won group by surface),
picked as (select ids.surface, case when guard and len(main.ids) = 1 then main.ids else ids.ids end as ids from ids left join main using (surface))
select s.surface, s.occurrences, case when picked.ids is null then 'unmatched' when len(picked.ids) > 1 then 'ambiguous' else 'matched' end as status, best.mode as match_mode, best.field as match_field, array_to_string(picked.ids, '|') as ids
from s left join picked using (surface) left join best on best.surface = s.surface and best.r = 1"""


def _surface_sql(label: str, text: str = "e.text") -> str:
    return f"select {text} as surface, count(*) as occurrences from (select unnest(entities) as e from sentences) where e.label = '{label}' group by all"


def _terms_sql(prefix: str) -> str:
    live = f"id like '{prefix}%' and not coalesce(deprecated, false) and label <> ''"
    return f"""select id, 'label' as field, 0 as field_rank, label as name from obo_term where {live}
    union all select id, case x.pred when 'hasExactSynonym' then 'exact' when 'hasRelatedSynonym' then 'related' when 'hasNarrowSynonym' then 'narrow' else 'broad' end, case x.pred when 'hasExactSynonym' then 1 when 'hasRelatedSynonym' then 2 when 'hasNarrowSynonym' then 3 else 4 end, x.val
    from (select id, unnest(synonyms) as x from obo_term where {live}) where x.val <> '' and x.pred in ('hasExactSynonym', 'hasRelatedSynonym', 'hasNarrowSynonym', 'hasBroadSynonym')"""


def _term_cascade(label: str, prefix: str) -> str:
    every = "'label', 'exact', 'related', 'narrow', 'broad'"
    ci, us = _fold("s.surface"), _us(_fold("s.surface"))
    steps = [("'case-sensitive'", "s.surface", "n.name"), ("'case-insensitive'", ci, _fold("n.name")), ("'hyphen/whitespace'", _hs("s.surface"), _hs("n.name"))]
    for base in (us, ci):
        steps += [("'normalized'", k, _fold("n.name")) for k in (base, *_singulars(base))]
    steps.append(("'separator-deletion'", _joined("s.surface"), _joined("n.name")))
    return _cascade(_surface_sql(label), _terms_sql(prefix), [(i, m, every, a, b, True) for i, (m, a, b) in enumerate(steps)], "label")


_SYM, _NAM = "'symbol', 'alias_symbol', 'prev_symbol'", "'name', 'alias_name', 'prev_name'"


def _gene_cascade() -> str:
    x = "s.surface"
    how = f"case when s.surface = n.name then 'case-sensitive' when {_fold('s.surface')} = {_fold('n.name')} then 'case-insensitive' else 'hyphen vs white space' end"

    def rest(p: str, fold=_hs) -> str:
        return f"case when regexp_matches({x}, '{p}') then {fold(f'''regexp_replace({x}, '{p}', '', 'g')''')} end"

    every, hn, aa = f"{_SYM}, {_NAM}", _hs("n.name"), "[ACDEFGHIKLMNPQRSTVWY]"
    same = lambda c: c
    key = f"replace(replace(regexp_replace({_fold(x)}, ' (mrna|gene|protein|cytokine)$', ''), '-', ''), ' ', '')"
    low, out = f"lower({x})", lambda names: "(" + ", ".join(f"'{n}'" for n in names) + ")"
    nfkb = f"case when regexp_matches({key}, 'nfk(appab|b)') and not regexp_matches(regexp_extract({key}, 'nfk(appab|b)(.?)', 2), '[0-9i]') and not regexp_matches({key}, 'p(65|50|52|105|100)') then '{G.NFKB}' end"
    front = f"regexp_replace(trim({low}), '^(phospho|cit|acetyl(ated)?|anti[- ]?phospho|anti|g|wt|oncohistones?|core)[- ]+', '')"
    bare = f"case when regexp_matches({front}, '^histones?[ -]*[0-9]') then 'h' else '' end || regexp_replace({front}, '^histones?[ -]*', '')"
    histone = f"case when {x} = 'H3-5HT' or regexp_matches({low}, '{G.HISTONE_ENZYMES}') then null " + " ".join(f"when regexp_matches({bare}, '^({p})') then '{v}'" for v, p in G.HISTONES) + " end"
    onco = f"case when regexp_matches({low}, '^c-?jun\\b') and regexp_matches({low}, 'termin|jnk') then null " + " ".join(f"when regexp_matches({low}, '^c-?{k}\\b') then '{v.lower()}'" for k, v in G.ONCOGENES.items())
    onco += " " + " ".join(f"when regexp_extract({low}, '{p}', 1) = '{k}' then '{v.lower()}'" for p, genes in G.NUMBERED for k, v in genes.items()) + f" when regexp_matches({low}, '{G.MET_RECEPTOR}') then 'met' end"
    but = lambda names, c: f"case when {x} not in {out(names)} then {c} end"
    steps = [
        *[(f"'{mode}'", f"'{field}'", key, "n.name", False) for field, mode in G.MODES.items()], (f"'{G.MODES['complex']}'", "'complex'", nfkb, "n.name", False),
        (how, _SYM, x, "n.name", False), (how, _SYM, _hs(x), hn, False), (how, _NAM, _hs(x), hn, False),
        ("'phospho stripped'", every, rest("^([Pp]hospho[- ]|[Pp]-)"), hn, False),
        ("'anti- stripped'", every, f"case when regexp_matches({x}, '^[Aa]nti[- ]') then {_hs(f'''regexp_replace(regexp_replace({x}, '^[Aa]nti[- ]', ''), '(?i) antibody$', '')''')} end", hn, False),
        ("'cleaved- stripped'", every, rest("^[Cc]leaved-"), hn, False), ("'protein stripped'", every, rest("[ -]protein"), hn, False), ("'transcript/mRNA stripped'", every, rest(r"[ -](transcripts?|mRNAs?)\b"), hn, False),
        ("'variant/mutant stripped'", every, rest(r"[ -](variants?|mutants?|mutations?)\b|\b(variants?|mutants?|mutations?)[ -]"), hn, False),
        ("'missense stripped'", "'symbol'", but(L.NOT_MISSENSE, f"nullif(regexp_extract({x}, '^(.+?){aa}[0-9]+{aa}$', 1), '')"), "n.name", False), ("'missense stripped'", "'symbol'", but(L.NOT_MISSENSE, f"nullif(regexp_extract({x}, '^(.+) {aa}[0-9]+{aa}$', 1), '')"), "n.name", False),
        ("'inhibitor-i stripped'", _SYM, rest("i$", same), "n.name", False), ("'promoter stripped'", _SYM, rest("(?i)( gene promoter| promoter region| promoter)$"), hn, False),
        ("'hyphen-removed'", _SYM, f"case when {x} not in {out(L.NOT_DEHYPHENED)} and regexp_matches({x}, '^[A-Z]+-[0-9]+$') then {_fold(f'''replace({x}, '-', '')''')} end", _fold("n.name"), True),
        ("'p-prefix stripped'", _SYM, f"case when {x} not in {out(L.NOT_P_PREFIXED)} and regexp_matches({x}, '^p[A-Z]') then {_hs(f'substr({x}, 2)')} end", hn, True),
        ("'WT stripped'", _SYM, rest("^(WT |[Ww]ild[ -]?type )"), hn, False), ("'nuclear stripped'", _SYM, rest("^nuclear "), hn, False), ("'regulatory target-set (not the gene)'", _SYM, rest("(?i) target genes$"), hn, False),
        ("'histone'", ", ".join(f"'{v}'" for v, _ in G.HISTONES), histone, "n.name", False), ("'c-oncogene→gene alias'", "'symbol'", onco, hn, True),
        ("'greek letters spelled out'", every, f"case when regexp_matches({x}, '[Ͱ-Ͽ]|\\b(alpha|beta|gamma|delta|kappa)\\b') then {_hs(_spelled(x))} end", _hs(_spelled("n.name")), True),
        ("'separator-removed'", "'symbol'", but(L.NOT_JOINED, _joined(x)), _joined("n.name"), False), ("'separator-removed'", "'alias_symbol', 'prev_symbol'", f"case when {x} not in {out(L.NOT_JOINED)} and length({_joined(x)}) >= 4 then {_joined(x)} end", _joined("n.name"), False),
    ]
    names = " union all ".join(f"select hgnc_id as id, '{f}' as field, {r} as field_rank, {f if f == 'symbol' else f'unnest({f})'} as name from hgnc" for r, f in enumerate(("symbol", "alias_symbol", "prev_symbol", "name", "alias_name", "prev_name")))
    names += " union all select coalesce(hgnc_id, s), f, -1, k from (values " + ", ".join(f"('{f}', '{k}', '{g}')" for f, k, g in G.set_rows()) + ") v(f, k, s) left join hgnc on symbol = s"
    family = " ".join(f"when '{g}' then '{v}'" for v, g in G.HISTONE_GROUPS.items())
    names += f" union all select hgnc_id, case g {family} end, -1, case g {family} end from (select hgnc_id, symbol, unnest(gene_group) as g from hgnc) where g in {out(G.HISTONE_GROUPS.values())} and not (g = 'H3 histones' and symbol in {out(G.NOT_CANONICAL_H3)})"
    surfaces = f"select surface, sum(occurrences)::bigint as occurrences from ({_surface_sql('GENETIC', dash('e.text'))} union all select unnest([{', '.join(repr(e) for e in GENE_EXAMPLES)}]), 0) group by surface"
    linked = _cascade(surfaces, names, [(i, *p) for i, p in enumerate(steps)], "symbol")
    manual = "select v.s as c, coalesce(min(hgnc_id), min(g)) as id from (values " + ", ".join(f"('{k}', '{v}')" for k, v in L.CORRECTIONS.items()) + ") v(s, g) left join hgnc on symbol = g group by v.s"
    return f"select surface, occurrences, case when c is null then status else 'matched' end as status, case when c is null then match_mode else coalesce(match_mode, 'manual') end as match_mode, case when c is null then match_field else 'manual' end as match_field, case when c is null then ids else id end as ids from ({linked}) left join ({manual}) on c = surface"


def _spelled(c: str) -> str:
    c = f"replace(lower({c}), 'ς', 'σ')"
    for letter, name in zip("αβγδεζηθικλμνξοπρστυφχψω", T.GREEK_NAMES, strict=True):
        c = f"replace({c}, '{letter}', '{name}')"
    return c


_DISEASES, _CHEMICALS = _term_cascade("DISEASE", "MONDO:"), _term_cascade("CHEMICAL", "CHEBI:")
_WORDS = "list_filter(regexp_split_to_array({0}, '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
_COSINE = f"""
with s as (select surface, {_WORDS.format(_fold('surface'))} as w from ({_surface_sql('DISEASE')})), s2 as (select * from s where len(w) > 1),
n as (select id, name, {_WORDS.format(_fold('name'))} as w from (select distinct id, name from ({_terms_sql('MONDO:')}))), n2 as (select * from n where len(w) > 1),
nw as (select id, name, word, count(*) as k from (select id, name, unnest(w) as word from n2) group by all),
df as (select word, count(*) as df from nw group by word),
sw as (select surface, word, min(place) as place, count(*) as k from (select surface, unnest(w) as word, generate_subscripts(w, 1) as place from s2) group by all),
rare as (select * from (select sw.*, row_number() over (partition by surface order by coalesce(df, 0), place) as r from sw left join df using (word)) where r <= 2),
cand as (select distinct surface, id, name from rare join nw using (word)),
dots as (select c.surface, c.id, c.name, sum(sw.k * nw.k) as dot from cand c join sw using (surface) join nw on nw.id = c.id and nw.name = c.name and nw.word = sw.word group by all),
sn as (select surface, sum(k * k) as q from sw group by surface), nn as (select id, name, sum(k * k) as q from nw group by all)
select surface, id, name, round(dot / sqrt((sn.q * nn.q)::double), 6) as cosine from dots join sn using (surface) join nn using (id, name)
where dot / sqrt((sn.q * nn.q)::double) >= 0.99::double and {_fold('surface')} <> {_fold('name')}"""
_COSINE_ALL = f"""
with s as (select surface, {_WORDS.format(_fold('surface'))} as w from ({_surface_sql('DISEASE')})), s2 as (select * from s where len(w) > 1),
n as (select id, name, {_WORDS.format(_fold('name'))} as w from (select distinct id, name from ({_terms_sql('MONDO:')}))), n2 as (select * from n where len(w) > 1),
nw as (select id, name, word, count(*) as k from (select id, name, unnest(w) as word from n2) group by all),
sw as (select surface, word, count(*) as k from (select surface, unnest(w) as word from s2) group by all),
dots as (select surface, id, name, sum(sw.k * nw.k) as dot from sw join nw using (word) group by all),
sn as (select surface, sum(k * k) as q from sw group by surface), nn as (select id, name, sum(k * k) as q from nw group by all)
select surface, id, name, round(dot / sqrt((sn.q * nn.q)::double), 6) as cosine from dots join sn using (surface) join nn using (id, name)
where dot / sqrt((sn.q * nn.q)::double) >= 0.6::double and {_fold('surface')} <> {_fold('name')}"""

SQL = {
    "gene_links": _gene_cascade(),
    "disease_links": _DISEASES,
    "chemical_links": _CHEMICALS,
    "link_summary": f"select status, match_mode, grouping(status, match_mode) as level, count(*) as surfaces, sum(occurrences)::bigint as occurrences from (select * from ({_DISEASES}) union all select * from ({_CHEMICALS})) group by grouping sets ((status, match_mode), (status))",
    "link_credit": f"select id, sum(occurrences)::bigint as occurrences, count(*) as surfaces from (select unnest(string_split(ids, '|')) as id, occurrences from ({_DISEASES}) where status <> 'unmatched') group by id",
    "word_cosine": _COSINE,
    "word_cosine_all": _COSINE_ALL,
    "greek_surfaces": f"select surface, occurrences from ({_surface_sql('GENETIC')}) where regexp_matches(surface, '[Ͱ-Ͽἀ-῿]') or len(list_filter(regexp_extract_all(regexp_replace(surface, '[À-ÖØ-öø-ɏ０-９Ａ-Ｚａ-ｚ\\p{{Cyrillic}}]', 'q', 'g'), '(?i)\\b({'|'.join(T.GREEK_NAMES)})\\b'), lambda w: w <> upper(w) and (lower(w) not in ('mu', 'nu', 'xi', 'pi', 'psi', 'eta', 'phi', 'chi') or w = lower(w)))) > 0",
}
