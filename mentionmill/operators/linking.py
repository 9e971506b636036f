"""Priority match cascades: a surface is linked to ids by the first of many ordered passes that hits.

A cascade of n passes is not n joins. All keys that any pass would try are made in the row, exploded once, joined once with one
long index of folded names, and grouped once per surface; the smallest pass with a hit decides. A pass with several ids ends the
cascade as ambiguous, except that passes with a guard prefer the one id that was hit by its main name.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionmill.functions import text as T
from mentionmill.operators import genesets as G

Key = Callable[[Column], Column]

FOLDS: dict[str, Key] = {"as is": lambda c: c, "case": T.casefold, "hyphen": T.hyphen_space_fold, "joined": T.no_separators}


@dataclass(frozen=True)
class Pass:
    """One step: how the surface becomes a key (null: no try), how names were folded, over which fields, and what it is called."""

    mode: str | None
    fields: frozenset[str]
    key: Key
    fold: str
    guard: bool = False


def name_index(names: DataFrame, folds: Sequence[str], more: dict[str, Key] | None = None) -> DataFrame:
    """(fold, key, id, label, field, field_rank, name) from (id, label, field, field_rank, name); the best field per key and id."""
    keys = [F.struct(F.lit(f).alias("fold"), ((more or {}).get(f) or FOLDS[f])(F.col("name")).alias("key")) for f in folds]
    x = names.where("name is not null").select("id", "label", "field", "field_rank", "name", F.explode(F.array(*keys)).alias("k"))
    x = x.select("k.fold", "k.key", "id", "label", "field", "field_rank", "name").where("key is not null and key <> ''")
    best = F.min(F.struct("field_rank", "field", "name"))
    return x.groupBy("fold", "key", "id", "label", "field").agg(best.alias("b")).select("fold", "key", "id", "label", "field", "b.field_rank", "b.name")


def classified(surface: Column, name: Column) -> Column:
    return F.when(surface == name, "case-sensitive").when(T.casefold(surface) == T.casefold(name), "case-insensitive").otherwise("hyphen vs white space")


def _try(rank: Column, p: Pass, value: Column, mode: Column | None = None) -> Column:
    named = mode if mode is not None else F.lit(p.mode).cast("string")
    fields = F.array(*[F.lit(f) for f in sorted(p.fields)])
    return F.struct(rank.alias("rank"), named.alias("mode"), F.lit(p.guard).alias("guard"), F.lit(p.fold).alias("fold"), p.key(value).alias("key"), fields.alias("fields"))


def link(surfaces: DataFrame, surface: str, index: DataFrame, passes: Sequence[Pass], main_field: str) -> DataFrame:
    """All columns of ``surfaces`` with rank, match_mode, match_field, ids and labels (sorted) and status.

    status is matched, ambiguous or unmatched. A null surface is unmatched; repeated surfaces are linked alike.
    """
    once = surfaces.select(F.col(surface).alias("_s")).where("_s is not null").distinct()
    tries = F.array(*[_try(F.lit(i), p, F.col("_s")) for i, p in enumerate(passes, 1)])
    return resolve(surfaces, surface, once.select("_s", F.explode(tries).alias("t")).select("_s", "t.*"), index, main_field)


def resolve(surfaces: DataFrame, surface: str, tries: DataFrame, index: DataFrame, main_field: str) -> DataFrame:
    """``link`` for tries that are already made: _s, rank, mode, guard, fold, key, fields."""
    hit = tries.where("key is not null and key <> ''").join(index, ["fold", "key"]).where(F.array_contains("fields", F.col("field")))
    hits = hit.groupBy("_s").agg(F.collect_set(F.struct("rank", "field_rank", "name", "field", "id", "label", "mode", "guard")).alias("h"))
    hits = hits.withColumn("rank", F.array_min(F.transform("h", lambda s: s["rank"])))
    hits = hits.withColumn("w", F.array_sort(F.filter("h", lambda s: s["rank"] == F.col("rank"))))
    named = lambda s: F.struct(s["id"].alias("id"), s["label"].alias("label"))
    main = F.array_distinct(F.transform(F.filter("w", lambda s: s["field"] == main_field), named))
    every = F.array_distinct(F.transform("w", named))
    hits = hits.withColumn("best", F.get("w", F.lit(0)))
    hits = hits.withColumn("picked", F.when(F.col("best.guard") & (F.size(main) == 1), main).otherwise(every))
    mode = F.coalesce("best.mode", classified(F.col("_s"), F.col("best.name")))
    ids = F.array_sort(F.transform("picked", lambda s: s["id"]))
    labels = F.array_sort(F.transform("picked", lambda s: s["label"]))
    found = hits.select("_s", "rank", mode.alias("match_mode"), F.col("best.field").alias("match_field"), ids.alias("ids"), labels.alias("labels"))
    out = surfaces.join(found, surfaces[surface] == found["_s"], "left").drop("_s")
    return out.withColumn("status", F.when(F.col("rank").isNull(), "unmatched").when(F.size("ids") > 1, "ambiguous").otherwise("matched"))


# ---------------------------------------------------------------- genes
SYMBOLS = frozenset({"symbol", "alias_symbol", "prev_symbol"})
NAMES = frozenset({"name", "alias_name", "prev_name"})
EVERY = SYMBOLS | NAMES
APPROVED = frozenset({"symbol"})


def _stripped(pattern: str, fold: Key = T.hyphen_space_fold) -> Key:
    """The folded rest after a pattern; null where the pattern takes nothing, as earlier passes tried that key."""
    return lambda c: F.when(c.rlike(pattern), fold(F.regexp_replace(c, pattern, "")))


def _missense(pattern: str) -> Key:
    # fixed value: one-letter amino acids
    at = pattern.replace("#", "[ACDEFGHIKLMNPQRSTVWY]")
    return lambda c: F.nullif(F.regexp_extract(c, at, 1), F.lit(""))


def _anti(c: Column) -> Column:
    rest = F.regexp_replace(F.regexp_replace(c, "^[Aa]nti[- ]", ""), "(?i) antibody$", "")
    return F.when(c.rlike("^[Aa]nti[- ]"), T.hyphen_space_fold(rest))


def _lone_greek(c: Column) -> Column:
    # fixed values: Latin letters that stand for Greek ones
    x = c
    for a, b in zip("abgydezklstw", "alpha beta gamma gamma delta epsilon zeta kappa lambda sigma tau omega".split(), strict=True):
        x = F.regexp_replace(x, f"(?<![a-z]){a}(?![a-z])", b)
    return F.when((F.length(c) >= 3) & (x != c), x)


def _greek_abbreviation(c: Column) -> Column:
    x = F.coalesce(_lone_greek(c), c)
    # fixed values: abbreviations in gene names
    for a, b in (("IFN", "interferon"), ("IL", "interleukin"), ("TGF", "transforming growth factor"), ("TNF", "tumor necrosis factor"), ("IGF", "insulin-like growth factor"), ("EGF", "epidermal growth factor"), ("PDGF", "platelet-derived growth factor"), ("VEGF", "vascular endothelial growth factor")):
        x = F.regexp_replace(x, rf"(?<![A-Za-z]){a}(?=[-\s\d])", b)
    return F.when((F.length(c) >= 3) & (x != c), T.hyphen_space_fold(x))


def mature_mirna(c: Column) -> Column:
    """mir-<id> or let-7<id> for the name of one microRNA, mature or gene; null for anything else."""
    x = F.regexp_replace(F.lower(F.trim(c)), "^hsa[-_]", "")
    x = F.regexp_replace(F.regexp_replace(x, "micro ?rna|mirna", "mir"), r"[-_ ]*[35]p\b|\*+$", "")
    x = F.regexp_replace(F.regexp_replace(x, r"^mir\s*-?\s*", "mir-"), r"^let\s*-?\s*7", "let-7")
    return F.when(~c.rlike(r"(?i)[/~&]| and |cluster|family|sponge|combo"), F.nullif(F.regexp_extract(x, r"^((?:mir|let)-\d+[a-z]*)(?:-\d+)?$", 1), F.lit("")))


# Compounds, cell lines, constructs and measures that only look like a gene, by the pass that would take them for one.
NOT_DEHYPHENED = ("YC-1", "ISO-1", "IWR-1", "BMS-1", "THP-1")
NOT_JOINED = (*NOT_DEHYPHENED, "CAR-T", "CAR T", "Nec-1", "T-Ag", "T Ag", "CNI", "Cat B", "Cat-B", "LDL-C")
NOT_P_PREFIXED = ("pMIR", "pCEP4", "pORF", "pU2", "pG8", "pG4", "pE3")
NOT_MISSENSE = ("KYA1797K", "SSTR2A", "PIPK2A")


def _except(key: Key, names: Sequence[str]) -> Key:
    return lambda c: F.when(~c.isin(*names), key(c))


def gene_passes() -> list[Pass]:
    """The gene cascade, in order: gene sets and curated names first, as fields of their own."""
    hs, same = T.hyphen_space_fold, FOLDS["as is"]
    long_joined = lambda c: F.when(F.length(T.no_separators(c)) >= 4, T.no_separators(c))
    return [
        *[Pass(mode, frozenset({field}), G.set_key, "as is") for field, mode in G.MODES.items()],
        Pass(G.MODES["complex"], frozenset({"complex"}), G.nfkb_key, "as is"),
        Pass(None, frozenset({"curated"}), hs, "hyphen"),
        Pass(None, SYMBOLS, same, "as is"),
        Pass(None, SYMBOLS, hs, "hyphen"),
        Pass(None, NAMES, hs, "hyphen"),
        Pass("phospho stripped", EVERY, _stripped("^(?:[Pp]hospho[- ]|[Pp]-)"), "hyphen"),
        Pass("anti- stripped", EVERY, _anti, "hyphen"),
        Pass("cleaved- stripped", EVERY, _stripped("^[Cc]leaved-"), "hyphen"),
        Pass("protein stripped", EVERY, _stripped("[ -]protein"), "hyphen"),
        Pass("transcript/mRNA stripped", EVERY, _stripped(r"[ -](?:transcripts?|mRNAs?)\b"), "hyphen"),
        Pass("variant/mutant stripped", EVERY, _stripped(r"[ -](?:variants?|mutants?|mutations?)\b|\b(?:variants?|mutants?|mutations?)[ -]"), "hyphen"),
        Pass("missense stripped", APPROVED, _except(_missense(r"^(.+?)#\d+#$"), NOT_MISSENSE), "as is"),
        Pass("missense stripped", APPROVED, _except(_missense(r"^(.+) #\d+#$"), NOT_MISSENSE), "as is"),
        Pass("inhibitor-i stripped", SYMBOLS, _stripped("i$", same), "as is"),
        Pass("miR mature→gene", frozenset({"mirna"}), mature_mirna, "mirna"),
        Pass("promoter stripped", SYMBOLS, _stripped("(?i)(?: gene promoter| promoter region| promoter)$"), "hyphen"),
        Pass("hyphen-removed", SYMBOLS, _except(lambda c: F.when(c.rlike("^[A-Z]+-[0-9]+$"), T.casefold(F.translate(c, "-", ""))), NOT_DEHYPHENED), "case", guard=True),
        Pass("p-prefix stripped", SYMBOLS, _except(lambda c: F.when(c.rlike("^p[A-Z]"), hs(F.substring(c, F.lit(2), F.length(c)))), NOT_P_PREFIXED), "hyphen", guard=True),
        Pass("WT stripped", SYMBOLS, _stripped("^(?:WT |[Ww]ild[ -]?type )"), "hyphen"),
        Pass("nuclear stripped", SYMBOLS, _stripped("^nuclear "), "hyphen"),
        Pass("regulatory target-set (not the gene)", SYMBOLS, _stripped("(?i) target genes$"), "hyphen"),
        Pass("histone", frozenset(v for v, _ in G.HISTONES), G.histone_key, "as is"),
        Pass("c-oncogene→gene alias", APPROVED, G.oncogene_key, "hyphen", guard=True),
        Pass("greek-letter spelled out", EVERY, lambda c: T.hyphen_space_fold(_lone_greek(c)), "hyphen", guard=True),
        Pass("greek-letter spelled out", EVERY, _greek_abbreviation, "hyphen", guard=True),
        Pass("greek letters spelled out", EVERY, lambda c: F.when(T.is_greek(c), T.hyphen_space_fold(T.greek_spelled(c))), "greek", guard=True),
        Pass("separator-removed", APPROVED, _except(T.no_separators, NOT_JOINED), "joined"),
        Pass("separator-removed", frozenset({"alias_symbol", "prev_symbol"}), _except(long_joined, NOT_JOINED), "joined"),
    ]


def _as_field(values: Column, field: str, rank: int) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(field).alias("field"), F.lit(rank).alias("field_rank"), v.alias("name")))


def gene_names(hgnc: DataFrame, curated: DataFrame | None = None) -> DataFrame:
    """(id, label, field, field_rank, name) of a gene list; microRNA genes also under their own field. ``curated`` has name and symbol."""
    kinds = dict(hgnc.dtypes)
    order = ("symbol", "alias_symbol", "prev_symbol", "name", "alias_name", "prev_name")
    values = lambda f: F.coalesce(F.col(f) if kinds[f].startswith("array") else F.array(f), F.array().cast("array<string>"))
    each = [_as_field(values(f), f, r) for r, f in enumerate(order)]
    x = hgnc.select(F.col("hgnc_id").alias("id"), F.col("symbol").alias("label"), F.explode(F.flatten(F.array(*each))).alias("n")).select("id", "label", "n.*").where("name is not null")
    mirna = x.where(F.col("label").startswith("MIR") & F.col("field").isin(*SYMBOLS)).withColumn("field", F.lit("mirna"))
    x = x.unionByName(mirna).unionByName(G.set_names(hgnc))
    if curated is not None:
        own = curated.join(hgnc.select("hgnc_id", "symbol"), "symbol").select(F.col("hgnc_id").alias("id"), F.col("symbol").alias("label"), F.lit("curated").alias("field"), F.lit(-1).alias("field_rank"), "name")
        x = x.unionByName(own)
    return x


# Surfaces that the cascade links to the wrong gene through an alias, and their symbol.
CORRECTIONS = {"pYAP": "YAP1", "nuclear YAP": "YAP1", "YAP target genes": "YAP1"}


def with_corrections(linked: DataFrame, surface: str, hgnc: DataFrame, corrections: dict[str, str] = CORRECTIONS) -> DataFrame:
    """Linked surfaces with the listed ones set to their symbol: the mode stays, the field is ``manual``.

    Surfaces that nothing had linked get the mode ``manual`` too; a symbol that the gene list lacks is its own id.
    """
    t = linked.sparkSession.createDataFrame(list(corrections.items()), "_c string, _symbol string")
    t = t.join(hgnc.select(F.col("symbol").alias("_symbol"), "hgnc_id"), "_symbol", "left").groupBy("_c", "_symbol").agg(F.min("hgnc_id").alias("_id"))
    x = linked.join(t, linked[surface] == t["_c"], "left")
    hit = F.col("_c").isNotNull()
    new = {"match_mode": F.coalesce("match_mode", F.lit("manual")), "match_field": F.lit("manual"), "ids": F.array(F.coalesce("_id", "_symbol")), "labels": F.array("_symbol"), "status": F.lit("matched")}
    return x.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in new.items()}).drop("_c", "_symbol", "_id")


def link_genes(surfaces: DataFrame, surface: str, hgnc: DataFrame, curated: DataFrame | None = None) -> DataFrame:
    greek = {"greek": lambda c: T.hyphen_space_fold(T.greek_spelled(c)), "mirna": mature_mirna}
    index = name_index(gene_names(hgnc, curated), ["as is", "case", "hyphen", "joined", "greek", "mirna"], greek)
    return with_corrections(link(surfaces, surface, index, gene_passes(), "symbol"), surface, hgnc)


# ---------------------------------------------------------------- gene surfaces with Greek letters
_WORDS = "|".join(sorted(T.GREEK_NAMES, key=len, reverse=True))
# Remainders that must not be linked without their Greek letter, and words of state and of molecule.
KEEPS_LETTER = ("sma", "gc", "b7", "cat", "syn", "arrestin", "arrestin 1", "arrestin 2", "gal", "ar")
STATES = "nuclear cytoplasmic cytosolic membrane mutant wild-type wildtype wt serum total active cleaved soluble recombinant endogenous secreted mature"
MOLECULES = "proteins? mrna genes? antibody antibodies mab isoforms? promoter reporter constructs? staining expression levels? mutants? deletion fragment sirna shrna cdna peptide targets?"
RESIDUES = "ala|arg|asn|asp|cys|gln|glu|gly|his|ile|leu|lys|met|phe|pro|ser|thr|trp|tyr|val"


def _changed(pattern: str, rest: str = "", least: int = 1) -> Key:
    """The value after a replacement, or null where nothing changed or too little is left."""
    def f(c: Column) -> Column:
        x = F.trim(F.regexp_replace(c, pattern, rest))
        return F.when((x != c) & (F.length(x) >= least), x)

    return f


def _unless_kept(f: Key) -> Key:
    return lambda c: F.when(~T.casefold(f(c)).isin(*KEEPS_LETTER), f(c))


_split = _changed(rf"(?i)([a-z0-9])({_WORDS})$", "$1 $2")
_regroup = _changed(rf"^([A-Z]+)-(\d+)({_WORDS})$", "$1$2 $3")
_regroup_any = _changed(rf"(?i)^([a-z]+)-(\d+)({_WORDS})$", "$1$2 $3")
_interferon = _changed(rf"^IFN-?({_WORDS})$", "interferon $1")
_no_alpha = _unless_kept(_changed("^alpha(?=[A-Za-z])"))
_no_letter = _unless_kept(_changed(rf"(?i)^(?:{'|'.join(w for w in T.GREEK_NAMES if w != 'alpha')})[- ]?(?=[A-Za-z])", least=2))
_no_state = _changed(rf"(?i)^(?:(?:{STATES.replace(' ', '|')})\s+)+|(?:\s+(?:{MOLECULES.replace(' ', '|')}))+$")
_no_residue = _changed(rf"(?i)\s*\(\s*(?:{RESIDUES}|[sty])-?\d*\s*\)|\s+(?:(?:{RESIDUES})\d+[a-z]?|[acdefghiklmnpqrstvwy]\d+[acdefghiklmnpqrstvwy]|serine|threonine|tyrosine)(?=\s|$)|-(?:(?:{RESIDUES})\d+[a-z]?|[acdefghiklmnpqrstvwy]\d+[acdefghiklmnpqrstvwy])$")


def greek_passes() -> list[Pass]:
    """What is tried on one value, in order; names are folded in the same three ways."""
    three = [("as is", "case-sensitive"), ("case", "case-insensitive"), ("hyphen", "hyphen/whitespace")]
    then = lambda f, fold: lambda c: FOLDS[fold](f(c))
    out = [Pass(mode, EVERY, FOLDS[fold], fold, True) for fold, mode in three]
    out += [Pass("greek-letter split", EVERY, then(_split, fold), fold, True) for fold, _ in three]
    out += [Pass("letter-number split", EVERY, then(_regroup, fold), fold, True) for fold, _ in three]
    out.append(Pass("letter-number split (ci)", EVERY, then(_regroup_any, "hyphen"), "hyphen", True))
    out += [Pass("IFN expansion", EVERY, then(_interferon, "case"), "case", True), Pass("alpha-stripped", EVERY, then(_no_alpha, "case"), "case", True), Pass("leading-greek strip", EVERY, then(_no_letter, "case"), "case", True), Pass("separator-deletion", EVERY, T.no_separators, "joined", True)]
    return out


def link_greek_genes(surfaces: DataFrame, surface: str, hgnc: DataFrame, curated: DataFrame | None = None) -> DataFrame:
    """Surfaces with Greek letters through their own cascade.

    The raw surface comes first, then curated names, then the passes on the surface with its letters spelled out. Removing a
    reagent prefix or a phospho mark starts the passes over on the rest, once; so do removing words of state or molecule and
    removing residues. The restarts are unrolled: rank = 10,000 * cleaning + 100 * restart + pass, with each step exploded
    before the next, so the plan stays one join.
    """
    index = name_index(gene_names(hgnc, curated), ["as is", "case", "hyphen", "joined"])
    once = surfaces.select(F.col(surface).alias("_s")).where("_s is not null").distinct().withColumn("e", T.greek_words(F.col("_s")))
    variant = lambda at, mode, v: F.struct(F.lit(at).alias("at"), F.lit(mode).cast("string").alias("m"), v.alias("v"))
    e = F.col("e")
    cleaned = once.select("_s", F.explode(F.array(variant(0, None, e), variant(1, "qualifier-stripped", _no_state(e)), variant(2, "residue-stripped", _no_residue(e)))).alias("a")).where("a.v is not null")
    v = F.col("a.v")
    starts = F.array(variant(0, None, v), variant(50, "prefix-stripped", _changed("^(?:pro|sh|si|p)(?=[A-Z])")(v)), variant(60, "phospho-stripped", _changed("(?i)^phospho-")(v)), variant(70, "p- stripped", _changed("^p-")(v)))
    restarted = cleaned.select("_s", "a", F.explode(starts).alias("b")).where("b.v is not null")
    at = F.col("a.at") * 10_000 + F.col("b.at") * 100
    tries = F.array(*[_try(at + i + 10, p, F.col("b.v"), F.coalesce("a.m", "b.m", F.lit(p.mode))) for i, p in enumerate(greek_passes())])
    first = [Pass("key case-insensitive", EVERY, T.casefold, "case", True), Pass("curated synonym", frozenset({"curated"}), T.casefold, "case")]
    raw = once.select("_s", F.explode(F.array(*[_try(F.lit(i), p, F.col("_s") if i == 1 else e) for i, p in enumerate(first, 1)])).alias("t")).select("_s", "t.*")
    return resolve(surfaces, surface, raw.unionByName(restarted.select("_s", F.explode(tries).alias("t")).select("_s", "t.*")), index, "symbol")


# ---------------------------------------------------------------- ontology terms
def term_passes() -> list[Pass]:
    """The ontology cascade: curated, as is, case, hyphen, American singulars, joined. Several keys of one step are passes in order."""
    every = frozenset({"label", "exact", "related", "narrow", "broad"})
    folded, us = T.casefold, lambda c: T.american(T.casefold(c))
    nth = lambda base, i: lambda c: F.get(T.singulars(base(c)), F.lit(i))
    steps = [Pass("curated synonym", frozenset({"curated"}), folded, "case", True), Pass("case-sensitive", every, FOLDS["as is"], "as is", True), Pass("case-insensitive", every, folded, "case", True), Pass("hyphen/whitespace", every, T.hyphen_space_fold, "hyphen", True)]
    for base in (us, folded):
        steps += [Pass("normalized", every, base, "case", True)] + [Pass("normalized", every, nth(base, i), "case", True) for i in range(3)]
    return [*steps, Pass("separator-deletion", every, T.no_separators, "joined", True)]


def term_names(obo: DataFrame, prefix: str, curated: DataFrame | None = None) -> DataFrame:
    """(id, label, field, field_rank, name) of the live, labelled terms with an id prefix."""
    # fixed values: synonym kinds, best first
    ranks = {"hasExactSynonym": ("exact", 1), "hasRelatedSynonym": ("related", 2), "hasNarrowSynonym": ("narrow", 3), "hasBroadSynonym": ("broad", 4)}
    pick = lambda i, kind: F.create_map(*[F.lit(v) for p, fr in ranks.items() for v in (p, fr[i])])
    live = obo.where(F.col("id").startswith(prefix) & ~F.coalesce("deprecated", F.lit(False)) & F.col("label").isNotNull() & (F.col("label") != ""))
    label = F.array(F.struct(F.lit("label").alias("field"), F.lit(0).alias("field_rank"), F.col("label").alias("name")))
    syn = F.transform(F.coalesce("synonyms", F.array().cast("array<struct<pred:string,val:string>>")), lambda s: F.struct(F.try_element_at(pick(0, str), s["pred"]).alias("field"), F.try_element_at(pick(1, int), s["pred"]).alias("field_rank"), s["val"].alias("name")))
    x = live.select("id", "label", F.explode(F.concat(label, syn)).alias("n")).select("id", "label", "n.*").where("name is not null and name <> '' and field is not null")
    if curated is not None:
        x = x.unionByName(curated.join(live.select("id", "label"), "label").select("id", "label", F.lit("curated").alias("field"), F.lit(-1).alias("field_rank"), "name"))
    return x


def link_terms(surfaces: DataFrame, surface: str, obo: DataFrame, prefix: str, curated: DataFrame | None = None) -> DataFrame:
    index = name_index(term_names(obo, prefix, curated), ["as is", "case", "hyphen", "joined"])
    return link(surfaces, surface, index, term_passes(), "label")


# ---------------------------------------------------------------- lookups and fallbacks
def lookup_cascade(rows: DataFrame, key: Column, libraries: Sequence[tuple[str, DataFrame, Key]]) -> DataFrame:
    """Rows with ``value`` and ``via`` from the first library that holds the key.

    A library is (route, (key, value, ord), fold of the key); of its repeated keys the smallest ord counts. All libraries are
    one table, so this is one join whatever their number.
    """
    lib = None
    for i, (route, df, _) in enumerate(libraries):
        one = df.groupBy("key").agg(F.min_by("value", "ord").alias("value")).select(F.lit(i).alias("_i"), F.lit(route).alias("via"), "key", "value")
        lib = one if lib is None else lib.unionByName(one)
    # what a key finds depends on the key only, so distinct keys are looked up and joined back by their value
    x = rows.withColumn("_key", key)
    once = x.select("_key").where("_key is not null").distinct()
    tries = F.array(*[F.struct(F.lit(i).alias("_i"), fold(F.col("_key")).alias("key")) for i, (_, _, fold) in enumerate(libraries)])
    hit = once.select("_key", F.explode(tries).alias("t")).select("_key", "t.*").join(lib, ["_i", "key"])
    best = hit.groupBy("_key").agg(F.min_by(F.struct("value", "via"), "_i").alias("b")).select("_key", "b.*")
    return x.join(best, "_key", "left").drop("_key")


def bag_cosine(surfaces: DataFrame, surface: str, names: DataFrame, threshold: float = 0.99, rare: int | None = 2) -> DataFrame:
    """(surface, id, name, cosine): multi-word surfaces and names whose word counts point the same way.

    Only pairs that share one of the surface's ``rare`` rarest words are compared; rarity counts the names that hold a word,
    ties go to the first word of the surface. That loses pairs, and the more the lower the threshold. With ``rare`` None every
    pair that reaches the threshold, above 0, is found. Surfaces that equal the name in folded case are left out.
    """
    words = lambda c: F.filter(F.split(T.casefold(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    s = surfaces.select(F.col(surface).alias("surface")).distinct().withColumn("w", words(F.col("surface"))).where(F.size("w") > 1)
    n = names.select("id", "name").distinct().withColumn("w", words(F.col("name"))).where(F.size("w") > 1)
    n_words = n.select("id", "name", F.explode("w").alias("word")).groupBy("id", "name", "word").agg(F.count("*").alias("k"))
    df = n_words.groupBy("word").agg(F.count("*").alias("df"))
    s_words = s.select("surface", F.posexplode("w").alias("at", "word")).groupBy("surface", "word").agg(F.min("at").alias("at"), F.count("*").alias("k"))
    ranked = s_words.join(df, "word", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    if rare is None:
        cand = _reaching(ranked, n_words.join(df, "word"), threshold)
    else:
        rarest = ranked.withColumn("r", F.row_number().over(Window.partitionBy("surface").orderBy("df", "at"))).where(F.col("r") <= rare)
        cand = rarest.join(n_words.select("id", "name", "word"), "word").select("surface", "id", "name").distinct()
    square = lambda c: F.aggregate(F.transform(F.array_distinct(c), lambda u: F.size(F.filter(c, lambda v: v == u)).cast("double")), F.lit(0.0), lambda t, k: t + k * k)
    both = cand.join(s.select("surface", F.col("w").alias("a")), "surface").join(n.select("id", "name", F.col("w").alias("b")), ["id", "name"])
    dot = F.aggregate(F.transform(F.array_intersect("a", "b"), lambda u: (F.size(F.filter("a", lambda v: v == u)) * F.size(F.filter("b", lambda v: v == u))).cast("double")), F.lit(0.0), lambda t, k: t + k)
    both = both.withColumn("cosine", dot / F.sqrt(square(F.col("a")) * square(F.col("b"))))
    keep = (F.col("cosine") >= threshold) & (T.casefold(F.col("surface")) != T.casefold(F.col("name")))
    return both.where(keep).select("surface", "id", "name", "cosine")


def _reaching(s_words: DataFrame, n_words: DataFrame, threshold: float) -> DataFrame:
    """(surface, id, name) of a superset of the pairs with a cosine of ``threshold`` or more; both sides have word, k and df.

    Both sides order their words alike, rarest first. All common words of a pair stand at or behind its first common word, so its
    dot product is at most the product of the lengths of the two rests from there. A word is a key only where that rest can
    reach the threshold: in each side's own prefix, and then in the pair.
    """
    least = threshold * threshold * (1 - 1e-9)

    def prefix(words: DataFrame, key: list[str], side: str) -> DataFrame:
        # frames over rows: the words of a surface or name are distinct
        behind = Window.partitionBy(*key).orderBy("df", "word").rowsBetween(0, Window.unboundedFollowing)
        square = F.col("k") * F.col("k")
        x = words.select(*key, "word", F.sum(square).over(behind).alias(f"rest_{side}"), F.sum(square).over(Window.partitionBy(*key)).alias(f"all_{side}"))
        return x.where(F.col(f"rest_{side}") >= least * F.col(f"all_{side}"))

    pair = prefix(s_words, ["surface"], "s").join(prefix(n_words, ["id", "name"], "n"), "word")
    able = F.col("rest_s").cast("double") * F.col("rest_n") >= least * F.col("all_s").cast("double") * F.col("all_n")
    return pair.where(able).select("surface", "id", "name").distinct()
