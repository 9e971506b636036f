"""Merged verdicts, the typed entity graph, and questions to it."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mentionmill.functions import text as T
from mentionmill.staging import staged

# Relation labels and the edge category they fall into; other labels stand for themselves.
CATEGORIES = {
    "upregulator/activator": "activates", "activation": "activates", "positive_correlation": "activates", "downregulator/inhibitor": "inhibits", "inhibition": "inhibits", "negative_correlation": "inhibits",
    "bind": "binds", "binds": "binds", "interacts": "interacts", "associated": "associated", "association": "associated", "cotreatment": "associated", "comparison": "associated", "drug-interaction": "associated", "conversion": "associated",
}
#: Genes that are only ever laboratory controls, and disease names too general for a node.
CONTROL_SYMBOLS = ("MKI67",)
GENERIC_DISEASES = ("neoplasm", "cancer", "os")
#: Surfaces whose linked label is wrong for a corpus, and labels that name one disease.
DISEASE_SURFACES = {"lcc": "lung large cell carcinoma"}
DISEASE_MERGES = {"lung carcinoma": "lung cancer", "lung neoplasm": "lung cancer", "breast carcinoma": "breast cancer"}


def pair_key(pair_id: Column, pmid: Column, sentence: Column, a: Column, b: Column) -> Column:
    """A pair's id, or its article, sentence and texts where it has none."""
    return F.coalesce(pair_id, F.concat_ws("\u0001", pmid, sentence, a, b))


def merged_verdicts(scored: DataFrame, typed: str, gate: str, policy: str = "union") -> DataFrame:
    """One row per pair from the rows of several models.

    Columns: key, ord (of the row that gives label and ends), score (highest), models, corroborated, label_model. Per pair and
    model the highest score counts, then the smallest ord; null scores count as 0. The typed model's row gives the label where
    there is one, else the gate's, else that of the first model by first appearance. ``gate`` keeps pairs that the gate model
    kept, ``typed`` those of the typed model with only its score, ``union`` all.
    """
    key = pair_key(F.col("pair_id"), F.col("pmid"), F.col("sentence"), F.col("subject.text"), F.col("object.text"))
    x = scored.select(key.alias("key"), "ord", F.col("predicate.model").alias("model"), F.coalesce(F.nanvl("score", F.lit(0.0)), F.lit(0.0)).alias("score"))
    per = x.groupBy("key", "model").agg(F.max(F.struct("score", (-F.col("ord")).alias("m"))).alias("b"), F.min("ord").alias("first"))
    per = per.select("key", "model", "b.score", (-F.col("b.m")).alias("ord"), "first")
    if policy not in ("union", "gate", "typed"):
        raise ValueError(f"no such policy: {policy}")
    if policy == "typed":
        per = per.where(F.col("model") == typed)
    rank = F.when(F.col("model") == typed, 0).when(F.col("model") == gate, 1).otherwise(2)
    out = per.groupBy("key").agg(
        F.min_by(F.struct("ord", "model"), F.struct(rank, F.col("first"))).alias("base"), F.max("score").alias("score"), F.array_sort(F.collect_set("model")).alias("models"),
        F.max((F.col("model") == gate).cast("int")).alias("gated"), F.array_sort(F.collect_list(F.struct("model", "score"))).alias("score_by_model"),
    )
    if policy == "gate":
        out = out.where("gated = 1")
    return out.select("key", "base.ord", "score", "models", (F.size("models") > 1).alias("corroborated"), F.col("base.model").alias("label_model"), "score_by_model")


def compared_verdicts(scored: DataFrame, a: str, b: str) -> DataFrame:
    """Full outer join of two models' best verdicts per pair: key, label_a, score_a, label_b, score_b, side."""
    key = pair_key(F.col("pair_id"), F.col("pmid"), F.col("sentence"), F.col("subject.text"), F.col("object.text"))
    x = scored.where(F.col("predicate.model").isin(a, b)).select(key.alias("key"), F.col("predicate.model").alias("model"), F.col("predicate.text").alias("label"), F.coalesce(F.nanvl("score", F.lit(0.0)), F.lit(0.0)).alias("score"), "ord")
    best = lambda m: F.max(F.when(F.col("model") == m, F.struct("score", (-F.col("ord")).alias("m"), "label")))
    y = x.groupBy("key").agg(best(a).alias("a"), best(b).alias("b"))  # both sides from one shuffle instead of a join
    side = F.when(F.col("b").isNull(), "only_a").when(F.col("a").isNull(), "only_b").otherwise("both")
    return y.select("key", F.col("a.label").alias("label_a"), F.col("a.score").alias("score_a"), F.col("b.label").alias("label_b"), F.col("b.score").alias("score_b"), side.alias("side"))


def category(label: Column, polarity: Column) -> Column:
    """The edge category of a label, with "not " before it when the statement is negated."""
    low = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    names = F.create_map(*[F.lit(v) for kv in CATEGORIES.items() for v in kv])
    cat = F.coalesce(F.try_element_at(names, low), F.nullif(low, F.lit("")), F.lit("interacts"))
    return F.when(polarity == "negated", F.concat(F.lit("not "), cat)).otherwise(cat)


def control_free(subject: Column, obj: Column) -> Column:
    """At least one end is no control, none is one, and no end is a control symbol."""
    no = F.coalesce(subject["control"] == "no", F.lit(False)) | F.coalesce(obj["control"] == "no", F.lit(False))
    yes = F.coalesce(subject["control"] == "yes", F.lit(False)) | F.coalesce(obj["control"] == "yes", F.lit(False))
    marked = F.exists(F.concat(T.symbols(subject["symbols"]), T.symbols(obj["symbols"])), lambda s: s.isin(*CONTROL_SYMBOLS))
    return no & ~yes & ~marked


def _looked_up(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(v) for kv in table.items() for v in kv]), key)


def node(end: Column, generic: tuple[str, ...] = GENERIC_DISEASES) -> Column:
    """(kind, id) of an end of a triple, or null if it cannot be a node: no single id, a control, or too general.

    A disease surface may override its label, and labels of one disease are one node.
    """
    gene, other = T.single(end["symbols"]), T.single(end["labels"])
    gene = F.when(~gene.isin(*CONTROL_SYMBOLS) & ~F.coalesce(end["control"] == "yes", F.lit(False)), gene)
    text = F.lower(F.trim(end["text"]))
    label = F.coalesce(_looked_up(DISEASE_SURFACES, text), other)
    disease = F.when(~F.lower(label).isin(*generic) & ~text.isin(*generic), F.coalesce(_looked_up(DISEASE_MERGES, F.lower(label)), label))
    of = lambda kind, v: F.when(v.isNotNull(), F.struct(F.lit(kind).alias("kind"), v.alias("id")))
    return F.when(end["type"] == "GENETIC", of("gene", gene)).when(end["type"] == "DISEASE", of("disease", disease)).when(end["type"] == "CHEMICAL", of("chemical", other))


def without_flagged(triples: DataFrame, flagged: DataFrame) -> DataFrame:
    """Triples of which no end's surface is flagged. ``flagged`` has (type, surface); surfaces compare trimmed, in lower case."""
    key = lambda kind, text: F.concat_ws("\u0001", kind, F.lower(F.trim(text)))
    f = flagged.select(key(F.col("type"), F.col("surface")).alias("_f")).distinct()
    for end in ("subject", "object"):
        triples = triples.join(f, key(F.col(f"{end}.type"), F.col(f"{end}.text")) == F.col("_f"), "left_anti")
    return triples


def drop_reason(end: Column) -> Column:
    """Why an end is no node, or null if it is one."""
    n = node(end)
    one = F.when(end["type"] == "GENETIC", T.single(end["symbols"])).otherwise(T.single(end["labels"]))
    kind = F.lower(end["type"])
    return F.when(n.isNotNull(), F.lit(None)).when(one.isNull(), F.concat(kind, F.lit(": no single id"))).when(end["type"] == "GENETIC", F.lit("genetic: control")).otherwise(F.concat(kind, F.lit(": too general")))


def relations(triples: DataFrame, min_score: float, genes_only: bool) -> DataFrame:
    """Qualifying relations between two different nodes: a, a_kind, b, b_kind (as stated), cat, sc, sentence, pmid, spec, role, ord."""
    sc = F.coalesce(F.nanvl("score", F.lit(None).cast("double")), F.lit(-1.0))
    x = triples.where(sc >= min_score).select(
        node(F.col("subject")).alias("_a"), node(F.col("object")).alias("_b"), control_free(F.col("subject"), F.col("object")).alias("_free"), category(F.col("predicate.text"), F.col("polarity")).alias("cat"), F.col("score").alias("sc"),
        "sentence", T.accession(F.col("pmid")).alias("pmid"), (F.coalesce("modality", F.lit("")) == "speculated").alias("spec"), F.col("predicate.model").alias("role"), "ord",
    )
    a, b = F.col("_a"), F.col("_b")
    gene = lambda n: n["kind"] == "gene"
    ok = a.isNotNull() & b.isNotNull() & ((a["id"] != b["id"]) | (a["kind"] != b["kind"])) & (gene(a) & gene(b) if genes_only else F.lit(True)) & ((~gene(a) & ~gene(b)) | F.col("_free"))
    # an explode keeps the rows: a filter would be pushed below the projection and work out the nodes again
    x = x.withColumn("_kept", F.explode(F.when(ok, F.array(F.lit(True)))))
    return x.select(F.col("_a.id").alias("a"), F.col("_a.kind").alias("a_kind"), F.col("_b.id").alias("b"), F.col("_b.kind").alias("b_kind"), "cat", "sc", "sentence", "pmid", "spec", "role", "ord")


def edge_sentences(rel: DataFrame) -> DataFrame:
    """One row per unordered node pair and sentence: the highest score and what its row says; ties go to the smallest ord."""
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    best = F.max(F.struct(F.col("sc"), (-F.col("ord")).alias("m"), "pmid", "cat", "spec", "role"))
    x = rel.groupBy(lo.alias("lo"), hi.alias("hi"), "sentence").agg(best.alias("b"))
    return x.select("lo", "hi", "sentence", "b.sc", "b.pmid", "b.cat", "b.spec", "b.role")


def edges(rel: DataFrame) -> DataFrame:
    """One edge per unordered pair: src, dst, cat of the best-supported direction and relation, sentences, roles.

    Support is the number of distinct sentences of (from, to, category); ties go to the larger names and category. One pass over
    the relations: statements are gathered per sentence, counted per direction and category, then per pair, each step smaller.
    """
    lo, hi = F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")
    one = rel.groupBy(lo, hi, "sentence").agg(F.collect_set(F.struct("a", "b", "cat")).alias("said"), F.max("sc").alias("best"), F.collect_set("role").alias("roles"))
    said = one.select("lo", "hi", "best", "roles", F.posexplode("said").alias("i", "s")).select("lo", "hi", "best", "roles", "i", "s.*")
    merged = F.array_distinct(F.flatten(F.collect_set("roles"))).alias("roles")
    stated = said.groupBy("lo", "hi", "a", "b", "cat").agg(F.count("*").alias("n"), F.count_if(F.col("i") == 0).alias("first"), F.max("best").alias("best"), merged)
    pair = stated.groupBy("lo", "hi").agg(F.max(F.struct("n", "a", "b", "cat")).alias("t"), F.sum("first").alias("sentences"), F.max("best").alias("best"), merged)
    return pair.select(F.col("t.a").alias("src"), F.col("t.b").alias("dst"), "t.cat", F.col("t.n").alias("support"), "sentences", F.array_sort("roles").alias("roles"), "best", F.col("t.cat").startswith("not ").alias("negative"))


def nodes(rel: DataFrame, strong: float = 0.99) -> DataFrame:
    """One row per node: kind, distinct sentences, and those with a score of at least ``strong``."""
    each = rel.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("a_kind").alias("kind")), F.struct(F.col("b").alias("id"), F.col("b_kind").alias("kind")))).alias("n"), "sentence", "sc").select("n.*", "sentence", "sc")
    per = each.groupBy("id", "kind", "sentence").agg(F.max("sc").alias("sc"))
    return per.groupBy("id", "kind").agg(F.count("*").alias("sentences"), F.count_if(F.col("sc") >= strong).alias("strong"))


# ---------------------------------------------------------------- questions
def text_matches(text: Column, query: str) -> Column:
    """Substring, or /pattern/flags, both without regard to case; a pattern or flag that is none counts as a substring.

    Of the flags, i is always on, m, s and u have their meaning, and g, y and d change nothing. The pattern is tried by the engine
    that runs it.
    """
    m = re.fullmatch(r"/(.*)/([a-z]*)", query, re.S)
    if m and set(m.group(2)) <= set("dgimsuy") and len(set(m.group(2))) == len(m.group(2)):
        pattern = f"(?{''.join(sorted({'i', *m.group(2)} - set('dgy')))})" + m.group(1)
        try:
            SparkSession.active()._jvm.java.util.regex.Pattern.compile(pattern)
            return text.rlike(pattern)
        except (Py4JJavaError, IllegalArgumentException):
            pass
    return F.lower(text).contains(query.lower())


def visible(sents: DataFrame, min_score: float, years: tuple[int, int], all_years: tuple[int, int], query: str | None = None) -> DataFrame:
    """Edge sentences in view; a null year is in view only when the whole range is."""
    lo, hi = years
    seen = F.col("year").between(lo, hi)
    if lo <= all_years[0] and hi >= all_years[1]:
        seen = seen | F.col("year").isNull()
    x = sents.where((F.col("sc") >= min_score) & F.coalesce(seen, F.lit(False)))
    return x.where(text_matches(F.col("sentence"), query)) if query else x


def undirected(pairs: DataFrame, a: str = "lo", b: str = "hi") -> DataFrame:
    """Both directions of each pair, once."""
    x = pairs.select(F.col(a).alias("u"), F.col(b).alias("v")).distinct()
    return x.unionByName(x.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()


def neighbourhood(pairs: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """(id, hop): nodes within ``hops`` steps of the seeds (column id), with the least number of steps.

    A hop is one join of the last hop's nodes with the staged edges, and what is new of it is written once.
    """
    both = staged(undirected(pairs), "edges")
    seen = edge = staged(seeds.select("id").distinct().withColumn("hop", F.lit(0)), "hop")
    for h in range(1, hops + 1):
        reached = edge.join(both, F.col("id") == F.col("u")).select(F.col("v").alias("id")).distinct()
        edge = staged(reached.join(seen, "id", "left_anti").withColumn("hop", F.lit(h)), "hop")
        seen = seen.unionByName(edge)
    return seen


def seed_nodes(nodes_: DataFrame, text: str) -> DataFrame:
    """(id): the node of that name without regard to case, else the first by id whose name begins so, else none."""
    low = F.lower("id")
    order = F.struct((low != text.lower()).alias("far"), "id")
    return nodes_.where(low.startswith(text.lower())).agg(F.min(order).alias("o")).where("o is not null").select("o.id")


def filtered_pairs(rel: DataFrame, sents: DataFrame, categories: list[str] | None = None, roles: list[str] | None = None, kinds: list[str] | None = None, least: int = 1) -> DataFrame:
    """(lo, hi, sentences): pairs with at least ``least`` of the sentences in ``sents`` whose edge has one of the categories, comes from
    one of the models and joins only nodes of the kinds; None lets all pass."""
    e = edges(rel)
    kind = rel.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("a_kind").alias("kind")), F.struct(F.col("b").alias("id"), F.col("b_kind").alias("kind")))).alias("n")).select("n.*").distinct()
    keep = e.where(F.col("cat").isin(categories) if categories is not None else F.lit(True))
    keep = keep.where(F.exists("roles", lambda r: r.isin(roles)) if roles is not None else F.lit(True)).select(F.least("src", "dst").alias("lo"), F.greatest("src", "dst").alias("hi"))
    keep = induced(keep, kind.where(F.col("kind").isin(kinds))) if kinds is not None else keep
    n = sents.groupBy("lo", "hi").agg(F.countDistinct("sentence").alias("sentences")).where(F.col("sentences") >= least)
    return n.join(keep, ["lo", "hi"], "left_semi")


def edge_counts(rel: DataFrame) -> DataFrame:
    """(cat, kinds, negative, edges): edges by category, kinds of their nodes in order, and sign."""
    kind = rel.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("a_kind").alias("kind")), F.struct(F.col("b").alias("id"), F.col("b_kind").alias("kind")))).alias("n")).select("n.*")
    kind = kind.groupBy("id").agg(F.min("kind").alias("kind"))
    x = edges(rel).join(kind.select(F.col("id").alias("src"), F.col("kind").alias("k1")), "src").join(kind.select(F.col("id").alias("dst"), F.col("kind").alias("k2")), "dst")
    return x.groupBy("cat", F.concat_ws("-", F.array_sort(F.array("k1", "k2"))).alias("kinds"), "negative").agg(F.count("*").alias("edges"))


def chosen_models(names: list[str], typed: str | None = None, gate: str | None = None, mark: str = "typed") -> tuple[str | None, str | None]:
    """The typed model (named, else the first by name that holds the mark) and the gate model (named, else the first other one)."""
    names = sorted(set(names))
    typed = typed or next((n for n in names if mark in n.lower()), None)
    return typed, gate or next((n for n in names if n != typed), None)


def induced(pairs: DataFrame, ids: DataFrame, a: str = "lo", b: str = "hi") -> DataFrame:
    """Pairs with both ends among the ids."""
    keep = ids.select("id").distinct()
    return pairs.join(keep.withColumnRenamed("id", a), a, "left_semi").join(keep.withColumnRenamed("id", b), b, "left_semi")


def min_degree(pairs: DataFrame, least: int) -> DataFrame:
    """Pairs whose ends both have at least ``least`` neighbours, measured once."""
    ok = undirected(pairs).groupBy("u").agg(F.count("*").alias("n")).where(F.col("n") >= least).select(F.col("u").alias("id"))
    return induced(pairs, ok)


def components(pairs: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id of each connected component.

    Alternating large-star and small-star rounds, which converge in a logarithmic number of rounds even on long chains; each
    round's pairs are written to the shared folder, and it ends when a round changes nothing.
    """
    both = undirected(pairs)
    lone = both.where("u = v").select(F.col("u").alias("id")).distinct()
    e = staged(both.where("u > v"), "star")
    state = None
    for _ in range(max_rounds):
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sym.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v")))
        now = Observation()
        nxt = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
        e = staged(nxt.observe(now, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), "star")
        if state == now.get:  # counted while it was written
            break
        state = now.get
    else:
        raise RuntimeError("components did not settle")
    member = e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    roots = e.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return member.unionByName(roots).unionByName(lone.withColumn("component", F.col("id"))).groupBy("id").agg(F.min("component").alias("component"))


def min_cluster(pairs: DataFrame, least: int) -> DataFrame:
    """Pairs in components of at least ``least`` nodes."""
    c = components(pairs)
    ok = c.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return induced(pairs, c.join(ok, "component").select("id"))


# ---------------------------------------------------------------- comparison of two graphs
def diff(one: DataFrame, two: DataFrame, steps: list[float], min_publications: int = 2) -> DataFrame:
    """(step, lo, hi, side, pubs_1, pubs_2): pairs of two sets of edge sentences at each score step.

    Shared pairs stay; pairs of one side need at least ``min_publications`` distinct publications.
    """
    tag = one.select("lo", "hi", "sc", "pmid", F.lit(1).alias("g")).unionByName(two.select("lo", "hi", "sc", "pmid", F.lit(2).alias("g")))
    x = tag.withColumn("step", F.explode(F.array(*[F.lit(s) for s in steps]))).where("sc >= step")
    p = x.groupBy("step", "lo", "hi").agg(F.countDistinct(F.when(F.col("g") == 1, F.col("pmid"))).alias("pubs_1"), F.countDistinct(F.when(F.col("g") == 2, F.col("pmid"))).alias("pubs_2"), F.max((F.col("g") == 1).cast("int")).alias("in_1"), F.max((F.col("g") == 2).cast("int")).alias("in_2"))
    side = F.when((F.col("in_1") == 1) & (F.col("in_2") == 1), "shared").when(F.col("in_1") == 1, "only_1").otherwise("only_2")
    return p.withColumn("side", side).where((F.col("side") == "shared") | (F.greatest("pubs_1", "pubs_2") >= min_publications)).select("step", "lo", "hi", "side", "pubs_1", "pubs_2")


def balance(d: DataFrame) -> DataFrame:
    """(step, id, degree_1, degree_2, share_1, share_2, balance): a node's share of all ends in each graph, and their difference by their sum.

    1 is a node of the first graph only, -1 of the second only. Give it all pairs (``diff`` with one publication), never a view.
    """
    both = d.select("step", F.explode(F.array("lo", "hi")).alias("id"), "side")
    n = both.groupBy("step", "id").agg(F.count_if(F.col("side") != "only_2").alias("degree_1"), F.count_if(F.col("side") != "only_1").alias("degree_2"))
    total = n.groupBy("step").agg(F.sum("degree_1").alias("t1"), F.sum("degree_2").alias("t2"))
    s = n.join(total, "step").select("step", "id", "degree_1", "degree_2", F.try_divide("degree_1", "t1").alias("share_1"), F.try_divide("degree_2", "t2").alias("share_2"))
    a, b = F.coalesce("share_1", F.lit(0.0)), F.coalesce("share_2", F.lit(0.0))
    return s.withColumn("balance", F.try_divide(a - b, a + b))


def with_targets(nodes_: DataFrame, targets: DataFrame) -> DataFrame:
    """Nodes with what is known of a gene as a drug target: n_chemicals, chemicals and tier; other nodes and genes have none.

    ``targets`` is the inverse view (gene, chemicals, n_chemicals, in_corpus, tier); only corpus genes count.
    """
    t = targets.where("in_corpus").select(F.col("gene").alias("id"), F.lit("gene").alias("kind"), "chemicals", "n_chemicals", "tier")
    x = nodes_.join(t, ["id", "kind"], "left")
    return x.withColumns({"n_chemicals": F.coalesce("n_chemicals", F.lit(0)), "chemicals": F.coalesce("chemicals", F.array().cast("array<string>")), "tier": F.coalesce("tier", F.lit("other"))})


def polarity_edges(rel: DataFrame) -> DataFrame:
    """(src, dst, negative, sentences): directed edges split by polarity instead of relation."""
    negative = F.col("cat").startswith("not ")
    return rel.groupBy(F.col("a").alias("src"), F.col("b").alias("dst"), negative.alias("negative")).agg(F.countDistinct("sentence").alias("sentences"))
