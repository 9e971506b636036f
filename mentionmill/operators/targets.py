"""Drug targets: roles of chemicals and interaction tables mapped to genes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionmill.functions import text as T
from mentionmill.operators import flags


def chemical_roles(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(chemical, label, role) along has_role edges (sub, pred, obj) between nodes (id, label)."""
    e = edges.where(F.col("pred").rlike("(?i)has_role$|RO_0000087$")).select("sub", "obj").distinct()
    x = e.join(nodes.select(F.col("id").alias("sub"), "label"), "sub").join(nodes.select(F.col("id").alias("obj"), F.col("label").alias("role")), "obj")
    return x.select(F.col("sub").alias("chemical"), "label", "role")


def role_targets(roles: DataFrame, names: DataFrame) -> DataFrame:
    """(chemical, label, role, action, class, symbol): target roles whose name is a gene's, by folded name, else without separators.

    ``names`` has (label, name). One join: both folds of a role's target are tried, the exact one wins.
    """
    # fixed value: what makes a role one that acts on a protein
    acts = roles.where(F.col("role").rlike("(?i)" + "|".join(flags.ACTIONS)))
    t = acts.withColumn("target", flags.target_name(F.col("role"))).where("target is not null")
    keys = lambda c: F.array(F.struct(F.lit(0).alias("fold"), T.casefold(c).alias("key")), F.struct(F.lit(1).alias("fold"), T.no_separators(c).alias("key")))
    n = names.select("label", F.explode(keys(F.col("name"))).alias("k")).select(F.col("label").alias("symbol"), "k.*").distinct()
    hit = t.select("chemical", "label", "role", F.explode(keys(F.col("target"))).alias("k")).select("chemical", "label", "role", "k.*").join(n, ["fold", "key"])
    best = hit.groupBy("chemical", "label", "role").agg(F.min("fold").alias("fold"))
    x = hit.join(best, ["chemical", "label", "role", "fold"]).select("chemical", "label", "role", "symbol").distinct()
    return x.withColumn("action", flags.action_of(F.col("role"))).withColumn("class", flags.target_class(F.col("role")))


def interactions(table: DataFrame) -> DataFrame:
    """(drug, gene, type, approved, anti_neoplastic) of an interaction table, its columns found without regard to case."""
    have = {c.lower(): c for c in table.columns}
    pick = lambda *names: F.coalesce(*[F.nullif(F.trim(F.col(have[n])), F.lit("")) for n in names if n in have] or [F.lit(None).cast("string")])
    yes = lambda n: F.lower(F.coalesce(pick(n), F.lit(""))).isin("true", "1", "yes", "t")
    x = table.select(flags.drug_key(pick("drug_name", "drug_claim_name")).alias("drug"), pick("gene_name", "gene").alias("gene"), F.coalesce(pick("interaction_type", "interaction_types"), F.lit("unknown")).alias("type"), yes("approved").alias("approved"), yes("anti_neoplastic").alias("anti_neoplastic"))
    return x.where("drug is not null and gene is not null").distinct()


def drug_targets(chemicals: DataFrame, known: DataFrame) -> DataFrame:
    """(chemical, gene, type, approved, anti_neoplastic): interactions of corpus chemicals (chemical, name) by their names."""
    c = chemicals.select("chemical", flags.drug_key(F.col("name")).alias("drug")).where("drug is not null").distinct()
    return c.join(known, "drug").select("chemical", "gene", "type", "approved", "anti_neoplastic").distinct()


def uncovered_drugs(known: DataFrame, chemicals: DataFrame) -> DataFrame:
    """Interactions of drugs that are no corpus chemical."""
    return known.join(chemicals.select(flags.drug_key(F.col("name")).alias("drug")).where("drug is not null").distinct(), "drug", "left_anti")


def by_gene(targets: DataFrame, corpus_genes: DataFrame) -> DataFrame:
    """(gene, chemicals, n_chemicals, in_corpus, tier): the inverse view; tier tells approved anti-neoplastic, approved, other."""
    g = targets.groupBy("gene").agg(F.array_sort(F.collect_set("chemical")).alias("chemicals"), F.max(F.col("approved") & F.col("anti_neoplastic")).alias("a"), F.max("approved").alias("b"))
    g = g.join(corpus_genes.select("gene").distinct().withColumn("in_corpus", F.lit(True)), "gene", "left")
    tier = F.when(F.col("a"), "approved anti-neoplastic").when(F.col("b"), "approved").otherwise("other")
    return g.select("gene", "chemicals", F.size("chemicals").alias("n_chemicals"), F.coalesce("in_corpus", F.lit(False)).alias("in_corpus"), tier.alias("tier"))
