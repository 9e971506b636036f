"""The queries of this subpackage, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionmill.llm import canonical, confusables, cooccurrence, frequency, leakage, listed, mixing, sentences, survivorship
from mentionmill.session import table

NORMALIZED = "triples_genetic_disease_chemical_normalized"


def article(c: str = "pmid"):
    """The article id: what stands before the first dot."""
    return F.substring_index(F.col(c), ".", 1)


def _gene_pairs(spark: SparkSession, d: str, min_pairs: int, *record: str) -> DataFrame:
    t = table(spark, d, NORMALIZED)
    both = F.concat(F.coalesce("subject.hgnc_symbol", F.array()), F.coalesce("object.hgnc_symbol", F.array()))
    symbols = F.transform(F.split(F.array_join(both, "|"), r"\|"), lambda x: F.trim(x))
    return cooccurrence.associations(t, cooccurrence.record_key(article(), *map(F.col, record)), symbols, min_pairs)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    x = _gene_pairs(spark, d, 5, "sentence").where(cooccurrence.exceeds_chance(8))
    return x.select(F.col("a").alias("symbol_a"), F.col("b").alias("symbol_b"))


def _report(pairs: DataFrame) -> DataFrame:
    ratio = F.col("n_ab").cast("double") * F.col("n") / F.col("n_a") / F.col("n_b")
    return pairs.select(F.col("a").alias("symbol_a"), F.col("b").alias("symbol_b"), "n_ab", "n_a", "n_b", F.round(ratio, 3).alias("lift"))


def p1_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of a sentence with its counts and the ratio to chance."""
    return _report(_gene_pairs(spark, d, 1, "sentence"))


def p1_articles(spark: SparkSession, d: str) -> DataFrame:
    """The same with whole articles as records, for pairs in at least two: baskets of many genes, the largest in blocks."""
    return _report(_gene_pairs(spark, d, 2))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return survivorship.best_verdicts(table(spark, d, "triples_re"), table(spark, d, "relation_models"))


def _listed_names(spark: SparkSession, d: str) -> DataFrame:
    """All names with their entries; those of deprecated terms are blocked."""
    obo = table(spark, d, "obo_term")
    dead = F.coalesce("deprecated", F.lit(False))
    live = listed.gene_names(table(spark, d, "hgnc")).unionByName(listed.term_names(obo)).withColumn("blocked", F.lit(False))
    return live.unionByName(listed.term_names(obo.where(dead), deprecated=True).withColumn("blocked", F.lit(True)))


# What is added to the names of these tables without meaning another thing.
QUALIFIERS = canonical.Rules(
    before={
        "GENETIC": frozenset("mutant wild type wildtype wt anti phospho phosphorylated p human mouse murine rat recombinant total nuclear cleaved endogenous native the".split()),
        "DISEASE": frozenset("chronic acute severe mild advanced early late the".split()),
        "CHEMICAL": frozenset("oral free the".split()),
    },
    after={
        "GENETIC": frozenset("mrna gene genes protein proteins antibody transcript promoter mutant variant expression locus level levels".split()),
        "DISEASE": frozenset("nos chronic acute unspecified type".split()),
        "CHEMICAL": frozenset("oral free base reference grade injection solution tablet".split()),
    },
)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, NORMALIZED)
    own = lambda n: F.when(F.col(f"{n}.type") == "GENETIC", F.col(f"{n}.hgnc_symbol")).when(F.col(f"{n}.type") == "DISEASE", F.col(f"{n}.mondo_label")).when(F.col(f"{n}.type") == "CHEMICAL", F.col(f"{n}.chebi_label"))
    end = lambda n: F.struct(F.lit(n).alias("role"), F.col(f"{n}.type").alias("kind"), F.col(f"{n}.text").alias("text"), own(n).alias("labels"))
    ends = t.select("ord", F.explode(F.array(end("subject"), end("object"))).alias("e")).select("ord", "e.*")
    names = _listed_names(spark, d)
    main = names.where("field_rank = 0 and not blocked").select("kind", "ref_id", F.col("name").alias("label"))
    meant = ends.select("kind", F.explode("labels").alias("label")).groupBy("kind", "label").agg(F.count("*").alias("n"))
    frequency = meant.join(main, ["kind", "label"]).groupBy("ref_id").agg(F.sum("n").alias("n"))
    open_ends = ends.where(F.coalesce(F.size("labels"), F.lit(0)) < 1)
    return canonical.closest_entries(open_ends, ["ord", "role"], names, frequency, QUALIFIERS).select("ord", "role", "ref_id")


def _surface_counts(spark: SparkSession, d: str) -> DataFrame:
    return frequency.marked_frequencies(table(spark, d, "clean_genetic_ne"), article(), "clean_genetic_ne", "occurrences", "counted_at", "row_id").withColumnRenamed("value", "clean_genetic_ne")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _surface_counts(spark, d).where("mark is not null").select("clean_genetic_ne", "mark")


def p4_counts(spark: SparkSession, d: str) -> DataFrame:
    """Every surface with its total, its number of articles and its mark."""
    return _surface_counts(spark, d).select("clean_genetic_ne", "total", "records", "mark")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    genes = listed.gene_names(table(spark, d, "hgnc"), ("symbol", "alias_symbol", "prev_symbol", "name", "alias_name"))
    names = genes.unionByName(listed.term_names(table(spark, d, "obo_term"), deprecated=True))
    surfaces = table(spark, d, "clean_genetic_ne").select(F.lit("clean_genetic_ne").alias("field"), F.col("row_id").alias("row_key"), F.lit("GENETIC").alias("kind"), F.col("clean_genetic_ne").alias("text"))
    end = lambda n: F.struct(F.lit(n).alias("field"), F.col("ord").alias("row_key"), F.col(f"{n}.type").alias("kind"), F.col(f"{n}.text").alias("text"))
    ends = table(spark, d, "triples").select(F.explode(F.array(end("subject"), end("object"))).alias("e")).select("e.*")
    return confusables.looks_like(surfaces.unionByName(ends), names).select("field", "row_key", "plain").distinct()


def _leaking(spark: SparkSession, d: str, f) -> DataFrame:
    return f(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "lang", "text")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaking(spark, d, leakage.leaks)


def p7_scrubbed(spark: SparkSession, d: str) -> DataFrame:
    """Documents with leaks after their leaked spans were taken out."""
    return _leaking(spark, d, leakage.scrubbed)


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(table(spark, d, "documents"), "doc_id", "text", "source", table(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares that the mix really reaches."""
    return mixing.reached(p8_mix(spark, d), table(spark, d, "mix_targets"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(table(spark, d, "documents"), "doc_id", "text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_pairs, p1_articles, p2_found, p3_found, p4_found, p4_counts, p6_found, p7_found, p7_scrubbed, p8_mix, p8_shares, p9_found)}
