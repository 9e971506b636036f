"""Names of the reference lists, by kind: GENETIC from the gene list, DISEASE and CHEMICAL from the ontology."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Gene fields in the order of their weight.
GENE_FIELDS = ("symbol", "alias_symbol", "prev_symbol", "name", "alias_name", "prev_name")


def _ranked(values: Column, rank: int) -> Column:
    return F.transform(values, lambda v: F.struct(v.alias("name"), F.lit(rank).alias("field_rank")))


def gene_names(hgnc: DataFrame, fields=GENE_FIELDS) -> DataFrame:
    """(kind, ref_id, name, field_rank); scalar and array fields alike, null names left out."""
    kinds = dict(hgnc.dtypes)
    each = []
    for rank, f in enumerate(fields):
        values = F.col(f) if kinds[f].startswith("array") else F.array(f)
        each.append(_ranked(F.coalesce(values, F.array().cast("array<string>")), rank))
    x = hgnc.select(F.lit("GENETIC").alias("kind"), F.col("hgnc_id").alias("ref_id"), F.explode(F.flatten(F.array(*each))).alias("n"))
    return x.select("kind", "ref_id", "n.name", "n.field_rank").where("name is not null")


def term_names(obo: DataFrame, deprecated: bool = False) -> DataFrame:
    """(kind, ref_id, name, field_rank): labels and synonyms; deprecated terms only on request. A null mark means not deprecated."""
    kind = F.when(F.col("id").startswith("MONDO:"), "DISEASE").when(F.col("id").startswith("CHEBI:"), "CHEMICAL")
    ranks = F.create_map(*[F.lit(v) for i, p in enumerate(("hasExactSynonym", "hasRelatedSynonym", "hasNarrowSynonym", "hasBroadSynonym"), 1) for v in (p, i)])
    label = F.array(F.struct(F.col("label").alias("name"), F.lit(0).alias("field_rank")))
    syn = F.transform(F.coalesce("synonyms", F.array().cast("array<struct<pred:string,val:string>>")), lambda s: F.struct(s.val.alias("name"), F.coalesce(F.try_element_at(ranks, s.pred), F.lit(5)).alias("field_rank")))
    x = obo if deprecated else obo.where(~F.coalesce("deprecated", F.lit(False)))
    x = x.select(kind.alias("kind"), F.col("id").alias("ref_id"), F.explode(F.concat(label, syn)).alias("n"))
    return x.select("kind", "ref_id", "n.name", "n.field_rank").where("name is not null and kind is not null")
