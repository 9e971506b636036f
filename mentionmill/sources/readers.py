"""Readers of the file formats of the pipeline; all are lazy and distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionmill.functions import text as T

ENTITY = "struct<text: string, label: string, domain: string, score: double, start: int, end: int>"
SENTENCE = f"struct<text: string, section_type: string, section_title: string, cues: array<string>, sim_pos: double, sim_neg: double, result_margin: double, entities: array<{ENTITY}>>"


def xml_directory(spark: SparkSession, path: str) -> DataFrame:
    """(path, pmcid, scheme, xml) of all files below a folder, one row a file."""
    x = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xml").text(path, wholetext=True)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return x.select(F.input_file_name().alias("path"), T.without_scheme(name).alias("pmcid"), F.when(name.endswith(".grobid.tei.xml"), "tei").otherwise("jats").alias("scheme"), F.col("value").alias("xml"))


def sentence_documents(spark: SparkSession, path: str) -> DataFrame:
    """(pmid, sent_ord, text, ...) of per-document JSON records; unreadable files drop out."""
    x = spark.read.schema(f"source_file string, format string, sentences array<{SENTENCE}>").option("multiLine", "true").option("mode", "DROPMALFORMED").json(path)
    x = x.select(F.regexp_replace("source_file", r"\.[^.]*$", "").alias("pmid"), "format", F.posexplode("sentences").alias("sent_ord", "s"))
    return x.select("pmid", "format", "sent_ord", "s.*")


def json_map(spark: SparkSession, path: str, entry: str) -> DataFrame:
    """(file, key, entry fields) of files that hold one JSON object keyed by surface; ``entry`` is the entry's fields as DDL."""
    x = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.from_json("value", f"map<string, struct<{entry}>>").alias("m"))
    return x.select("file", F.explode("m").alias("key", "e")).select("file", "key", "e.*")


def scalar_or_list(c: str) -> str:
    """SQL for a VARIANT field that holds one text or a list of texts, as a list."""
    return f"coalesce(try_variant_get({c}, '$', 'array<string>'), case when {c} is not null and not is_variant_null({c}) then array(try_variant_get({c}, '$', 'string')) end)"


def gene_list(spark: SparkSession, path: str) -> DataFrame:
    """A gene list in its download form, response.docs[]; fields that hold one text or several come out as lists."""
    v = spark.read.text(path, wholetext=True).select(F.explode(F.try_variant_get(F.try_parse_json("value"), "$.response.docs", "array<variant>")).alias("d"))
    one = lambda f: F.try_variant_get("d", f"$.{f}", "string").alias(f)
    many = ("alias_symbol", "prev_symbol", "name", "alias_name", "prev_name", "gene_group")
    x = v.select(one("hgnc_id"), one("symbol"), *[F.try_variant_get("d", f"$.{f}", "variant").alias(f) for f in many])
    return x.selectExpr("hgnc_id", "symbol", *[f"{scalar_or_list(f)} as {f}" for f in many])


def ontology(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(terms, edges) of an OBO graph file: graphs[0].nodes and .edges, ids as prefix:number."""
    g = spark.read.schema("graphs array<struct<nodes: array<struct<id: string, lbl: string, meta: struct<deprecated: boolean, synonyms: array<struct<pred: string, val: string>>>>>, edges: array<struct<sub: string, pred: string, obj: string>>>>").option("multiLine", "true").json(path)
    n = g.select(F.explode(F.col("graphs")[0]["nodes"]).alias("n"))
    terms = n.select(T.curie(F.col("n.id")).alias("id"), F.col("n.lbl").alias("label"), F.col("n.meta.deprecated").alias("deprecated"), F.coalesce("n.meta.synonyms", F.array().cast("array<struct<pred:string,val:string>>")).alias("synonyms"))
    e = g.select(F.explode(F.col("graphs")[0]["edges"]).alias("e"))
    return terms, e.select(T.curie(F.col("e.sub")).alias("sub"), "e.pred", T.curie(F.col("e.obj")).alias("obj"))


def tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", "true").option("quote", "").csv(path)


def counted_surfaces(spark: SparkSession, path: str) -> DataFrame:
    """(surface, occurrences) of a tab-separated file; rows without a whole number in the second field drop out."""
    f = F.split("value", "\t")
    x = spark.read.text(path).select(F.get(f, F.lit(0)).alias("surface"), F.get(f, F.lit(1)).alias("n"))
    return x.where(F.col("n").rlike("^[0-9]+$")).select("surface", F.col("n").cast("bigint").alias("occurrences"))


def annotated_documents(spark: SparkSession, path: str) -> DataFrame:
    """Annotated documents, as a JSON list or as {split: [...]}; the split is a column, null for a list."""
    doc = "struct<id: string, passages: array<struct<text: array<string>, offsets: array<array<int>>>>, entities: array<struct<id: string, type: string, text: array<string>, offsets: array<array<int>>>>, relations: array<struct<type: string, arg1_id: string, arg2_id: string>>>"
    x = spark.read.text(path, wholetext=True)
    listed = F.when(F.ltrim("value").startswith("["), F.from_json("value", f"array<{doc}>"))
    keyed = F.when(F.ltrim("value").startswith("{"), F.from_json("value", f"map<string, array<{doc}>>"))
    all_ = x.select(F.lit(None).cast("string").alias("split"), F.explode(listed).alias("d")).unionByName(x.select(F.explode(keyed).alias("split", "ds")).select("split", F.explode("ds").alias("d")))
    return all_.select("split", "d.*")
