"""Queries over nested article records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionmill.operators import nested
from mentionmill.session import table


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.record_nodes(table(spark, d, "ner_records"), "record_id", "payload")


def p5_entities(spark: SparkSession, d: str) -> DataFrame:
    """The entities of all sentences as a flat table, with the section of the sentence that holds them: child joined to parent."""
    rows = table(spark, d, "ner_records")
    merged = nested.Schema(nested.merged_schema(rows, "record_id", "payload")).paths
    held = [p for p in merged if p.endswith(".sentences.entities")]
    t = nested.tables(rows, "record_id", "payload", [*held, *(p.removesuffix(".entities") for p in held)])
    out = None
    for p in held:
        up = t[p.removesuffix(".entities")].select("record_key", F.col("id").alias("parent"), F.col("fields.section_type").alias("section_type"))
        f = lambda c: F.col(f"fields.{c}")
        x = t[p].where("kind = 'object'").join(up, ["record_key", "parent"])
        x = x.select(F.col("record_key").alias("record_id"), "section_type", F.col("ordinal").alias("item_no"), f("text").alias("text"), f("label").alias("label"), f("score").try_cast("double").alias("score"))
        out = x if out is None else out.unionByName(x)
    return out if out is not None else spark.createDataFrame([], "record_id bigint, section_type string, item_no int, text string, label string, score double")


def p5_levels(spark: SparkSession, d: str) -> DataFrame:
    """Every level of the article records, wherever their keys stand, with the parent's key and the place."""
    return nested.levels(table(spark, d, "ner_records"), "record_id", "payload")


def payload_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys of every level of the article records with kinds, coverage and an example."""
    return nested.key_report(table(spark, d, "ner_records"), "record_id", "payload")


def payload_schema(spark: SparkSession, d: str) -> DataFrame:
    """Top-level keys of the article records with the kind of their values."""
    kind = F.when(F.col("kind").isin("null", "array", "object"), F.col("kind")).otherwise("scalar")
    m = nested.merged_schema(table(spark, d, "ner_records"), "record_id", "payload").where("path = '$' and field is not null")
    return m.groupBy(F.col("field").alias("key"), kind.alias("kind")).agg(F.sum("n").alias("records"))


QUERIES = {"p5_found": p5_found, "p5_entities": p5_entities, "p5_levels": p5_levels, "payload_keys": payload_keys, "payload_schema": payload_schema}


def _unpacked(x: str) -> str:
    """A JSON value, or what a text holds if that is a JSON list or object."""
    return f"case when json_type({x}) = 'VARCHAR' and left(ltrim({x} ->> '$'), 1) in ('[', '{{') and json_valid({x} ->> '$') then ({x} ->> '$')::json else {x} end"


def _members(x: str) -> str:
    """The members of an unpacked value where a list is expected."""
    numbered = f"len(json_keys({x})) = len(list_filter(json_keys({x}), lambda k: regexp_full_match(k, '[0-9]+')))"
    in_order = f"list_transform(list_sort(list_transform(json_keys({x}), lambda k: k::hugeint)), lambda k: json_extract({x}, '$.\"' || k || '\"'))"
    return f"case json_type({x}) when 'ARRAY' then ({x})::json[] when 'OBJECT' then case when {numbered} then {in_order} else [{x}] end when 'NULL' then [] else case when {x} is null then [] else [{x}] end end"


_P5 = f"""
with d as (select record_id, payload::json as j from ner_records where payload <> '' and json_valid(payload)),
parts as (select record_id, {_unpacked("(j -> 'sentences')")} as top, {_unpacked("(j -> 'body' -> 'sections')")} as sec from d),
secs as (select record_id, top, list_transform({_members("sec")}, lambda s: {_unpacked("s")}) as secs from parts),
loose as (select record_id, top, list_transform(secs, lambda s: {_unpacked("(s -> 'sentences')")}) as inner_ from secs),
every as (select record_id, list_concat({_members("top")}, flatten(list_transform(inner_, lambda l: {_members("l")}))) as ss from loose),
sent as (select record_id, sent_no, {_unpacked("s")} as s from (select record_id, unnest(ss) as s, generate_subscripts(ss, 1) - 1 as sent_no from every)),
lists as (
  select record_id, sent_no, 'entities' as kind, {_unpacked("(s -> 'entities')")} as l from sent where json_type(s) = 'OBJECT'
  union all select record_id, sent_no, 'triples', {_unpacked("(s -> 'triples')")} from sent where json_type(s) = 'OBJECT'),
member as (select record_id, sent_no, kind, {_members("l")} as ms from lists),
item as (select record_id, sent_no, kind, item_no, {_unpacked("m")} as m from (select record_id, sent_no, kind, unnest(ms) as m, generate_subscripts(ms, 1) - 1 as item_no from member)),
obj as (select * from item where json_type(m) = 'OBJECT'),
goal as (select record_id, sent_no, item_no, {_unpacked("(m -> 'hgnc_targets')")} as l from obj where kind = 'entities'),
goals as (select record_id, sent_no, item_no, {_members("l")} as ms from goal),
target as (select record_id, sent_no, item_no, {_unpacked("m")} as m, sub_no from (select record_id, sent_no, item_no, unnest(ms) as m, generate_subscripts(ms, 1) - 1 as sub_no from goals))
select record_id, 'entity' as node, sent_no, item_no, -1 as sub_no from obj where kind = 'entities'
union all select record_id, 'target', sent_no, item_no, sub_no from target where json_type(m) = 'OBJECT'
union all select record_id, 'subject', sent_no, item_no, -1 from obj where kind = 'triples' and json_type({_unpacked("(m -> 'subject')")}) = 'OBJECT'
union all select record_id, 'object', sent_no, item_no, -1 from obj where kind = 'triples' and json_type({_unpacked("(m -> 'object')")}) = 'OBJECT'"""

_ENTITIES = _P5.split("obj as (")[0].rstrip().rstrip(",").replace("select record_id, sent_no, 'entities' as kind,", "select record_id, sent_no, 'entities' as kind, s ->> 'section_type' as section_type,").replace("select record_id, sent_no, 'triples',", "select record_id, sent_no, 'triples', null,").replace("select record_id, sent_no, kind, ", "select record_id, sent_no, section_type, kind, ")
_P5_ENTITIES = f"""{_ENTITIES}
select record_id, section_type, item_no, m ->> 'text' as text, m ->> 'label' as label, try_cast(m ->> 'score' as double) as score from item where kind = 'entities' and json_type(m) = 'OBJECT'"""

SQL: dict[str, str] = {
    "p5_found": _P5,
    "p5_entities": _P5_ENTITIES,
    "payload_schema": """with r as (select payload::json as j from ner_records where json_valid(payload) and payload <> ''), k as (select unnest(json_keys(j)) as key, j from r)
select key, case json_type(j -> key) when 'NULL' then 'null' when 'ARRAY' then 'array' when 'OBJECT' then 'object' else 'scalar' end as kind, count(*) as records from k group by all""",
}
