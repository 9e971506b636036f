"""Deeply nested semi-structured records as related flat tables.

First the schemas of all records are merged: one pass counts, per level and field, the kinds of its values; tasks send only their
merged counts. Then every level is exploded: each field that anywhere holds a list, an object or a text with JSON becomes a child
table, whose rows carry the key of their parent row and their place in the list. Lists within lists and objects within objects
are levels of their own, to any depth; all other fields stay columns, with the type that all their values share.

A path names a level: ``$`` is the record, ``$.a`` the members of field ``a``, ``$.a[]`` the members of lists that are themselves
members of ``a``. Where a list is expected, these shapes are read alike:

* an array: its members in order;
* an object with only numbers as keys: its values in numeric order;
* any other object: one member at place 0; an object without keys has no members;
* a text that holds a JSON list or object: what it holds, unpacked once; any other scalar: one member at place 0;
* null or absent: no members. A null member keeps its place.

Records are parsed in Arrow batches outside the JVM: reading the same fields through VARIANT took about three times the CPU.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from itertools import count

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionmill.session import ship
from mentionmill.staging import staged

#: Levels and fields that one schema may have; beyond it keys are data rather than names, and the schema is refused.
MAX_FIELDS = 200_000
#: Characters of an example value.
EXAMPLE = 80

_BLANK = " \t\r\n"
_TOKEN = re.compile(r'[ \t\r\n]*(?:([\[\]{},:])|("(?:[^"\\\x00-\x1f]|\\.)*"|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null))')


def _refuse(x: str):
    raise ValueError(x)


_decode = json.JSONDecoder(parse_constant=_refuse).decode


def _deep(text: str):
    """A JSON value of any depth, without recursion."""
    end = len(text.rstrip(_BLANK))
    out: list = []
    stack: list = [out]
    at, want, name = 0, "value", None
    while at < end:
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(at)
        at, sign, top = m.end(), m.group(1), stack[-1]
        if want in ("value", "first") and (m.group(2) or sign in ("[", "{")):
            v = [] if sign == "[" else {} if sign == "{" else _decode(m.group(2))
            if isinstance(top, dict):
                top[name] = v
            else:
                top.append(v)
            if sign:
                stack.append(v)
            want = "first" if sign == "[" else "no name yet" if sign == "{" else "next"
        elif want in ("no name yet", "name") and m.group(2) and m.group(2)[0] == '"':
            name, want = _decode(m.group(2)), "colon"
        elif want == "colon" and sign == ":":
            want = "value"
        elif want == "next" and sign == "," and len(stack) > 1:
            want = "name" if isinstance(top, dict) else "value"
        elif len(stack) > 1 and sign == ("}" if isinstance(top, dict) else "]") and want in ("next", "first", "no name yet"):
            stack.pop()
            want = "next"
        else:
            raise ValueError(at)
    if len(stack) > 1 or len(out) != 1:
        raise ValueError(at)
    return out[0]


def read(text: str):
    """The value of a text that is one complete JSON value, else ValueError. Of a repeated key the last value counts."""
    try:
        return _decode(text)
    except RecursionError:
        return _deep(text)


def unpacked(v):
    """JSON lists and objects held in a text are unpacked once; anything else stays."""
    if isinstance(v, str) and v.lstrip(_BLANK)[:1] in ("[", "{"):
        try:
            return read(v)
        except ValueError:
            return v
    return v


def members(v) -> list:
    """The members of an unpacked value where a list is expected."""
    if isinstance(v, list):
        return v
    if isinstance(v, dict) and all(k.isascii() and k.isdigit() for k in v):
        return [v[k] for k in sorted(v, key=int)]
    return [] if v is None else [v]


_KINDS = {dict: "object", list: "array", str: "string", bool: "boolean", int: "integer", float: "number", type(None): "null"}


def _child(path: str, name: str) -> str:
    return f"{path}.{name}".encode(errors="replace").decode()


class _Merged:
    """Counts of the kinds of values by level and field."""

    def __init__(self):
        self.n: dict[tuple, int] = {}
        self.least: dict[tuple, object] = {}
        self.paths: dict[tuple[str, str], str] = {}

    def add(self, record) -> None:
        n, least, paths = self.n, self.least, self.paths
        todo = [("$", record)]
        while todo:
            path, v = todo.pop()
            k = (path, None, _KINDS[type(v)])
            n[k] = n.get(k, 0) + 1
            if isinstance(v, list):
                todo += [(path + "[]", unpacked(m)) for m in v]
            elif isinstance(v, dict):
                for name, raw in v.items():
                    x = unpacked(raw)
                    kind = _KINDS[type(x)]
                    if kind == "integer" and x.bit_length() > 63:
                        kind = "number"
                    k = (path, name, kind)
                    if k in n:
                        n[k] += 1
                    else:
                        n[k] = 1
                        paths.setdefault((path, name), _child(path, name))
                    if kind == "string":
                        x = x[:EXAMPLE]
                    elif kind in ("object", "array"):
                        at = paths[path, name]
                        todo += [(at, unpacked(m)) for m in members(x)]
                        continue
                    if k not in least or x is not None and x < least[k]:
                        least[k] = x

    def rows(self) -> pd.DataFrame:
        bare = lambda s: s if s is None else s.encode(errors="replace").decode()
        out = [(p, bare(f), kind, n, json.dumps(self.least[p, f, kind]) if (p, f, kind) in self.least else None) for (p, f, kind), n in self.n.items()]
        self.n, self.least = {}, {}
        return pd.DataFrame(out, columns=["path", "field", "kind", "n", "example"])


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(key, value) of every payload that is one complete JSON value."""
    for b in batches:
        for key, text in zip(b["key"], b["payload"], strict=True):
            try:
                yield key, read(text)
            except ValueError:
                continue


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    m = _Merged()
    for _, v in _records(batches):
        m.add(v)
        if len(m.n) > MAX_FIELDS:
            yield m.rows()
    yield m.rows()


def _input(rows: DataFrame, key: str, payload: str) -> DataFrame:
    ship(rows.sparkSession)
    return rows.select(F.col(key).alias("key"), F.col(payload).alias("payload")).where("payload is not null and payload <> ''")


def merged_schema(rows: DataFrame, key: str, payload: str) -> DataFrame:
    """(path, field, kind, n, example): how often each field of each level has a value of each kind, and the least scalar value.

    Rows without a field count the members of the level itself by their kind. Unreadable, empty and null payloads count nowhere.
    """
    each = _input(rows, key, payload).mapInPandas(_merge, "path string, field string, kind string, n bigint, example string")
    return each.groupBy("path", "field", "kind").agg(F.sum("n").alias("n"), F.min("example").alias("example"))


class Schema:
    """The merged schema on the driver: one row per level, field and kind, whatever the number of records."""

    def __init__(self, merged: DataFrame):
        self.kinds: dict[str, dict[str, set[str]]] = {}
        self.shapes: dict[str, set[str]] = {}
        rows = merged.select("path", "field", "kind").limit(MAX_FIELDS + 1).collect()
        if len(rows) > MAX_FIELDS:
            raise ValueError(f"more than {MAX_FIELDS} levels and fields: the keys of these records are data")
        for r in rows:
            if r.field is None:
                self.shapes.setdefault(r.path, set()).add(r.kind)
            else:
                self.kinds.setdefault(r.path, {}).setdefault(r.field, set()).add(r.kind)
        self.paths = sorted(self.shapes)

    def is_table(self, path: str, field: str) -> bool:
        return bool(self.kinds[path][field] & {"object", "array"})

    def columns(self, path: str) -> str:
        """The scalar fields of a level and the types their values share, as DDL; mixed kinds are text."""
        types = []
        for f, kinds in sorted(self.kinds.get(path, {}).items()):
            if not self.is_table(path, f):
                k = kinds - {"null"}
                t = "boolean" if k == {"boolean"} else "bigint" if k == {"integer"} else "double" if k and k <= {"integer", "number"} else "string"
                types.append(f"`{f.replace('`', '``')}` {t}")
        return f"struct<{', '.join(types)}>"

    def plan(self, wanted: set[str] | None = None) -> dict[str, dict[str, str]]:
        """By level: its child tables, by field, on the way to the wanted levels; lists within lists have the field ``[]``."""
        on_way = lambda p: wanted is None or any(w == p or w.startswith((p + ".", p + "[")) for w in wanted)
        out: dict[str, dict[str, str]] = {}
        for path in self.paths:
            tables = {f: _child(path, f) for f in self.kinds.get(path, {}) if self.is_table(path, f)}
            if "array" in self.shapes[path]:
                tables["[]"] = path + "[]"
            out[path] = {f: p for f, p in tables.items() if on_way(p)}
        return out


def _explode(plan: dict[str, dict[str, str]], wanted: frozenset[str] | None, values: bool) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["record_key", "path", "parent", "id", "ordinal", "kind", "ordinals", "numbers"] + ["fields", "value"] * values
        out: list[tuple] = []
        for key, record in _records(batches):
            ids, numbers = count(), {}
            todo = [("$", record, None, 0, (), ())]
            while todo:
                path, v, parent, place, places, above = todo.pop()
                at = next(ids)
                kind = _KINDS[type(v)]
                if path != "$":
                    name = path.rsplit(".", 1)[-1]
                    number = numbers[name] = numbers.get(name, -1) + 1
                    places, above = (*places, place), (*above, number)
                if wanted is None or path in wanted:
                    row = (key, path, parent, at, place, kind, places, above)
                    if values:
                        inner = plan[path]
                        fields = json.dumps({k: x for k, x in v.items() if k not in inner}) if kind == "object" else None
                        row = (*row, fields, None if kind in ("object", "array") else json.dumps(v))
                    out.append(row)
                if kind == "object":
                    tables = plan[path]
                    below = [(tables[f], unpacked(m), at, i, places, above) for f, x in v.items() if f in tables for i, m in enumerate(members(unpacked(x)))]
                elif kind == "array" and "[]" in plan[path]:
                    below = [(path + "[]", unpacked(m), at, i, places, above) for i, m in enumerate(v)]
                else:
                    continue
                below.reverse()
                todo += below
            if len(out) > 20_000:
                yield pd.DataFrame(out, columns=names)
                out = []
        yield pd.DataFrame(out, columns=names)

    return run


def nodes(rows: DataFrame, key: str, payload: str, schema: Schema, paths: list[str] | None = None, values: bool = False) -> DataFrame:
    """(record_key, path, parent, id, ordinal, kind, ordinals, numbers): the rows of all child tables, or of the given ones.

    ``id`` counts a record's rows in the order written and with ``record_key`` is the surrogate key; ``parent`` is the ``id`` of
    the row that holds this one, in the table one level up. ``ordinals`` has the place at every level from the record down, this
    row's last; ``numbers`` counts at every level through all of the record's lists of that name instead. With ``values``,
    ``fields`` has the scalar fields of an object and ``value`` any other scalar, as JSON. Keys of records are taken as unique:
    records that share one have rows that share surrogate keys. One pass without a shuffle; unreadable payloads give no rows.
    """
    kind = rows.schema[key].dataType.simpleString()
    wanted = None if paths is None else frozenset(paths)
    ddl = f"record_key {kind}, path string, parent bigint, id bigint, ordinal int, kind string, ordinals array<int>, numbers array<int>" + ", fields string, value string" * values
    plan = schema.plan(None if paths is None else set(paths))
    return _input(rows, key, payload).mapInPandas(_explode(plan, wanted, values), ddl)


def tables(rows: DataFrame, key: str, payload: str, paths: list[str] | None = None) -> dict[str, DataFrame]:
    """All levels of the records, or the given ones, as flat tables by path.

    Every table has ``record_key``, ``parent``, ``id``, ``ordinal`` and ``kind`` as in ``nodes``, ``fields`` (a struct of the
    level's scalar fields, null where the member is no object) and ``value`` (a member that is a scalar, as JSON). What stands in
    child tables stands nowhere else; the names of the records' fields cannot clash with the table's own. All levels are written
    in one pass; each table reads only its part.
    """
    s = Schema(staged(merged_schema(rows, key, payload), "schema"))
    paths = [p for p in s.paths if paths is None or p in paths]
    x = staged(nodes(rows, key, payload, s, paths, True).drop("ordinals", "numbers"), "levels", "path")
    out = {}
    for p in paths:
        t = x.where(F.col("path") == p)
        out[p] = t.select("record_key", "parent", "id", "ordinal", "kind", F.from_json("fields", s.columns(p)).alias("fields"), "value")
    return out


def levels(rows: DataFrame, key: str, payload: str) -> DataFrame:
    """(path, record_key, parent, id, ordinal, kind): the rows of all tables as one, in one pass after the schema."""
    s = Schema(merged_schema(rows, key, payload))
    return nodes(rows, key, payload, s).select("path", "record_key", "parent", "id", "ordinal", "kind")


def key_report(rows: DataFrame, key: str, payload: str) -> DataFrame:
    """(path, key, kind, n, objects, coverage, example): the keys of the objects of every level and the kinds of their values.

    ``n`` of the level's ``objects`` hold the key with a value of this kind; ``example`` is the least scalar of them, as JSON, cut.
    """
    m = staged(merged_schema(rows, key, payload), "schema")
    total = m.where("field is null and kind = 'object'").select("path", F.col("n").alias("objects"))
    x = m.where("field is not null").join(total, "path")
    return x.select("path", F.col("field").alias("key"), "kind", "n", "objects", (F.col("n") / F.col("objects")).alias("coverage"), "example")


def record_nodes(rows: DataFrame, key: str, payload: str) -> DataFrame:
    """(key, node, sent_no, item_no, sub_no): the place of each entity, target, subject and object of article records.

    A projection of the child tables, wherever the merged schema has them: ``entities`` of any ``sentences``, ``hgnc_targets`` of
    those, ``subject`` and ``object`` of any ``triples`` of ``sentences``. Sentences are numbered through the record in the order
    written. Only objects give rows. Null, empty and unreadable payloads and payloads without sentences give none; repeated
    records give repeated rows under their own keys. Two passes over the payloads, without a shuffle of their rows.
    """
    tails = {("sentences", "entities"): "entity", ("sentences", "entities", "hgnc_targets"): "target", ("sentences", "triples", "subject"): "subject", ("sentences", "triples", "object"): "object"}
    s = Schema(merged_schema(rows, key, payload))
    node_of = {p: node for p in s.paths for tail, node in tails.items() if tuple(p.split("."))[-len(tail) :] == tail}
    x = nodes(rows, key, payload, s, list(node_of)).where("kind = 'object'")
    node = None
    for p, n in node_of.items():
        node = F.when(F.col("path") == p, n) if node is None else node.when(F.col("path") == p, n)
    x = x.withColumn("node", node if node is not None else F.lit(None).cast("string"))
    deep = F.col("node") != "entity"  # one level below the entity or triple
    back = lambda c, i: F.element_at(c, F.when(deep, i - 1).otherwise(i))
    sub = F.when(F.col("node") == "target", F.col("ordinal")).otherwise(-1)
    return x.select(F.col("record_key").alias(key), "node", back("numbers", F.lit(-2)).alias("sent_no"), back("ordinals", F.lit(-1)).alias("item_no"), sub.alias("sub_no"))
