"""Writers at the edge of the pipeline. Tables stay Parquet inside; single files are for small results only."""

from __future__ import annotations

import html
import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most rows that a single file or page may hold.
MAX_ROWS = 100_000


def _small(df: DataFrame) -> list[dict]:
    rows = df.limit(MAX_ROWS + 1).collect()
    if len(rows) > MAX_ROWS:
        raise ValueError(f"more than {MAX_ROWS} rows; write a table instead")
    return [r.asDict(recursive=True) for r in rows]


def table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def journal(df: DataFrame, path: str) -> None:
    """Appends; the commit protocol makes an append all or nothing."""
    df.write.mode("append").parquet(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", "true").option("quote", "").csv(path)


def _replace(path: str, text: str) -> None:
    p = Path(path)
    new = p.with_name(p.name + ".new")
    new.write_text(text, encoding="utf-8")
    new.replace(p)


def json_array(df: DataFrame, path: str) -> None:
    _replace(path, json.dumps(_small(df), ensure_ascii=False, indent=2, default=str) + "\n")


def json_keyed(df: DataFrame, key: str, path: str) -> None:
    """One object keyed by a column; of repeated keys the last row counts."""
    _replace(path, json.dumps({r.pop(key): r for r in _small(df)}, ensure_ascii=False, indent=2, default=str) + "\n")


def report(title: str, sections: dict[str, DataFrame], path: str) -> None:
    """A page with a table for each small result."""
    out = [f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name, df in sections.items():
        rows = _small(df)
        head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
        body = "".join("<tr>" + "".join(f"<td>{html.escape(str(r[c]))}</td>" for c in df.columns) + "</tr>" for r in rows)
        out.append(f"<h2>{html.escape(name)}</h2><table><tr>{head}</tr>{body}</table>")
    _replace(path, "\n".join(out))


def graph_page(nodes: DataFrame, edges: DataFrame, template: str, path: str) -> None:
    """The graph's rows as JSON in place of __DATA__ in a page template."""
    data = json.dumps({"nodes": _small(nodes), "edges": _small(edges)}, ensure_ascii=False, default=str).replace("</", "<\\/")
    _replace(path, template.replace("__DATA__", data))


def annotated(table_: DataFrame, flags: DataFrame, key: str) -> DataFrame:
    """A library with flag columns from another table: a new table, the old one is not touched."""
    return table_.join(flags, key, "left").withColumns({c: F.col(c) for c in flags.columns if c != key})
