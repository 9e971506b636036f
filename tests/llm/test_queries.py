import pytest

from mentionmill.llm import confusables, queries, sql
from tests.oracle import connect, rows_of


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_equals_sql(spark, sf, con, name):
    mine, theirs = rows_of(spark, con, queries.queries()[name], sql.oracle_sql()[name], sf)
    assert mine == theirs


def _open_ends(spark, sf):
    own = {"GENETIC": "hgnc_symbol", "DISEASE": "mondo_label", "CHEMICAL": "chebi_label"}
    t = spark.read.parquet(f"{sf}/{queries.NORMALIZED}.parquet")
    return {(r.ord, role) for r in t.collect() for role in ("subject", "object") if not r[role][own[r[role].type]]}


def _p3(spark, sf, rows):
    known = {r[0] for t, c in (("hgnc", "hgnc_id"), ("obo_term", "id")) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(c).collect()}
    return len(rows) == len(_open_ends(spark, sf)) and {(r.ord, r.role) for r in rows} == _open_ends(spark, sf) and {r.ref_id for r in rows} <= known | {"unmatched"}


def _p6(spark, sf, rows):
    text = {("clean_genetic_ne", r.row_id): r.clean_genetic_ne for r in spark.read.parquet(f"{sf}/clean_genetic_ne.parquet").collect()}
    for r in spark.read.parquet(f"{sf}/triples.parquet").collect():
        text |= {("subject", r.ord): r.subject.text, ("object", r.ord): r.object.text}
    return rows and all(text[r.field, r.row_key] != r.plain and confusables.canonical(text[r.field, r.row_key]) == confusables.canonical(r.plain) for r in rows)


def _leaking(spark, sf):
    return {r.doc_id for r in queries.p7_found(spark, sf).collect()}


CHECKS = {
    "p3_found": _p3,
    "p6_found": _p6,
    "p7_found": lambda spark, sf, rows: rows and len(set(rows)) == len(rows),
    "p7_scrubbed": lambda spark, sf, rows: {r.doc_id for r in rows} == _leaking(spark, sf) and all(r.removed > 0 for r in rows),
    "p8_mix": lambda spark, sf, rows: rows and len({r.doc_id for r in rows}) == len(rows) and all(r.copies > 0 for r in rows),
    "p8_shares": lambda spark, sf, rows: sum(r.reached_share for r in rows) == pytest.approx(1) and len(rows) == spark.read.parquet(f"{sf}/mix_targets.parquet").count(),
    "p9_found": lambda spark, sf, rows: {r.doc_id for r in rows} == {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if r.text and r.text.strip()},
}


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(sql.oracle_sql())))
def test_query_without_sql(spark, sf, name):
    assert CHECKS[name](spark, sf, queries.queries()[name](spark, sf).collect())
