import pytest

from mentionmill.plans import registry
from tests.oracle import connect, rows_of

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, con, name):
    mine, theirs = rows_of(spark, con, registry.queries()[name], SQL[name], sf)
    assert mine == theirs


CHECKS = {
    "calibrators": lambda spark, sf, rows: all(0 <= r.lowest <= r.highest <= 1 and r.points > 0 for r in rows),
    "greek_links": lambda spark, sf, rows: sorted(r.surface for r in rows) == sorted(r.surface for r in registry.queries()["greek_surfaces"](spark, sf).collect()),
    "p5_levels": lambda spark, sf, rows: {(r.record_key, r.id) for r in rows} >= {(r.record_key, r.parent) for r in rows if r.parent is not None} and len({(r.record_key, r.id) for r in rows}) == len(rows),
    "payload_keys": lambda spark, sf, rows: rows and all(0 < r.coverage <= 1 and r.n <= r.objects for r in rows),
}


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(SQL)))
def test_query_without_sql(spark, sf, name):
    assert CHECKS[name](spark, sf, registry.queries()[name](spark, sf).collect())


def test_every_sql_has_its_query():
    assert set(SQL) <= set(registry.queries())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
