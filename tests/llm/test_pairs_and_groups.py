import datetime as dt
import itertools
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from mentionmill.llm import cooccurrence as C
from mentionmill.llm import frequency as Q
from mentionmill.llm import survivorship as V


def _pairs(spark, baskets, **kw):
    rows = [(r, x) for r, x in baskets]
    df = spark.createDataFrame(rows, "record string, items array<string>")
    out = C.associations(df, C.record_key(F.col("record")), F.col("items"), **kw)
    return {(r.a, r.b): (r.n_ab, r.n_a, r.n_b, r.n) for r in out.collect()}


@pytest.mark.parametrize("chunk", [2, 3, 48])
def test_pairs_equal_brute_force_whatever_the_chunk(spark, chunk):
    baskets = [(f"r{i}", [f"g{(i * k) % 23}" for k in range(i % 17)]) for i in range(60)] + [("r1", ["g1", "x"]), ("big", [f"g{k}" for k in range(23)])]
    sets = defaultdict(set)
    for r, x in baskets:
        sets[r].update(x)
    single = Counter(x for s in sets.values() for x in s)
    pair = Counter(p for s in sets.values() for p in itertools.combinations(sorted(s), 2))
    n = sum(1 for s in sets.values() if s)
    assert _pairs(spark, baskets, chunk=chunk) == {(a, b): (k, single[a], single[b], n) for (a, b), k in pair.items()}


def test_pairs_of_nulls_blanks_repeats_and_nothing(spark):
    assert _pairs(spark, []) == {}
    assert _pairs(spark, [("a", None), (None, ["x", "y", "x", None, " "]), (None, ["y"])]) == {("x", "y"): (1, 1, 1, 1)}


def test_exceeds_chance_is_exact_beyond_64_bits(spark):
    big = 4 * 10**18
    df = spark.createDataFrame([(big, big, big, big), (big - 1, big, big, big)], "n_ab long, n long, n_a long, n_b long")
    assert [r.x for r in df.select(C.exceeds_chance(1).alias("x")).collect()] == [True, False]


T = dt.datetime(2024, 1, 1)
SCORED = "ord long, pair_id string, model string, predicate struct<text: string, model: string>, score double, polarity string, scored_at timestamp, g string, o string, r int"


def _verdicts(spark, rows):
    models = spark.createDataFrame([("m-one", 1), ("m-two", 2)], "model string, trust_rank int")
    df = spark.createDataFrame([(o, p, m, (t, m), s, pol, at, "clash", "clash", 1) for o, p, m, t, s, pol, at in rows], SCORED)
    return {(r.group_ord, r.field): r.from_ord for r in V.best_verdicts(df, models).collect()}


def test_each_field_from_the_row_that_deserves_it(spark):
    p = "PMC1:0123456789ab:1-2:5-9"
    rows = [
        (1, p, "m-two", "bind", 0.9, "positive", T),
        (2, "pmc1.grobid.tei|0123456789AB|5-9|1-2", "ckpt/M_One@v2", "N/A", 0.9, " ", T),
        (3, " PMC1: 0123456789ab: 1-2: 5-9\t", "m-two ", "activation", 7.0, "negated", T + dt.timedelta(1)),
        (4, "PMC1:0123456789ab:1..2:5..9", "other", "x", float("nan"), None, None),
    ]
    assert _verdicts(spark, rows) == {(1, "score"): 2, (1, "predicate"): 3, (1, "polarity"): 3}


def test_ties_go_to_the_smallest_ord_and_lone_rows_are_no_group(spark):
    p = "PMC1:0123456789ab:1-2:5-9"
    rows = [(5, p, "m-one", "a", 0.5, "p", T), (4, p, "m-one", "b", 0.5, "p", T), (9, "PMC2:0123456789ab:1-2:5-9", "m-one", "a", 1.0, "p", T), (7, None, "m-one", "a", 1.0, "p", T), (8, None, "m-one", "a", 1.0, "p", T)]
    assert _verdicts(spark, rows) == {(4, f): 4 for f in ("score", "predicate", "polarity")}
    assert _verdicts(spark, []) == {}
    assert _verdicts(spark, [(1, "", None, None, None, None, None), (2, "", None, None, None, None, None)]) == {}


def test_spans_in_another_place_are_another_group(spark):
    a, b = "PMC1:0123456789ab:1-2:5-9", "PMC1:0123456789ab:1-2:5-8"
    assert _verdicts(spark, [(1, a, "m-one", "a", 0.1, "p", T), (2, b, "m-one", "a", 0.1, "p", T)]) == {}


COUNTS = "row_id long, pmid string, v string, n long, at timestamp, value string, total long"


def _counts(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], COUNTS)
    out = Q.marked_frequencies(df, F.substring_index("pmid", ".", 1), "v", "n", "at", "row_id", **kw)
    return {r.value: (r.total, r.records, r.mark) for r in out.collect()}


def test_only_the_latest_counting_row_of_an_article_counts(spark):
    rows = [(1, "P1", "a", 5, T), (2, "P1.tei", "a", 7, T + dt.timedelta(1)), (3, "P1", "a", None, T + dt.timedelta(9)), (4, "P1", "a", -1, T + dt.timedelta(9)), (5, "P2", "a", 1, None), (6, "P2", "a", 2, None), (7, "P3", " a", 2, T), (8, "P4", None, 2, T), (9, None, "a", 2, T)]
    assert _counts(spark, rows) == {"a": (9, 2, "common"), " a": (2, 1, "common")}


def test_marks_and_routes(spark):
    rows = [(i, f"P{i}", "hot", 2, T) for i in range(300)] + [(1000 + i, f"P{i}", f"w{i}", 1 + i % 4, T) for i in range(300)]
    want = {"hot": (600, 300, "common")} | {f"w{i}": (1 + i % 4, 1, "rare" if i % 4 < 2 else None) for i in range(300)}
    assert _counts(spark, rows) == want
    assert _counts(spark, []) == {}


def test_heavy_route_equals_light_route(spark):
    df = spark.createDataFrame([(f"v{i % 7}", i) for i in range(500)], "v string, w long")
    one = {tuple(r) for r in Q.frequencies(df, "v", "w", k=3).collect()}
    two = {tuple(r) for r in df.groupBy("v").agg(F.sum("w"), F.count("*")).collect()}
    assert one == two
