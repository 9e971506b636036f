import math

import pytest
from pyspark.sql import functions as F

from mentionmill.operators import providers as P
from mentionmill.operators import relations as R


def test_stored_and_batched(spark):
    rows = spark.createDataFrame([("a", "m1"), ("b", "m2"), ("c", "m3")], "k string, model string")
    stored = P.Stored(spark.createDataFrame([("a", 0.5)], "k string, score double"), ["k"])
    batched = P.Batched(lambda: 2.0, lambda m, b: [m * len(x) for x in b["k"]], "score", "double", ["k"])
    got = {r.k: r.score for r in P.by_model(rows, {"m1": stored, "m2": batched}).collect()}
    assert got == {"a": 0.5, "b": 2.0}


def test_softmax_and_pooling(spark):
    r = spark.sql("select array(1000D, 1000D) l, array(array(3D, 0D), array(0D, 0D), array(0D, 4D)) t, array(1, 0, 1) m, array(0, 0, 0) z").select(P.softmax(F.col("l")).alias("s"), P.pooled(F.col("t"), F.col("m")).alias("p"), P.pooled(F.col("t"), F.col("z")).alias("n")).first()
    assert r.s == [0.5, 0.5] and r.n is None and r.p == pytest.approx([3 / 5, 4 / 5]) and math.isclose(sum(v * v for v in r.p), 1)


def test_chain_from_sentence_to_score(spark):
    """Pairs, routing, stored verdicts, score: a hand-made sentence through the chain."""
    e = "array<struct<text: string, label: string, domain: string, score: double, start: int, end: int>>"
    text = "EGFR strongly inhibits TP53 but may not affect aspirin."
    ents = [("EGFR", "GENETIC", "bio", 0.9, 0, 4), ("TP53", "GENETIC", "bio", 0.8, 23, 27), ("aspirin", "CHEMICAL", "pharm", None, 47, 54), ("lost", "GENETIC", "bio", 0.9, None, None)]
    s = spark.createDataFrame([("PMC1", "results", text, ["relation"], 0.02, ents), ("PMC2", "results", None, None, None, None)], f"pmid string, section_type string, text string, cues array<string>, result_margin double, entities {e}")
    pairs = R.candidate_pairs(s)
    assert {(r.subject.text, r.object.text, r.polarity, r.modality) for r in pairs.collect()} == {("EGFR", "TP53", "negated", "speculated"), ("EGFR", "aspirin", "negated", "speculated"), ("TP53", "aspirin", "negated", "speculated")}
    routes = spark.createDataFrame([("GENETIC", "m", 1), (None, "fallback", 2)], "type_pair string, model string, precedence int")
    routed = R.routed(pairs, routes)
    verdicts = routed.select("pair_id", "model", F.array(F.lit("no_relation"), F.lit("inhibition")).alias("labels"), F.when(F.col("model") == "m", F.array(F.lit(0.1), F.lit(0.9))).otherwise(F.array(F.lit(0.9), F.lit(0.1))).alias("probabilities"))
    got = R.scored(routed, verdicts).collect()
    assert [(r.label, r.score, r.score_2nd) for r in got] == [("inhibition", pytest.approx(round(min(1, 0.9 * 0.8 * 1.0 * 1.1 * 1.0), 4)), 0.1)]
    assert len(R.routed(pairs, routes, exclusive=False).collect()) == 4


def test_more_than_a_thousand_routes(spark):
    pairs = spark.createDataFrame([(i, f"T{i}") for i in range(1500)] + [(1500, None)], "n int, type_pair string")
    routes = spark.createDataFrame([(f"T{i}", f"m{i}", 1) for i in range(1500)], "type_pair string, model string, precedence int")
    got = {r.n: r.model for r in R.routed(pairs, routes).collect()}
    assert got == {i: f"m{i}" for i in range(1500)}
    last = routes.unionByName(spark.createDataFrame([(None, "any", 2)], routes.schema))
    assert {r.n: r.model for r in R.routed(pairs, last).collect()} == got | {1500: "any"}
    assert R.routed(pairs, last, exclusive=False).count() == 3001
