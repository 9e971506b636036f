import pytest

from mentionmill.llm import mixing as X


def _mix(spark, docs, targets):
    d = spark.createDataFrame([(i, t, s, 1) for i, (t, s) in enumerate(docs)], "doc_id long, text string, source string, n_tokens int")
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    m = X.mixture(d, "doc_id", "text", "source", t)
    return {r.doc_id: r.copies for r in m.collect()}, {r.source: r for r in X.reached(m, t).collect()}


def test_shares_and_caps(spark):
    docs = [("word " * (5 + i % 40) + str(i), "big") for i in range(600)] + [("word " * (3 + i % 20) + f"s{i}", " Small ") for i in range(60)] + [("no " * 9, None), ("no " * 9, "other"), ("", "big"), (None, "big")]
    copies, got = _mix(spark, docs, [("big", 0.7, 1), ("small", 0.2, 3), ("none", 0.1, 2)])
    assert max(copies[i] for i in copies if i < 600) <= 1 and max(copies[i] for i in copies if 600 <= i < 660) <= 3
    assert all(i < 660 for i in copies)
    assert got["none"].tokens == 0 and got["none"].reached_share == 0
    assert got["big"].reached_share == pytest.approx(0.7 / 0.9, rel=0.02) and got["small"].reached_share == pytest.approx(0.2 / 0.9, rel=0.05)


def test_equal_texts_are_one_text(spark):
    docs = [("the same text here", "a")] * 50 + [(f"word {i} of b", "b") for i in range(50)]
    copies, got = _mix(spark, docs, [("a", 0.5, 4), ("b", 0.5, 4)])
    assert {i: c for i, c in copies.items() if i < 50} == {0: 4}
    assert got["a"].reached_share == pytest.approx(0.5, abs=0.15)


def test_nothing_to_mix(spark):
    assert _mix(spark, [("x", "a")], [])[0] == {}
    assert _mix(spark, [], [("a", 1.0, 1)])[0] == {}
    assert _mix(spark, [("x", "a")], [("b", 1.0, 1)])[0] == {}
    assert _mix(spark, [("x", "a")], [("a", 1.0, 0)])[0] == {}


def test_twenty_thousand_sources(spark):
    t = spark.range(20_001).selectExpr("'s' || id as source", "1d as target_share", "2 as max_repeats")
    d = spark.range(40_002).selectExpr("id as doc_id", "'text ' || id || repeat(' word', cast(id % 7 as int)) as text", "'S' || id % 20001 as source")
    m = X.mixture(d, "doc_id", "text", "source", t)
    assert m.select("source").distinct().count() == 20_001 and m.agg({"copies": "max"}).first()[0] <= 2
    assert X.reached(m, t).agg({"reached_share": "sum"}).first()[0] == pytest.approx(1)


def _within_one_text(mix, shares):
    """Each source's tokens are within one of its longest texts of its share of the total."""
    tokens, longest = {}, {}
    for r in mix.collect():
        tokens[r.source] = tokens.get(r.source, 0) + r.copies * r.n_tokens
        longest[r.source] = max(longest.get(r.source, 0), r.n_tokens)
    whole, all_shares = sum(tokens.values()), sum(shares[s] for s in tokens)
    assert tokens and all(abs(n - shares[s] / all_shares * whole) <= max(longest.values()) for s, n in tokens.items())
    return {s: abs(n / (shares[s] / all_shares * whole) - 1) for s, n in tokens.items()}


@pytest.mark.parametrize(("cell", "lengths"), [(50_000, 1024), (7, 4)])
def test_shares_are_within_one_text(spark, sf, monkeypatch, cell, lengths):
    monkeypatch.setattr(X, "CELL", cell)
    monkeypatch.setattr(X, "LENGTHS", lengths)
    docs, t = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/mix_targets.parquet")
    caps = {r.source.strip().lower(): r.max_repeats for r in t.collect()}
    m = X.mixture(docs, "doc_id", "text", "source", t)
    _within_one_text(m, {r.source.strip().lower(): r.target_share for r in t.collect()})
    assert all(0 < r.copies <= caps[r.source] for r in m.collect())


def test_no_convergence_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(X, "ROUNDS", 1)
    with pytest.raises(RuntimeError, match="rounds"):
        _mix(spark, [("word " * (1 + i % 9), "ab"[i % 3 == 0]) for i in range(90)] + [(f"long {i} " * 50, "a") for i in range(9)], [("a", 0.3, 3), ("b", 0.7, 1)])


def test_hot_source_in_many_cells(spark, monkeypatch):
    monkeypatch.setattr(X, "CELL", 10)
    docs = [(f"w{i} same", "hot") for i in range(500)] + [(f"u{i} some more words here", "rest") for i in range(50)]
    copies, got = _mix(spark, docs, [("hot", 0.5, 1), ("rest", 0.5, 8)])
    assert got["hot"].reached_share == pytest.approx(0.5, rel=0.02) and max(copies.values()) <= 8
