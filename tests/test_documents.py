import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from mentionmill.operators import corpus, evaluate, graph, nested, targets, training, xmldocs
from mentionmill.sources import ranges, readers, writers

JATS = """<article article-type="research-article"><front><article-title>On <i>x</i></article-title><abstract><title>Summary</title><p>Short &nbsp;abstract.</p></abstract></front>
<body><p>Loose.</p><sec sec-type="results"><title>Results</title><p>One &undefined; two.<sec><title>Inner</title><p>Deep.</p></sec><fig><label>Fig. 1</label><caption><p>A legend.</p></caption></fig></sec></body>
<back><ref-list><ref/><ref/></ref-list></back></article>"""
TEI = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><abstract><p>Abs.</p></abstract><body><div><head>Materials and Methods</head><p>Text one.</p></div><figure type="table"><head>Table 1</head><figDesc>Rows</figDesc><table><row><cell>a</cell><cell>b</cell></row></table></figure></body></TEI>'


def test_paragraphs():
    scheme, p = xmldocs.paragraphs(JATS)
    assert scheme == "jats" and [(a, b) for a, b, _ in p] == [("abstract", "Summary"), ("results", "Results"), ("results", "Results"), ("(body)", "Body"), ("figure-legend", "Fig. 1")]
    assert p[0][2] == "Short abstract." and "two" in p[1][2] and p[4][2] == "Fig. 1 A legend."
    scheme, p = xmldocs.paragraphs(TEI)
    assert scheme == "tei" and [x[0] for x in p] == ["abstract", "materials|methods", "table-heading", "table-heading"] and p[3][2] == "ab"
    assert xmldocs.paragraphs("plain <b>text") == ("unknown", [])


def test_article_paragraphs(spark):
    df = spark.createDataFrame([("a", JATS), ("b", None), ("c", ""), ("d", "<" * 5000), ("e", "<sec>" * 5000 + "<p>x")], "pmid string, xml string")
    got = xmldocs.article_paragraphs(df, "pmid", "xml").groupBy("pmid").count().collect()
    assert {r.pmid: r["count"] for r in got}["a"] == 5


def test_structure(spark):
    # the count of references takes in the tag of their list
    r = spark.createDataFrame([(JATS,)], "x string").select(corpus.structure(F.col("x")).alias("s"), corpus.article_type(F.col("x")).alias("t"), corpus.text_class(F.col("x")).alias("c")).first()
    assert (r.s.has_title, r.s.has_abstract, r.s.has_reflist, r.s.n_refs, r.s.shape, r.s.sections, r.s.n_figures, r.t, r.c) == (True, True, True, 3, "structured", ["Results"], 1, "research-article", "fulltext")


def test_tei_titles_and_coverage(spark):
    df = spark.createDataFrame([("a", JATS), ("b", TEI), ("c", None)], "pmid string, xml string")
    r = df.where("pmid = 'b'").select(corpus.tei_structure(F.col("xml")).alias("s")).first().s
    assert (r.has_title, r.has_abstract, r.n_divs, r.sections) == (False, True, 1, ["Methods"])
    titles = {(x.doc, x.title) for x in corpus.section_titles(df, "pmid", "xml").collect()}
    assert {("a", "Results"), ("a", "Inner"), ("b", "Materials and Methods")} <= titles and ("b", "Table 1") not in titles
    c = {x.part: (x.articles, x.share) for x in corpus.coverage(df.where("xml is not null").select(corpus.structure(F.col("xml")).alias("s"))).collect()}
    assert c["all"] == (2, 1.0) and c["shape: structured"] == (1, 0.5) and c["section: Results"] == (1, 0.5) and c["main sections: 1"] == (1, 0.5)


@pytest.mark.parametrize("p", [0.0, 0.3, 0.9, 1.0])
def test_percentile_by_index(spark, p):
    values = [5.0, 1.0, 1.0, 9.5, 3.25, 3.25, 3.25, 1e9, -2.0, 0.1]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double")
    assert corpus.index_percentile(df, "v", p) == sorted(values)[min(len(values) - 1, int(p * len(values)))]
    assert corpus.index_percentile(df.limit(0), "v", p) is None


def _tables(spark, *records, key="id"):
    rows = [(i, r if r is None or isinstance(r, str) else json.dumps(r), "clash") for i, r in enumerate(records)]
    return nested.tables(spark.createDataFrame(rows, f"{key} int, payload string, parent string"), key, "payload")


def test_nested_tables(spark):
    t = _tables(spark, {"a": [{"b": [1, 2], "c": {"d": "x"}}, None, "[{\"b\": 3}]"], "n": 1}, "{cut", None, '{"a": {"0": {"b": 1}, "1": {"b": 2}}} x', '{"a": {"0": {"b": 1}, "10": {"b": 3}, "2": {"b": 2}}}', "", "NaN")
    assert set(t) == {"$", "$.a", "$.a[]", "$.a.b", "$.a.c"}
    assert sorted((r.record_key, r.parent, r.id, r.fields.n) for r in t["$"].collect()) == [(0, None, 0, 1), (4, None, 0, None)]
    a = sorted((r.record_key, r.parent, r.ordinal, r.kind) for r in t["$.a"].collect())
    assert a == [(0, 0, 0, "object"), (0, 0, 1, "null"), (0, 0, 2, "array"), (4, 0, 0, "object"), (4, 0, 1, "object"), (4, 0, 2, "object")]
    b = t["$.a.b"].join(t["$.a"].select("record_key", F.col("id").alias("parent"), F.col("ordinal").alias("of")), ["record_key", "parent"])
    assert sorted((r.record_key, r.of, r.ordinal, r.value) for r in b.collect()) == [(0, 0, 0, "1"), (0, 0, 1, "2"), (4, 0, 0, "1"), (4, 1, 0, "2"), (4, 2, 0, "3")]
    assert [f.name for f in t["$.a"].schema["fields"].dataType] == [] and t["$.a.c"].first().fields.d == "x"


def test_lists_of_lists_and_any_depth(spark):
    deep = x = {}
    for _ in range(60):
        x["d"] = x = {"n": 1}
    t = _tables(spark, {"a": [[{"x": 1}], [[2]]]}, deep, [[7], {"y": True}])
    assert [(r.record_key, r.ordinal, r.fields.x) for r in t["$.a[]"].where("kind = 'object'").collect()] == [(0, 0, 1)]
    assert [r.value for r in t["$.a[][]"].collect()] == ["2"] and t["$" + ".d" * 60].first().fields.n == 1
    assert sorted((r.ordinal, r.kind) for r in t["$[]"].collect()) == [(0, "array"), (1, "object")] and [r.value for r in t["$[][]"].collect()] == ["7"]


def test_columns_have_the_type_their_values_share(spark):
    t = _tables(spark, {"i": 1, "f": 1, "m": 1, "b": True, "none": None, "id": "x"}, {"i": -5, "f": 0.5, "m": "one", "b": None, "big": 1 << 70})
    assert t["$"].select("fields.*").dtypes == [("b", "boolean"), ("big", "double"), ("f", "double"), ("i", "bigint"), ("id", "string"), ("m", "string"), ("none", "string")]
    assert sorted((r.fields.m, r.fields.f) for r in t["$"].collect()) == [("1", 1.0), ("one", 0.5)]


def test_tables_of_nothing(spark):
    assert _tables(spark) == {} and _tables(spark, None, "", "x") == {}


@pytest.mark.parametrize("text", ["[" * 200_000 + "]" * 200_000, '{"a":' * 50_000 + "1.5e3" + "}" * 50_000])
def test_texts_of_any_depth_are_read(text):
    v, n = nested.read(text), 0
    while isinstance(v, (list, dict)) and v:
        v, n = (v[0] if isinstance(v, list) else v["a"]), n + 1
    assert v in ([], 1500.0) and n in (199_999, 50_000)


@pytest.mark.parametrize("text", ['{"a": [1, "x\\u00e9\\n", null, true, -0.5e-3], "b": {}, "a": []}', " [] ", "3", '"x"', "[1,]", "{,}", '{"a"}', '{"a":1,}', "[1 2]", "]", "[}", "", "[1] 2", "nul", "01", '{"a":1 "b":2}', "[,1]", "{1:2}", "NaN"])
def test_deep_reading_equals_plain_reading(text):
    def tried(f):
        try:
            return f(text)
        except ValueError:
            return "unreadable"

    assert tried(nested._deep) == tried(nested._decode)


def test_levels_at_any_path(spark):
    payload = json.dumps({"other": {"parts": [{"sentences": [{"entities": [{"text": "x"}]}, {"entities": []}]}]}})
    df = spark.createDataFrame([(1, payload)], "record_id int, payload string")
    got = {(r.path, r.parent, r.id, r.ordinal) for r in nested.levels(df, "record_id", "payload").collect()}
    p = "$.other.parts.sentences"
    assert got == {("$", None, 0, 0), ("$.other", 0, 1, 0), ("$.other.parts", 1, 2, 0), (p, 2, 3, 0), (p + ".entities", 3, 4, 0), (p, 2, 5, 1)}
    assert [tuple(r) for r in nested.record_nodes(df, "record_id", "payload").collect()] == [(1, "entity", 0, 0, -1)]


def test_keys_of_every_level(spark):
    payload = {"sentences": [{"entities": [{"text": "x", "score": 0.5}, {"text": None}, {"text": "a", "ok": True}]}]}
    df = spark.createDataFrame([(1, json.dumps(payload)), (2, "{cut")], "record_id int, payload string")
    got = {(r.path, r.key, r.kind): (r.n, r.objects, r.coverage, r.example) for r in nested.key_report(df, "record_id", "payload").collect()}
    e = "$.sentences.entities"
    assert got[e, "text", "string"] == (2, 3, 2 / 3, '"a"') and got[e, "text", "null"] == (1, 3, 1 / 3, "null")
    assert got[e, "score", "number"][:2] == (1, 3) and got[e, "ok", "boolean"][:2] == (1, 3)
    assert got["$.sentences", "entities", "array"][:2] == (1, 1) and got["$", "sentences", "array"][:2] == (1, 1)


def test_record_nodes_of_odd_payloads(spark):
    e = {"text": "x"}
    rows = [
        {"sentences": [{"entities": [e, None, {"hgnc_targets": {"symbol": "A"}}], "triples": {"subject": e, "object": json.dumps(e)}}, {"entities": json.dumps([e])}, {"entities": e}, {"entities": {"0": e, "1": e}}, {"entities": "word"}, {}]},
        {"body": {"sections": [{"sentences": [{"entities": [e]}]}, {}, {"sentences": [{"triples": [{"subject": None}]}]}]}},
        [], "x", 3,
    ]
    df = spark.createDataFrame([(i, json.dumps(r), "clash") for i, r in enumerate(rows)] + [(10, None, ""), (11, "", ""), (12, '{"sentences": [', "")], "record_id int, payload string, node string")
    got = sorted(tuple(r) for r in nested.record_nodes(df, "record_id", "payload").collect())
    assert got == sorted([
        (0, "entity", 0, 0, -1), (0, "entity", 0, 2, -1), (0, "target", 0, 2, 0), (0, "subject", 0, 0, -1), (0, "object", 0, 0, -1), (0, "entity", 1, 0, -1), (0, "entity", 2, 0, -1), (0, "entity", 3, 0, -1), (0, "entity", 3, 1, -1), (1, "entity", 0, 0, -1),
    ])
    assert nested.record_nodes(df.limit(0), "record_id", "payload").count() == 0


def test_record_nodes_equal_brute_force(spark, sf):
    def dec(x):
        if isinstance(x, str) and x.lstrip()[:1] in ("[", "{"):
            try:
                return json.loads(x)
            except ValueError:
                return x
        return x

    def mem(x):
        x = dec(x)
        if isinstance(x, dict) and all(k.isdigit() for k in x):
            return list(x.values())
        return [] if x is None else x if isinstance(x, list) else [x]

    df, want = spark.read.parquet(f"{sf}/ner_records.parquet"), []
    for r in df.collect():
        try:
            j = json.loads(r.payload)
        except (ValueError, TypeError):
            continue
        sents = mem(j.get("sentences")) + [s for sec in mem((j.get("body") or {}).get("sections")) for s in mem(dec(sec).get("sentences"))]
        for i, s in enumerate(map(dec, sents)):
            for k, x in enumerate(map(dec, mem(s.get("entities")))):
                if isinstance(x, dict):
                    want += [(r.record_id, "entity", i, k, -1)] + [(r.record_id, "target", i, k, m) for m, t in enumerate(mem(x.get("hgnc_targets"))) if isinstance(dec(t), dict)]
            for k, x in enumerate(map(dec, mem(s.get("triples")))):
                want += [(r.record_id, n, i, k, -1) for n in ("subject", "object") if isinstance(x, dict) and isinstance(dec(x.get(n)), dict)]
    assert sorted(tuple(r) for r in nested.record_nodes(df, "record_id", "payload").collect()) == sorted(want)


KB = {
    "id": "d1", "passages": [{"text": ["Dex raised EGFR. Aspirin blocked dexamethasone and TP53."], "offsets": [[10, 66]]}],
    "entities": [{"id": "e1", "type": "Chem", "text": ["Dex"], "offsets": [[10, 13]]}, {"id": "e2", "type": "Gene", "text": ["EGFR"], "offsets": [[21, 25]]}, {"id": "e3", "type": "Chem", "text": ["Aspirin"], "offsets": []}, {"id": "e4", "type": "Gene", "text": ["TP53"], "offsets": [[0, 4]]}, {"id": "e5", "type": "Chem", "text": ["dex"], "offsets": []}],
    "relations": [{"type": "up", "arg1_id": "e2", "arg2_id": "e1"}, {"type": "odd", "arg1_id": "e3", "arg2_id": "e4"}],
}


def test_training_rows(spark, tmp_path):
    (tmp_path / "kb.json").write_text(json.dumps({"train": [KB]}))
    docs = readers.annotated_documents(spark, str(tmp_path / "kb.json"))
    assert [r.split for r in docs.collect()] == ["train"]
    rows = training.relation_rows(docs, {"Chem": "CHEMICAL", "Gene": "GENE"}, [("CHEMICAL", "GENE")], {"up": "1"}).orderBy("place").collect()
    assert [(r.sentence, r.label) for r in rows] == [("@CHEMICAL$ raised @GENE$.", "1"), ("@CHEMICAL$ blocked dexamethasone and @GENE$.", "0")]
    df = spark.createDataFrame([(f"s{i}", "1" if i < 10 else "0") for i in range(100)], "sentence string, label string")
    assert training.balanced(df, F.col("label"), 2.0).groupBy("label").count().orderBy("label").collect() == [("0", 20), ("1", 10)]
    assert 0 < training.split_off(df, 0.3).where("split = 'dev'").count() < 60
    lines = spark.createDataFrame([("7\t@GENE$ x @CHEMICAL$\tCPR:3",), ("true\tthe @GENE$\tx",), ("index\tsentence\tlabel",)], "value string")
    assert sorted(tuple(r) for r in training.read_rows(lines, "value", ["CPR:3", "true"], {"CPR:3": "up"}).collect()) == [("@GENE$ x @CHEMICAL$", "up"), ("the @GENE$", "true")]


def test_placed_mentions(spark):
    rows = [("Dex raised dexa.", "dexa", [], (11, 15)), ("adex dex", "dex", [], (5, 8)), ("a\\Eb x", "a\\Eb", [], (0, 4)), ("x (p53)", "p53", [[13, 16]], (3, 6)), ("x (p53)", "p53", [[12, 15]], (3, 6)), ("xp53", "p53", [], None), ("abc", "", [[10, 13]], (0, 3)), ("abc", "", [], None), ("über alles", "ber", [], None), ("a.b a+b", "a+b", [], (4, 7))]
    df = spark.createDataFrame([(i, t, m, o) for i, (t, m, o, _) in enumerate(rows)], "i int, t string, m string, o array<array<int>>")
    got = {r.i: (tuple(r.p) if r.p else None) for r in df.select("i", training.placed(F.col("m"), F.col("o"), F.col("t"), F.lit(10)).alias("p")).collect()}
    assert got == {i: r[3] for i, r in enumerate(rows)}


def test_simple_sentences(spark):
    texts = ["A b. C d!  E", "dose 3.5 mg. x", "", "no end", "a.. b. ", "..."]
    got = [[tuple(s) for s in r.s] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(training.sentence_spans(F.col("t")).alias("s")).collect()]
    assert got == [[(0, 4), (5, 9), (11, 12)], [(7, 12), (13, 14)], [(0, 0)], [(0, 6)], [(0, 3), (4, 6)], [(0, 3)]]


def test_balanced_takes_just_the_quota(spark):
    rows = [("1", f"p{i}") for i in range(10)] + [("0", f"n{i}") for i in range(50)] + [("0", "same")] * 50 + [(None, "x")]
    df = spark.createDataFrame(rows, "label string, _row string")
    for ratio, want in ((0.0, 0), (2.0, 20), (7.7, 77), (50.0, 101)):
        got = training.balanced(df, F.col("label"), ratio).collect()
        assert sum(r.label == "1" for r in got) == 10 and len(got) == 10 + want
    assert training.balanced(df.where("label = '0'"), F.col("label"), 1.0).count() == 100 and training.balanced(df.limit(0), F.col("label"), 1.0).count() == 0


def test_sources_and_sinks(spark, tmp_path):
    p = tmp_path
    (p / "x").mkdir()
    (p / "x/PMC1.xml").write_text(JATS)
    (p / "x/PMC2.grobid.tei.xml").write_text(TEI)
    assert sorted((r.pmcid, r.scheme) for r in readers.xml_directory(spark, str(p / "x")).collect()) == [("PMC1", "jats"), ("PMC2", "tei")]
    (p / "g.json").write_text(json.dumps({"response": {"docs": [{"hgnc_id": "HGNC:1", "symbol": "A", "alias_symbol": ["B"], "name": "n"}]}}))
    g = readers.gene_list(spark, str(p / "g.json")).first()
    assert (g.symbol, g.alias_symbol, g.name, g.prev_symbol) == ("A", ["B"], ["n"], None)
    (p / "o.json").write_text(json.dumps({"graphs": [{"nodes": [{"id": "http://x/CHEBI_1", "lbl": "l"}], "edges": [{"sub": "http://x/CHEBI_1", "pred": "http://x/RO_0000087", "obj": "http://x/CHEBI_2"}]}]}))
    terms, edges = readers.ontology(spark, str(p / "o.json"))
    assert (terms.first().id, edges.first().obj) == ("CHEBI:1", "CHEBI:2")
    (p / "m.json").write_text(json.dumps({"s1": {"hgnc_symbol": "A", "control": "no"}}))
    assert [tuple(r)[1:] for r in readers.json_map(spark, str(p / "m.json"), "hgnc_symbol string, control string").collect()] == [("s1", "A", "no")]
    (p / "c.tsv").write_text("surface\tocc\nx\t3\nbad\ty\n")
    assert [tuple(r) for r in readers.counted_surfaces(spark, str(p / "c.tsv")).collect()] == [("x", 3)]
    df = spark.createDataFrame([("k", 1)], "key string, v int")
    writers.json_array(df, str(p / "a.json"))
    writers.json_keyed(df, "key", str(p / "k.json"))
    writers.report("R <x>", {"t": df}, str(p / "r.html"))
    writers.graph_page(df, df, "<script>__DATA__</script>", str(p / "graph.html"))
    writers.tsv(df, str(p / "t"))
    assert json.loads((p / "a.json").read_text()) == [{"key": "k", "v": 1}] and json.loads((p / "k.json").read_text()) == {"k": {"v": 1}} and "R &lt;x&gt;" in (p / "r.html").read_text()
    assert readers.tsv(spark, str(p / "t")).collect() == [("k", "1")]


def test_range_source(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(i) for i in range(800)]
    count = lambda a, b: sum(a <= x <= b for x in days) * 7
    parts = ranges.split_ranges(dt.date(2019, 1, 1), dt.date(2022, 12, 31), count, 100)
    assert all(count(a, b) <= 100 for a, b in parts) and sum(count(a, b) for a, b in parts) == 5600
    ids = ranges.read_ranges(spark, lambda a, b: sum(dt.date(2020, 1, 1) <= a + dt.timedelta(k) <= dt.date(2020, 1, 9) for k in range((b - a).days + 1)), lambda a, b: [(a + dt.timedelta(k)).isoformat() for k in range((b - a).days + 1)], dt.date(2020, 1, 1), dt.date(2020, 1, 9), 4)
    assert ids.count() == 9
    todo = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "k string")
    got = ranges.fetched(todo, spark.createDataFrame([("b",)], "k string"), "k", 2, lambda ks: [(k, k.upper()) for k in ks], "k string, v string")
    assert [tuple(r) for r in got.collect()] == [("a", "A")]


def test_targets(spark):
    nodes = spark.createDataFrame([("C1", "drugx"), ("R1", "dopamine receptor antagonist"), ("R2", "metabolite")], "id string, label string")
    edges = spark.createDataFrame([("C1", "RO_0000087", "R1"), ("C1", "RO_0000087", "R2"), ("C1", "is_a", "R2")], "sub string, pred string, obj string")
    names = spark.createDataFrame([("DRD2", "Dopamine-receptor"), ("X", "y")], "label string, name string")
    t = targets.role_targets(targets.chemical_roles(nodes, edges), names).collect()
    assert [(r.chemical, r.symbol, r.action, r["class"]) for r in t] == [("C1", "DRD2", "antagonist", "receptor")]
    table = spark.createDataFrame([("DRUGX-ABCD", "EGFR", "inhibitor", "TRUE", "true"), ("other", "TP53", None, "false", "false"), ("a+b", "Q", None, None, None)], "Drug_Name string, GENE_NAME string, interaction_type string, approved string, anti_neoplastic string")
    known = targets.interactions(table)
    chem = spark.createDataFrame([("C1", "drugx")], "chemical string, name string")
    g = targets.by_gene(targets.drug_targets(chem, known), spark.createDataFrame([("EGFR",)], "gene string")).collect()
    assert [(r.gene, r.chemicals, r.in_corpus, r.tier) for r in g] == [("EGFR", ["C1"], True, "approved anti-neoplastic")]
    assert [r.gene for r in targets.uncovered_drugs(known, chem).collect()] == ["TP53"]
    nodes_ = spark.createDataFrame([("EGFR", "gene"), ("EGFR", "disease")], "id string, kind string")
    view = targets.by_gene(targets.drug_targets(chem, known), spark.createDataFrame([("EGFR",)], "gene string"))
    assert {(r.kind, r.n_chemicals, r.tier) for r in graph.with_targets(nodes_, view).collect()} == {("gene", 1, "approved anti-neoplastic"), ("disease", 0, "other")}


def test_calibrators(spark):
    rows = [("m", (i % 50) / 50, int((i * 7) % 50 < i % 50)) for i in range(500)] + [("few", 0.5, 1)] * 10
    df = spark.createDataFrame(rows, "model string, p double, hit int")
    iso = evaluate.fitted(df, "model", "p", "hit").collect()
    assert [r.group for r in iso] == ["m"] and iso[0].y == sorted(iso[0].y)
    assert evaluate.fitted(df, "model", "p", "hit", "platt").first().a > 0


def test_text_matches(spark):
    df = spark.createDataFrame([("A line\nB end",), ("(b",), ("xa",), (None,)], "t string")
    hits = lambda q: [r.t for r in df.where(graph.text_matches(F.col("t"), q)).collect()]
    assert hits("/^b/") == [] and hits("/^b/m") == ["A line\nB end"] and hits("/line.b/s") == ["A line\nB end"] and hits("/XA$/g") == ["xa"]
    assert hits("/(b/") == [] and hits("(B") == ["(b"] and hits("/(?P<x>a)/") == [] and hits("/x/q") == [] and hits("/x/ii") == []


def test_components_across_rounds_and_hot_nodes(spark):
    chain = [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(300)] + [("hub", f"h{i:03d}") for i in range(300)] + [("z", "z")]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(chain, "lo string, hi string")).collect()}
    assert {v for k, v in got.items() if k[0] == "c"} == {"c0000"} and {v for k, v in got.items() if k[0] == "h"} == {"h000"} and got["z"] == "z" and len(got) == 603
    near = {r.id: r.hop for r in graph.neighbourhood(spark.createDataFrame(chain, "lo string, hi string"), spark.createDataFrame([("c0010",), ("hub",)], "id string"), 2).collect()}
    assert near["c0012"] == 2 and near["c0008"] == 2 and "c0013" not in near and near["h299"] == 1 and near["hub"] == 0


def test_models_by_name():
    assert graph.chosen_models(["b-gate", "a-Typed", "c"]) == ("a-Typed", "b-gate") and graph.chosen_models([]) == (None, None) and graph.chosen_models(["x"], gate="y") == (None, "y")


def test_weighted_fits_equal_repeated_points():
    import numpy as np

    rng = np.random.default_rng(3)
    x, y, n = rng.integers(0, 9, 40) / 10, rng.integers(0, 2, 40).astype(float), rng.integers(1, 6, 40).astype(float)
    r = n.astype(int)
    assert np.allclose(evaluate.isotonic(x, y, n)[1], evaluate.isotonic(np.repeat(x, r), np.repeat(y, r))[1])
    assert np.allclose(evaluate.platt(x, y, n, 200), evaluate.platt(np.repeat(x, r), np.repeat(y, r), None, 200))


def test_impact_bands_have_no_top(spark):
    r = spark.createDataFrame([(1e12,), (float("inf"),), (float("nan"),), (None,), (-1.0,), (50.0,)], "v double").select(corpus.impact_band(F.col("v")).alias("b")).collect()
    assert [x.b for x in r] == ["50+", "50+", None, None, None, "50+"]


def test_graph_chain_and_neighbourhood(spark):
    p = spark.createDataFrame([(f"n{i:03}", f"n{i + 1:03}") for i in range(60)] + [("x", "y"), ("z", "z")], "lo string, hi string")
    c = {r.id: r.component for r in graph.components(p).collect()}
    assert set(c.values()) == {"n000", "x", "z"} and len(c) == 64
    n = {r.id: r.hop for r in graph.neighbourhood(p, spark.createDataFrame([("n010",)], "id string"), 2).collect()}
    assert n == {"n010": 0, "n009": 1, "n011": 1, "n008": 2, "n012": 2}
    assert graph.min_cluster(p, 3).count() == 60 and graph.min_degree(p, 2).count() == 58
    assert graph.components(p.limit(0)).count() == 0
    assert spark.range(1).select(graph.text_matches(F.lit("A (b"), "/(b/").alias("x"), graph.text_matches(F.lit("abc"), "/A.C/").alias("y"), graph.text_matches(F.lit("abc"), "BC").alias("z")).first() == (False, True, True)


def test_nodes_of_odd_ends(spark):
    end = "struct<text: string, type: string, score: double, symbols: array<string>, control: string, labels: array<string>>"
    ends = [("LCC", "DISEASE", 1.0, None, None, ["x"]), ("tumour", "DISEASE", 1.0, None, None, ["lung neoplasm"]), ("OS", "DISEASE", 1.0, None, None, ["y"]), ("a", "GENETIC", 1.0, ["A", "B"], "no", None), ("a", "GENETIC", 1.0, ["MKI67"], "no", None), ("a", "GENETIC", 1.0, ["A"], "yes", None), ("c", "CHEMICAL", 1.0, None, None, [" c "])]
    df = spark.createDataFrame([(i, e) for i, e in enumerate(ends)], f"i int, e {end}")
    got = [tuple(r.n) if r.n else None for r in df.select("i", graph.node(F.col("e")).alias("n")).orderBy("i").collect()]
    assert got == [("disease", "lung large cell carcinoma"), ("disease", "lung cancer"), None, None, None, None, ("chemical", "c")]
    t = df.select("i", F.col("e").alias("subject"), F.col("e").alias("object"))
    flagged = spark.createDataFrame([("DISEASE", "lcc"), ("CHEMICAL", "a")], "type string, surface string")
    assert graph.without_flagged(t, flagged).count() == 6


def test_staged_tables_are_released(spark):
    import os

    from mentionmill import staging

    df = staging.staged(spark.range(5), "t")
    assert df.count() == 5
    path = staging._written[spark.sparkContext.applicationId][-1].removeprefix("file://")
    assert os.path.isdir(path)
    staging.release(spark)
    assert not os.path.isdir(path)
