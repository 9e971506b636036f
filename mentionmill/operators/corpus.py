"""Corpus steps: impact selection, preferred sources, categories with defaults, and reports."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionmill.functions import text as T


def nth_smallest(rows: DataFrame, value: str, ks: list[int], buckets: int = 1024) -> list[float | None]:
    """The values of ranks ``ks`` (from 0) in rising order, exact; null and NaN do not count, ranks beyond the end give None.

    The range is cut into equal buckets whose counts come from one aggregate with map-side combining; the buckets that hold a rank
    are cut again, all of them in one aggregate, until each holds one value. No sort, no single task, and at most ``buckets`` rows
    per rank come to the driver a round.
    """
    v = F.col("v")
    x = rows.select(F.col(value).cast("double").alias("v")).where("v is not null and not isnan(v)")
    r = x.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")).first()
    at = {k: (r.lo, r.hi, k) for k in ks if 0 <= k < r.n}  # the range that holds the rank, and the rank within it
    while wide := sorted({(lo, hi) for lo, hi, _ in at.values() if lo < hi}):
        cell = None
        for i, (lo, hi) in enumerate(wide):
            width = hi / buckets - lo / buckets
            place = F.least(F.lit(buckets - 1), F.floor((v - F.lit(lo)) / F.lit(width)).cast("int")) if width > 0 else (v > lo).cast("int")
            inside = F.struct(F.lit(i).alias("i"), place.alias("b"))
            cell = F.when(v.between(lo, hi), inside) if cell is None else cell.when(v.between(lo, hi), inside)
        counts = x.select("v", cell.alias("c")).where("c is not null").groupBy("c.i", "c.b").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
        found = sorted(counts.collect(), key=lambda c: (c.i, c.b))
        for k, (lo, hi, left) in at.items():
            if lo < hi:
                for c in found:
                    if wide[c.i] == (lo, hi):
                        if left < c.n:
                            at[k] = (c.lo, c.hi, left)
                            break
                        left -= c.n
    return [at[k][0] if k in at else None for k in ks]


def index_percentiles(rows: DataFrame, value: str, ps: list[float]) -> list[float | None]:
    """sorted[min(n - 1, int(p * n))] of the values that are present, for each p; None if there are none."""
    n = rows.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).count()
    return nth_smallest(rows, value, [min(n - 1, math.floor(p * n)) for p in ps])


def index_percentile(rows: DataFrame, value: str, p: float) -> float | None:
    return index_percentiles(rows, value, [p])[0]


def selected(pubs: DataFrame, p: float = 0.9, override: float | None = None) -> DataFrame:
    """Articles with a PMC id whose impact reaches the article-weighted percentile, or an override."""
    t = override if override is not None else index_percentile(pubs, "impact_factor", p)
    if t is None:
        return pubs.limit(0)
    return pubs.where(F.col("pmc_id").isNotNull() & (F.trim("pmc_id") != "") & (F.col("impact_factor") >= t) & ~F.isnan("impact_factor"))


def with_fallback(rows: DataFrame, keys: list[Column], lookup: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Rows with the value of the first key that the lookup holds, even where that value is null; one join for all keys."""
    ks = [f"_k{i}" for i in range(len(keys))]
    whole = F.concat_ws("\u0001", *[F.coalesce(F.concat(F.lit("s"), F.col(k)), F.lit("n")) for k in ks])  # nulls are equal here
    x = rows.withColumns(dict(zip(ks, keys, strict=True))).withColumn("_keys", whole)
    tries = F.array(*[F.struct(F.lit(i).alias("i"), F.col(k).alias("_k")) for i, k in enumerate(ks)])
    hit = x.select("_keys", *ks).distinct().select("_keys", F.explode(tries).alias("t")).select("_keys", "t.*")
    hit = hit.join(lookup.select(F.col(key).alias("_k"), F.col(value).alias("_v")), "_k")
    best = hit.groupBy("_keys").agg(F.min_by(F.struct("_v"), "i").alias("b")).select("_keys", F.col("b._v").alias(name))
    return x.drop(*ks).join(best, "_keys", "left").drop("_keys")


def preferred_union(preferred: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """All of one source, and of the other what the first does not have."""
    return preferred.unionByName(other.join(preferred.select(key).distinct(), key, "left_anti"))


# Article types of original research and of secondary synthesis; all others are neither.
ORIGINAL = ("research-article", "brief-report", "case-report", "rapid-communication", "report")
SECONDARY = ("review-article", "systematic-review", "meeting-report")


def results_category(article_type: Column) -> Column:
    return F.when(article_type.isin(*ORIGINAL), "original-results").when(article_type.isin(*SECONDARY), "secondary-synthesis").otherwise("non-research")


def impact_band(v: Column) -> Column:
    """Half-open bands of the impact factor."""
    # fixed values
    edges = (0, 1, 2, 3, 5, 10, 20, 50)
    out = None
    for lo, hi in zip(edges, [*edges[1:], None], strict=True):
        name = f"{lo}-{hi}" if hi else f"{lo}+"
        ok = (v >= lo) & (v < hi) if hi else (v >= lo) & ~F.isnan(v)
        out = F.when(ok, name) if out is None else out.when(ok, name)
    return out


def document_frequency(rows: DataFrame, doc: Column, title: Column) -> DataFrame:
    """(key, display, docs): in how many documents a heading stands, under the form that starts with a capital where one does."""
    shown = T.heading(title)
    x = rows.select(doc.alias("doc"), T.title_key(shown).alias("key"), shown.alias("shown")).where("key <> ''")
    n = x.select("doc", "key").distinct().groupBy("key").agg(F.count("*").alias("docs"))
    form = x.groupBy("key").agg(F.min(F.struct((~F.left("shown", F.lit(1)).rlike(r"\p{Lu}")).alias("small"), "shown")).alias("f"))
    return n.join(form, "key").select("key", F.col("f.shown").alias("display"), "docs")


# ---------------------------------------------------------------- XML by pattern, in the JVM
def article_type(xml: Column) -> Column:
    """The article-type of the opening tag, looked for in the first 20,000 characters."""
    found = F.regexp_extract(F.left(xml, F.lit(20_000)), r"<article\b[^>]*\barticle-type=\"([^\"]*)\"", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("unknown"))


def text_class(xml: Column) -> Column:
    return F.when(xml.isNull(), "missing").when(F.trim(xml) == "", "empty").when(xml.contains("<body"), "fulltext").when(xml.contains("pmc-articleset") | xml.contains("<article"), "abstract-only").otherwise("other")


def section_buckets(title: Column, kind: Column) -> Column:
    """The canonical parts of an article that a section heading (lower case) and type stand for."""
    types = F.split(F.lower(F.coalesce(kind, F.lit(""))), "[^a-z]+")
    of = lambda *names: F.exists(types, lambda t: t.isin(*names))
    has = lambda *words: title.rlike("|".join(words))
    # fixed values: words of headings
    return F.array_compact(
        F.array(
            F.when(of("intro", "introduction", "background") | has("introduction", "^background"), "Introduction"),
            F.when(of("methods", "methodology", "materials") | has("method", "materials and", "material and", "experimental", "statistical analys", "patients and", "subjects and", "data collection", "study design"), "Methods"),
            F.when(of("results") | has("results", "findings"), "Results"),
            F.when(of("discussion") | has("discussion"), "Discussion"),
            F.when(of("conclusion", "conclusions") | has("conclusion", "concluding remarks", "^summary$") | (title.endswith(" summary") & ~title.contains("reporting")), "Conclusion"),
        )
    )


def structure(xml: Column) -> Column:
    """Facts of one article's mark-up: title, abstract, references, body shape, sections, figures, tables."""
    body = F.regexp_extract(xml, r"(?s)<body\b.*?</body>", 0)
    shape = F.when(body == "", "front-only").when(body.rlike(r"<sec\b"), "structured").when(body.rlike(r"<preformat\b"), "OCR scanned").otherwise("unstructured")
    secs = F.regexp_extract_all(body, F.lit(r"(?s)<sec\b[^>]*>\s*(?:<label[^>]*>.*?</label>\s*)?<title[^>]*>.*?</title>"), F.lit(0))
    parts = F.transform(secs, lambda s: section_buckets(F.lower(T.heading(F.regexp_extract(s, r"(?s)<title[^>]*>(.*?)</title>", 1))), F.regexp_extract(s, r'sec-type="([^"]*)"', 1)))
    title = T.squeeze(F.regexp_replace(F.regexp_extract(xml, r"(?s)<article-title\b[^>]*>(.*?)</article-title>", 1), "<[^>]+>", " "))
    return F.struct(
        (title != "").alias("has_title"), xml.rlike(r"<abstract\b").alias("has_abstract"), xml.rlike(r"<ref-list\b").alias("has_reflist"), F.regexp_count(xml, F.lit(r"<ref\b")).alias("n_refs"), shape.alias("shape"),
        F.array_sort(F.array_distinct(F.flatten(parts))).alias("sections"), F.regexp_count(xml, F.lit(r"<fig\b")).alias("n_figures"), F.regexp_count(xml, F.lit(r"<table-wrap\b")).alias("n_tables"),
    )


def tei_structure(xml: Column) -> Column:
    """Facts of one TEI record: title, abstract, divisions, references, and the canonical parts its heads stand for."""
    body = F.regexp_extract(xml, r"(?s)<body\b[^>]*>(.*?)</body>", 1)
    plain = lambda p: T.squeeze(F.regexp_replace(F.regexp_extract(xml, p, 1), "<[^>]+>", " "))
    heads = F.transform(F.regexp_extract_all(body, F.lit(r"(?s)<head\b[^>]*>(.*?)</head>"), F.lit(1)), lambda h: F.lower(T.heading(h)))
    return F.struct(
        (plain(r"(?s)<title\b[^>]*>(.*?)</title>") != "").alias("has_title"), (plain(r"(?s)<abstract\b[^>]*>(.*?)</abstract>") != "").alias("has_abstract"), F.regexp_count(body, F.lit(r"<div\b")).alias("n_divs"),
        F.regexp_count(xml, F.lit(r"<biblStruct\b")).alias("n_refs"), F.array_sort(F.array_distinct(F.flatten(F.transform(heads, lambda h: section_buckets(h, F.lit("")))))).alias("sections"),
    )


def section_titles(docs: DataFrame, doc: str, xml: str) -> DataFrame:
    """(doc, title, kind): the section headings of each record, captions of figures and tables left out."""
    x = F.col(xml)
    tei = F.left(x, F.lit(800)).rlike("www.tei-c.org|<TEI")
    bare = F.regexp_replace(x, r"(?is)<figure\b[^>]*>.*?</figure>|<fig\b[^>]*>.*?</fig>|<table-wrap\b[^>]*>.*?</table-wrap>", " ")
    heads = F.transform(F.regexp_extract_all(bare, F.lit(r"(?is)<head\b[^>]*>(.*?)</head>"), F.lit(1)), lambda h: F.struct(h.alias("title"), F.lit("").alias("kind")))
    secs = F.transform(F.regexp_extract_all(bare, F.lit(r"(?is)<sec\b[^>]*>\s*(?:<label[^>]*>.*?</label>\s*)?<title[^>]*>.*?</title>"), F.lit(0)), lambda s: F.struct(F.regexp_extract(s, r"(?is)<title[^>]*>(.*?)</title>", 1).alias("title"), F.lower(F.regexp_extract(s, r'(?i)sec-type="([^"]*)"', 1)).alias("kind")))
    y = docs.where(x.isNotNull()).select(F.col(doc).alias("doc"), F.explode(F.when(tei, heads).otherwise(secs)).alias("h"))
    return y.select("doc", T.heading(F.col("h.title")).alias("title"), F.col("h.kind").alias("kind")).where("title <> ''")


def coverage(facts: DataFrame) -> DataFrame:
    """(part, articles, share) over a ``structure`` column s: documents' parts, body shapes, sections, and how complete the four main sections are.

    One pass: each article yields its marks, and the marks are counted.
    """
    s = F.col("s")
    four = F.size(F.array_intersect(s["sections"], F.array(*[F.lit(v) for v in ("Introduction", "Methods", "Results", "Discussion")])))
    marks = F.array_compact(F.concat(
        F.array(F.lit("all"), F.when(s["has_title"], "title"), F.when(s["has_abstract"], "abstract"), F.when(s["has_reflist"], "references"), F.when(s["n_figures"] > 0, "figures"), F.when(s["n_tables"] > 0, "tables"), F.concat(F.lit("shape: "), s["shape"]), F.concat(F.lit("main sections: "), four.cast("string")), F.when(~s["has_abstract"], F.concat(F.lit("no abstract, shape: "), s["shape"]))),
        F.transform(s["sections"], lambda v: F.concat(F.lit("section: "), v)),
    ))
    n = facts.select(F.explode(marks).alias("part")).groupBy("part").agg(F.count("*").alias("articles"))
    total = n.where("part = 'all'").select(F.col("articles").alias("t"))
    return n.withColumn("share", F.try_divide("articles", total.scalar()))
