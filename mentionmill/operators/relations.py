"""Entity pairs within sentences: adjacent pairs as rule triples, all pairs in a window as candidates, scoring and routing.

A sentence's entities lie in one array, so pairs are formed inside the row; nothing is shuffled and a long sentence costs its own
row only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionmill.functions import scores
from mentionmill.functions import text as T

# Fixed value: stems that make a connecting text a relation.
RELATION_CUE = (
    r"(?i)induc|inhibit|activat|regulat|express|\bbind|bound|target|associat|interact|phosphorylat|suppress|promot|mediat|overexpress|knock\s?down|knock\s?out|"
    r"silenc|deplet|mutat|mutant|treat|encod|\bcaus|block|modulat|stimulat|increas|decreas|reduc|elevat|attenuat|amelior|enhanc|repress|sensiti|resist|cleav|"
    r"degrad|secret|recruit|antagon|agoni|deficien|depend|correlat|involv|signal|\brole\b|\beffect|abolish|abrogat|disrupt|restor|rescu|prevent|trigger|driv|"
    r"confer|\bloss\b|deletion|amplif|fusion|translocat|methylat|acetylat|ubiquitin|glycosylat|inhibitor|activator|agonist|antagonist"
)
# Words of negation and of speculation.
NEGATION = r"\b(?:no|not|n't|cannot|can't|without|never|neither|nor|none|fails?|failed|unable|absen(?:ce|t)|lacks?|lacking|unaffected|unchanged|unaltered|negative)\b"
SPECULATION = (
    r"\b(?:may|might|could|would|possibl[ey]|potential(?:ly)?|putative|suggest\w*|likely|presumabl\w*|appears?|appeared|seems?|seemed|hypothes\w*|speculat\w*|"
    r"propos\w*|candidate|predict\w*|probabl[ey]|presum\w*|conceivabl\w*|assum\w*)\b"
)
MAX_PREDICATE, MAX_GAP, LEFT, RIGHT = 120, 300, 40, 30
# Marker names by entity type, and the exception on drug-drug routes.
MARKERS = {"GENETIC": "GENE", "DISEASE": "DISEASE", "CHEMICAL": "CHEMICAL"}
DRUG_MARKERS = {**MARKERS, "CHEMICAL": "DRUG"}


def ordered(entities: Column) -> Column:
    """Entities with offsets in reading order; equal starts keep their order."""
    kept = F.filter(F.transform(entities, lambda e, i: F.struct(e["start"].alias("at"), i.alias("i"), e.alias("e"))), lambda s: s["at"].isNotNull() & s["e"]["end"].isNotNull())
    return F.transform(F.array_sort(kept, lambda a, b: F.when((a["at"] < b["at"]) | ((a["at"] == b["at"]) & (a["i"] < b["i"])), -1).otherwise(1)), lambda s: s["e"])


def adjacent_triples(sentences: DataFrame) -> DataFrame:
    """(subject, predicate, object, pmid, section, sentence): neighbours whose connecting text reads as a relation.

    The connecting text must be visible, at most 120 characters, hold a Latin letter and a relation stem. Sentences with fewer
    than two placed entities, and null texts, give nothing.
    """
    x = sentences.select("pmid", F.col("section_type").alias("section"), F.col("text").alias("sentence"), ordered(F.col("entities")).alias("es"))
    n = F.size("es")
    pairs = F.transform(F.slice("es", 1, F.greatest(n - 1, F.lit(0))), lambda a, i: F.struct(a.alias("a"), F.get("es", i + 1).alias("b")))
    x = x.where(n > 1).select("pmid", "section", "sentence", F.explode(pairs).alias("p"))
    x = x.withColumn("predicate", T.squeeze(T.between(F.col("sentence"), F.col("p.a.end"), F.col("p.b.start"))))
    x = x.where((F.col("predicate") != "") & (F.length("predicate") <= MAX_PREDICATE) & F.col("predicate").rlike("[A-Za-z]") & F.col("predicate").rlike(RELATION_CUE))
    end = lambda k: F.struct(T.entity_text(F.col(f"p.{k}.label"), F.col(f"p.{k}.text")).alias("text"), F.col(f"p.{k}.label").alias("type"))
    return x.select(end("a").alias("subject"), F.struct(F.col("predicate").alias("text"), F.lit("relation").alias("type")).alias("predicate"), end("b").alias("object"), "pmid", "section", "sentence")


def assertion(text: Column, a: Column, b: Column) -> Column:
    """(polarity, modality, cues) from the words around two spans: 40 characters before, 30 behind."""
    region = T.between(text, F.greatest(F.lit(0), a["start"] - LEFT), b["end"] + RIGHT)
    found = lambda words: F.transform(F.regexp_extract_all(region, F.lit("(?i)" + words), F.lit(0)), lambda w: F.lower(w))
    no, maybe = found(NEGATION), found(SPECULATION)
    return F.struct(
        F.when(F.size(no) > 0, "negated").otherwise("positive").alias("polarity"), F.when(F.size(maybe) > 0, "speculated").otherwise("asserted").alias("modality"), F.array_sort(F.array_distinct(F.concat(no, maybe))).alias("cues")
    )


def marker(names: dict[str, str]):
    """A function from a label column to the marker's name; unknown labels stand for themselves."""
    table = F.create_map(*[F.lit(v) for kv in names.items() for v in kv])
    return lambda label: F.coalesce(F.try_element_at(table, label), label)


def candidate_pairs(sentences: DataFrame, max_gap: int = MAX_GAP) -> DataFrame:
    """Every ordered pair of a sentence's entities that do not overlap and stand at most ``max_gap`` characters apart.

    Columns: pmid, section, sentence, cues, result_margin, subject and object (text, type, score), connecting, polarity,
    modality, assertion_cues, type_pair, self_pair, blinded, pair_id. ``max_gap`` 0 means no limit.
    """
    x = sentences.select("pmid", F.col("section_type").alias("section"), F.col("text").alias("sentence"), "cues", "result_margin", ordered(F.col("entities")).alias("es"))
    near = lambda a, b: (b["start"] >= a["end"]) & (F.lit(max_gap == 0) | (b["start"] - a["end"] <= max_gap))
    later = lambda i: F.slice("es", i + 2, F.greatest(F.size("es") - i - 1, F.lit(0)))
    pairs = F.flatten(F.transform("es", lambda a, i: F.transform(F.filter(later(i), lambda b: near(a, b)), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    x = x.where(F.size("es") > 1).select("pmid", "section", "sentence", "cues", "result_margin", F.explode(pairs).alias("p"))
    a, b = F.col("p.a"), F.col("p.b")
    x = x.withColumn("s", assertion(F.col("sentence"), a, b))
    end = lambda e: F.struct(T.entity_text(e["label"], e["text"]).alias("text"), e["label"].alias("type"), e["score"].alias("score"))
    types = F.array_join(F.array_sort(F.array_distinct(F.array(a["label"], b["label"]))), "-")
    return x.select(
        "pmid", "section", "sentence", "cues", "result_margin", end(a).alias("subject"), end(b).alias("object"),
        T.squeeze(T.between(F.col("sentence"), a["end"], b["start"])).alias("connecting"), "s.polarity", "s.modality", F.col("s.cues").alias("assertion_cues"),
        types.alias("type_pair"), ((a["label"] == b["label"]) & (T.entity_text(a["label"], a["text"]) == T.entity_text(b["label"], b["text"]))).alias("self_pair"),
        T.blinded(F.col("sentence"), a, b, marker(MARKERS)).alias("blinded"), T.pair_id(F.col("pmid"), F.col("sentence"), a, b).alias("pair_id"),
    )


def routed(pairs: DataFrame, routes: DataFrame, exclusive: bool = True) -> DataFrame:
    """Pairs with the model that scores them. ``routes`` has type_pair, model and precedence; a null type_pair takes any pair.

    Exclusive keeps the model of the smallest precedence, additive keeps all. Pairs without a route drop out. The routes are
    gathered per type in one aggregate and joined to the pairs, whatever their number; those for any pair come in as one array.
    """
    ranked = F.array_sort(F.collect_list(F.struct("precedence", "model")))
    own = routes.where("type_pair is not null").groupBy("type_pair").agg(ranked.alias("_own"))
    every = routes.where("type_pair is null").agg(ranked.alias("_any"))
    x = pairs.join(own, "type_pair", "left").withColumn("_any", every.scalar())
    listed = F.array_sort(F.concat(F.coalesce("_own", F.slice("_any", 1, 0)), "_any"))
    options = F.transform(listed, lambda o: o["model"])
    kept = F.slice(options, 1, 1) if exclusive else F.array_distinct(options)
    return x.withColumn("model", F.explode(kept)).select(*pairs.columns, "model")


def relational(cues: Column, connecting: Column) -> Column:
    return F.coalesce(F.array_contains(cues, "relation"), F.lit(False)) | F.coalesce(connecting.rlike(RELATION_CUE), F.lit(False))


def scored(pairs: DataFrame, verdicts: DataFrame, negative: tuple[str, ...] = ("no_relation", "none", "negative", "false", "0"), min_score: float = scores.MIN_SCORE) -> DataFrame:
    """Pairs joined with their models' verdicts and scored. ``verdicts`` has pair_id, model, labels and probabilities.

    The likeliest label is the verdict; negative labels and scores under ``min_score`` drop out.
    """
    x = pairs.join(verdicts.select("pair_id", "model", "labels", scores.top_two(F.col("probabilities")).alias("top")), ["pair_id", "model"])
    first, second = F.get("top", F.lit(0)), F.get("top", F.lit(1))
    x = x.withColumn("label", F.get("labels", first["place"])).where(~F.lower("label").isin(*negative))
    value = scores.composite(first["p"], F.col("subject.score"), F.col("object.score"), relational(F.col("cues"), F.col("connecting")), F.col("result_margin"), F.col("section"), F.col("self_pair"), F.col("label"))
    x = x.withColumn("score", value).withColumn("score_2nd", scores.round4(F.coalesce(second["p"], first["p"])))
    return x.where(F.col("score") >= min_score).drop("labels", "top")


def entity_union(mentions: DataFrame, key: list[str]) -> DataFrame:
    """Mentions of several taggers as one set: one row per key, span, label and domain with the highest score."""
    return mentions.groupBy(*key, "start", "end", "label", "domain").agg(F.max_by("text", "score").alias("text"), F.max("score").alias("score"))


def pair_counts(rows: DataFrame, a: str, b: str, name: str = "pair_count") -> DataFrame:
    """Rows with the number of rows of the same ordered pair; the counts come from one aggregate, so a hot pair stays spread."""
    n = rows.groupBy(a, b).agg(F.count("*").alias(name))
    return rows.join(n, [a, b], "left")


def first_per_key(rows: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """The first row per key in an order; Catalyst cuts the groups before and after the exchange."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_r = 1").drop("_r")
