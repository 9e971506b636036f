"""Best representative of a group of duplicates, chosen field by field.

Every row becomes one candidate per field that it can supply, with the field's ranking put into common sort columns. One window
per (group, field) then ranks completeness (unusable values are no candidates), trust and recency, with the row's unique order
as last tie-break. Catalyst turns the rank filter into a group limit on both sides of the exchange, so a group that holds a
third of all rows is cut to its best rows per task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words that stand for a missing value, compared in lower case without blanks at the ends.
PLACEHOLDERS = ("", "-", "--", "?", "n/a", "na", "nan", "none", "null", "unknown", "undefined", "tbd")


def usable_text(c: Column) -> Column:
    """Not null, not blank and no placeholder word."""
    folded = F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    return c.isNotNull() & ~folded.isin(*PLACEHOLDERS)


def usable_share(c: Column) -> Column:
    """A number from 0 to 1; null and NaN are not."""
    return c.isNotNull() & ~F.isnan(c) & (c >= 0) & (c <= 1)


def survivors(rows: DataFrame, group: Column, order: Column, fields: dict[str, tuple[Column, list[Column]]], min_size: int = 2) -> DataFrame:
    """(group_order, field, from_order): which row supplies each field of each group.

    ``fields`` has, by name, whether a row can supply the field and the columns that rank it, smallest first, at most three, null
    last; ``order`` is unique and breaks ties. group_order is the smallest order of the group. Rows with null group belong to
    none; groups below ``min_size`` rows give nothing; a field that no row can supply is left out. Empty input gives no rows.
    """
    last = F.lit(float("inf"))
    pad = lambda ks: [F.coalesce(k.cast("double"), last) for k in ks] + [F.lit(0.0)] * (3 - len(ks))
    cand = [F.when(ok, F.struct(F.lit(name).alias("field"), *[k.alias(f"k{i}") for i, k in enumerate(pad(keys))])) for name, (ok, keys) in fields.items()]
    cand.append(F.struct(F.lit(None).cast("string").alias("field"), *[F.lit(0.0).alias(f"k{i}") for i in range(3)]))
    # a filter on the group would be pushed below and repeat the group's expression; no candidates does the same
    each = F.when(group.isNotNull(), F.array_compact(F.array(*cand)))
    x = rows.select(group.alias("g"), order.alias("o"), F.explode(each).alias("c"))
    x = x.select("g", "o", F.coalesce("c.field", F.lit("")).alias("field"), "c.k0", "c.k1", "c.k2")
    w = Window.partitionBy("g", "field").orderBy("k0", "k1", "k2", "o")
    top = x.withColumn("r", F.row_number().over(w)).where(F.col("r") <= min_size)
    of = lambda name: F.min(F.when((F.col("field") == name) & (F.col("r") == 1), F.col("o")))
    best = top.groupBy("g").agg(
        F.min(F.when(F.col("field") == "", F.col("o"))).alias("group_order"), F.count_if(F.col("field") == "").alias("size"), *[of(n).alias(f"f_{i}") for i, n in enumerate(fields)]
    )
    best = best.where(F.col("size") >= min_size)
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"f_{i}").alias("from_order")) for i, n in enumerate(fields)]))
    return best.select("group_order", each.alias("s")).select("group_order", "s.field", "s.from_order").where("from_order is not null")


_PAIR_ID = r"^\W*([a-z]*\d+)(?:\.[a-z.]+)?[\W_]+([0-9a-f]{12})[\W_]+(\d+)\W+(\d+)[\W_]+(\d+)\W+(\d+)\W*$"


def with_pair_group(rows: DataFrame, pair_id: str, name: str) -> DataFrame:
    """``rows`` with one key for all spellings of a pair id: article, sentence digest and two spans in either order.

    Case, blanks, the separators and the article's file ending do not matter. What does not read as a pair id is a group by its
    folded text. Null stays null. The pattern runs once per row; the spans are compared in a projection of their own, which
    Catalyst does not merge into the first, as its result is used more than once.
    """
    flat = F.lower(F.regexp_replace(F.col(pair_id), r"(?U)\s+", " "))
    x = rows.withColumn("_parts", F.split(F.regexp_replace(flat, _PAIR_ID, "$1\u0001$2\u0001$3\u0001$4\u0001$5\u0001$6"), "\u0001"))
    part = lambda i: F.get("_parts", F.lit(i)).try_cast("bigint")
    one, two = [F.concat_ws("-", part(i), part(i + 1)) for i in (2, 4)]
    swap = (part(2) > part(4)) | ((part(2) == part(4)) & (part(3) > part(5)))
    ordered = F.concat_ws(":", F.get("_parts", F.lit(0)), F.get("_parts", F.lit(1)), F.when(swap, two).otherwise(one), F.when(swap, one).otherwise(two))
    key = F.when(F.size("_parts") == 6, ordered).otherwise(F.trim(F.get("_parts", F.lit(0))))
    return x.withColumn(name, F.when(F.col(pair_id).isNotNull(), F.unhex(F.md5(key)))).drop("_parts")


def model_name(c: Column) -> Column:
    """A model's name without folder, version mark, case, blanks and underscores."""
    x = F.regexp_replace(F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), r"^.*/", "")
    return F.regexp_replace(F.regexp_replace(x, r"@.*$", ""), r"(?U)[_\s]+", "-")


def best_verdicts(scored: DataFrame, models: DataFrame) -> DataFrame:
    """(group_ord, field, from_ord) over scored relation rows: score, predicate and polarity each from the row that deserves it.

    A model that is not listed ranks below all listed ones. A null scored_at counts as the earliest.
    """
    trust = models.select(model_name(F.col("model")).alias("_m"), F.col("trust_rank").alias("_trust")).groupBy("_m").agg(F.min("_trust").alias("_trust"))
    x = with_pair_group(scored, "pair_id", "_group").select("ord", "_group", "score", "polarity", "scored_at", F.col("predicate.text").alias("_predicate"), model_name(F.coalesce("model", "predicate.model")).alias("_m")).join(trust, "_m", "left")
    latest = -F.unix_micros(F.col("scored_at").cast("timestamp"))
    rank = F.col("_trust")
    fields = {
        "score": (usable_share(F.col("score")), [-F.col("score"), rank, latest]),
        "predicate": (usable_text(F.col("_predicate")), [rank, latest]),
        "polarity": (usable_text(F.col("polarity")), [latest]),
    }
    out = survivors(x, F.col("_group"), F.col("ord"), fields)
    return out.select(F.col("group_order").alias("group_ord"), "field", F.col("from_order").alias("from_ord"))
