"""Items that appear together: pair counts and association over all records, with large baskets cut into blocks.

A basket of n items has n(n-1)/2 pairs, so one basket with many items would be one long task. Baskets above ``chunk`` items are
cut into k = n / chunk item chunks by a hash of the item; every pair of chunks is its own group, so the work of one basket spreads
over k(k+1)/2 groups of at most about chunk^2 pairs. Each item is sent k times, which is 2 / chunk of the pairs that the basket
has anyway. Baskets of up to ``chunk`` items pair up where they lie. Pairs are never held as a list: first items are exploded,
then their partners, row by row. Both kinds meet in one count with map-side combining.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionmill.staging import staged

#: Items of a chunk.
CHUNK = 128


def record_key(*parts: Column) -> Column:
    """16 bytes that stand for a tuple of strings; nulls are values of their own, equal to each other."""
    text = F.concat_ws("\u0001", *[F.coalesce(F.concat(F.lit("s"), p), F.lit("n")) for p in parts])
    return F.unhex(F.md5(text))


def distinct_items(rows: DataFrame, record: Column, items: Column) -> DataFrame:
    """(record, item), each once. ``items`` is an array; null and blank items and null arrays give nothing."""
    x = rows.select(record.alias("record"), F.explode(items).alias("item"))
    return x.where(F.col("item").isNotNull() & (F.trim("item") != "")).distinct()


def _within(baskets: DataFrame) -> DataFrame:
    """(a, b): all pairs of the sorted arrays ``xs`` without repeats."""
    x = baskets.select("xs", F.posexplode("xs").alias("i", "a"))
    return x.select("a", F.explode(F.slice("xs", F.col("i") + 2, F.size("xs"))).alias("b"))


def _blocked(large: DataFrame, chunk: int) -> DataFrame:
    """(a, b): the pairs of baskets with their size n; one group per pair of item chunks."""
    k = F.ceil(F.col("n") / chunk).cast("int")
    x = large.withColumn("k", k).withColumn("c", F.pmod(F.xxhash64("item"), F.col("k")).cast("int"))
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    x = x.select("record", F.least("c", "other").alias("lo"), F.greatest("c", "other").alias("hi"), "c", "item")
    side = lambda at: F.collect_list(F.when(F.col("c") == F.col(at), F.col("item")))
    g = x.groupBy("record", "lo", "hi").agg(side("lo").alias("left"), side("hi").alias("right"))
    within = _within(g.where("lo = hi").select(F.array_sort("left").alias("xs")))
    across = g.where("lo < hi").select(F.explode("left").alias("x"), "right").select("x", F.explode("right").alias("y"))
    return within.unionByName(across.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))


def pair_counts(items: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(a, b, n_ab) with a < b from ``items`` (record, item), each row once. An item alone in its record is in no pair."""
    sizes = items.groupBy("record").agg(F.count("*").alias("n"))
    big = sizes.where(F.col("n") > chunk)
    small = items.join(big, "record", "left_anti").groupBy("record").agg(F.array_sort(F.collect_list("item")).alias("xs"))
    ordinary = _within(small.where(F.size("xs") > 1))
    blocked = _blocked(items.join(big, "record"), chunk)
    return ordinary.unionByName(blocked).groupBy("a", "b").agg(F.count("*").alias("n_ab"))


def associations(rows: DataFrame, record: Column, items: Column, min_pairs: int = 1, chunk: int = CHUNK) -> DataFrame:
    """(a, b, n_ab, n_a, n_b, n) for pairs in at least ``min_pairs`` records; n is the number of records with any item.

    Empty input gives no rows. With ``min_pairs`` 1 there is a row for every pair that occurs, which is what is asked for: their
    number grows with the square of the vocabulary, and larger ``min_pairs`` bound it. Repeated rows and repeated items of a record count once. The number of records comes in as a
    scalar subquery, not as a join. Item counts join by shuffle or, below the session's threshold, by broadcast.
    """
    d = staged(distinct_items(rows, record, items), "items")
    singles = d.groupBy("item").agg(F.count("*").alias("k"))
    total = d.select("record").distinct().agg(F.count("*").alias("n"))
    x = pair_counts(d, chunk).where(F.col("n_ab") >= min_pairs)
    x = x.join(singles.select(F.col("item").alias("a"), F.col("k").alias("n_a")), "a")
    x = x.join(singles.select(F.col("item").alias("b"), F.col("k").alias("n_b")), "b")
    return x.select("a", "b", "n_ab", "n_a", "n_b", total.scalar().alias("n"))


def exceeds_chance(factor: int) -> Column:
    """n_ab * n >= factor * n_a * n_b, exact beyond 64 bits."""
    d = lambda c: F.col(c).cast("decimal(19,0)")
    return d("n_ab") * d("n") >= d("n_a") * d("n_b") * F.lit(factor)
