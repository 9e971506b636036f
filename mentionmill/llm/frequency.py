"""Exact frequency of every value, by heavy-light aggregation.

A bounded, mergeable top-k sketch over all rows names the likely heavy values. It only decides the route: heavy values are summed
exactly in one counter array per task, so they shuffle one row per task and value; the rest shuffles by value. A wrong guess of
the sketch costs time, never exactness.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionmill.session import ship
from mentionmill.staging import staged

#: Most heavy values (this bounds what is broadcast and each task's counter array) and the sketch's size.
HEAVY, TRACKED = 256, 4096


def _count(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, records = np.zeros(k, np.int64), np.zeros(k, np.int64)
        for b in batches:
            i = b["slot"].to_numpy()
            np.add.at(total, i, b["weight"].to_numpy())
            records += np.bincount(i, minlength=k)
        seen = np.flatnonzero(records)
        yield pd.DataFrame({"slot": seen.astype(np.int32), "total": total[seen], "records": records[seen]})

    return run


def heavy_values(rows: DataFrame, value: str, k: int = HEAVY) -> list[str]:
    """At most ``k`` values, likely the most frequent of all rows."""
    top = rows.agg(F.expr(f"transform(approx_top_k(`{value}`, {k}, {TRACKED}), t -> t.item)").alias("t")).first()
    return list(dict.fromkeys(v for v in (top.t or []) if v is not None)) if top else []


def frequencies(rows: DataFrame, value: str, weight: str, k: int = HEAVY) -> DataFrame:
    """(value, total, records): the sum of ``weight`` and the number of rows of every distinct value.

    ``rows`` has one row per record and value, a value that is not null and a weight that is not null. Values compare as stored.
    Empty input gives no rows.
    """
    spark = rows.sparkSession
    ship(spark)
    x = rows.select(F.col(value).alias("value"), F.col(weight).cast("bigint").alias("weight"))
    heavy = heavy_values(x, "value", k)
    light = x
    out = []
    if heavy:
        slots = spark.createDataFrame([(v, i) for i, v in enumerate(heavy)], "value string, slot int")
        mine = F.broadcast(slots)  # at most k rows
        counted = x.join(mine, "value").select("slot", "weight").mapInPandas(_count(len(heavy)), "slot int, total bigint, records bigint")
        summed = counted.groupBy("slot").agg(F.sum("total").alias("total"), F.sum("records").alias("records"))
        out.append(summed.join(mine, "slot").select("value", "total", "records"))
        light = x.join(mine, "value", "left_anti")
    out.append(light.groupBy("value").agg(F.sum("weight").alias("total"), F.count("*").alias("records")))
    return out[0].unionByName(out[1]) if len(out) > 1 else out[0]


def latest_counts(rows: DataFrame, article: Column, value: str, count: str, at: str, order: str) -> DataFrame:
    """(article, value, count) of the row with the latest ``at`` (then the larger ``order``) of each article and value.

    Rows with a null or non-positive count, a null value or a null article do not count. A null ``at`` is the earliest.
    """
    x = rows.select(article.alias("article"), F.col(value).alias("value"), F.col(count).cast("bigint").alias("n"), F.coalesce(F.unix_micros(F.col(at).cast("timestamp")), F.lit(-(2**62))).alias("at"), F.col(order).alias("o"))
    x = x.where("n > 0 and value is not null and article is not null")
    return x.groupBy("article", "value").agg(F.max_by("n", F.struct("at", "o")).alias("n"))


def marked_frequencies(rows: DataFrame, article: Column, value: str, count: str, at: str, order: str, common_share: int = 20, rare_total: int = 2) -> DataFrame:
    """(value, total, records, articles, mark) for every distinct value.

    mark is ``common`` if the value is in at least one of ``common_share`` articles, else ``rare`` if its total is at most
    ``rare_total``, else null.
    """
    d = staged(latest_counts(rows, article, value, count, at, order), "latest")
    articles = d.select("article").distinct().agg(F.count("*").alias("articles"))
    x = frequencies(d, "value", "n").withColumn("articles", articles.scalar())
    mark = F.when(F.col("records") * common_share >= F.col("articles"), "common").when(F.col("total") <= rare_total, "rare")
    return x.withColumn("mark", mark)
