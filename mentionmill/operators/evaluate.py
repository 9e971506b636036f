"""Evaluation and calibration of verdicts."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mentionmill.session import ship

MIN_POINTS = 20


def confusion(rows: DataFrame, gold: str, pred: str) -> DataFrame:
    return rows.groupBy(gold, pred).agg(F.count("*").alias("n"))


def micro_scores(rows: DataFrame, gold: str, pred: str, negative: str) -> DataFrame:
    """tp, fp, fn, n, right, precision, recall, f1, accuracy; the negative label counts only as a miss or false alarm."""
    g, p = F.col(gold), F.col(pred)
    x = rows.agg(F.count_if((g == p) & (p != negative)).alias("tp"), F.count_if((g != p) & (p != negative)).alias("fp"), F.count_if((g != p) & (g != negative)).alias("fn"), F.count("*").alias("n"), F.count_if(g == p).alias("right"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    x = x.withColumn("precision", zero(F.try_divide("tp", F.col("tp") + F.col("fp")))).withColumn("recall", zero(F.try_divide("tp", F.col("tp") + F.col("fn"))))
    x = x.withColumn("f1", zero(F.try_divide(F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))))
    return x.withColumn("accuracy", zero(F.try_divide("right", "n")))


def calibration_bins(rows: DataFrame, p: str, hit: str, bins: int = 10) -> DataFrame:
    """(bin, n, confidence, accuracy) over equal bins that are closed above; the lowest holds 0."""
    b = F.greatest(F.lit(1), F.ceil(F.col(p) * bins)).cast("int")
    return rows.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg(p).alias("confidence"), F.avg(F.col(hit).cast("double")).alias("accuracy"))


def calibration_error(rows: DataFrame, p: str, hit: str, bins: int = 10) -> DataFrame:
    """The expected calibration error: |accuracy - confidence| weighted by the bins' rows."""
    return calibration_bins(rows, p, hit, bins).agg(F.coalesce(F.sum(F.col("n") * F.abs(F.col("accuracy") - F.col("confidence"))) / F.sum("n"), F.lit(0.0)).alias("ece"))


def best_threshold(rows: DataFrame, score: str, gold_positive: str, right_if_positive: str, buckets: int = 10_000) -> DataFrame:
    """(threshold, f1): the score from 0 to 1 from which calling a row positive gives the best micro F1; ties go to the lowest.

    Every distinct score is a candidate, and so is 0. Rows are counted per score first; running totals are prefix sums in two
    levels, over ``buckets`` equal parts of the range and within each part, so no window holds all scores.
    """
    part = F.least(F.lit(buckets - 1), F.floor(F.col("t") * buckets)).cast("int")
    at = rows.groupBy(F.col(score).alias("t")).agg(F.count("*").alias("n"), F.count_if(right_if_positive).alias("tp"), F.count_if(gold_positive).alias("pos")).withColumn("part", part)
    sums = ("n", "tp")
    parts = at.groupBy("part").agg(*[F.sum(c).alias(c) for c in sums])
    above = Window.partitionBy(F.lit(0)).orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in sums])
    down = Window.partitionBy("part").orderBy(F.desc("t"))
    x = at.join(parts, "part").select("t", *[(F.sum(c).over(down) + F.col(f"{c}_above")).alias(c) for c in sums])
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * F.col("tp"), F.col("n") + at.agg(F.sum("pos")).scalar()), F.lit(0.0))
    x = x.withColumn("f1", f1)
    zero = x.agg(F.min_by("f1", "t").alias("f1")).where("f1 is not null").select(F.lit(0.0).alias("threshold"), "f1")
    return zero.unionByName(x.select(F.col("t").alias("threshold"), "f1")).orderBy(F.desc("f1"), "threshold").limit(1)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[list[float], list[float]]:
    """Breakpoints of the rising step function nearest to y in weighted squares; for equal x the last value counts."""
    weight = np.ones(len(x)) if weight is None else weight
    order = np.lexsort((y, x))
    blocks: list[list[float]] = []  # sum, weight, points
    for v, w in zip(y[order], weight[order], strict=True):
        blocks.append([float(v) * w, float(w), 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] > blocks[-1][0] * blocks[-2][1]:
            s, w, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + w, blocks[-1][2] + n]
    fit = np.repeat([s / w for s, w, _ in blocks], [n for *_, n in blocks])
    points = dict(zip(x[order].tolist(), fit.tolist(), strict=True))
    return list(points), list(points.values())


def platt(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, rounds: int = 3000, rate: float = 0.1) -> tuple[float, float]:
    """(a, b) of 1 / (1 + exp(-(a * logit + b))) by weighted gradient descent from (1, 0)."""
    weight = np.ones(len(x)) if weight is None else weight
    share = weight / weight.sum()
    q = np.clip(x, 1e-6, 1 - 1e-6)
    f = np.log(q / (1 - q))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        e = (1 / (1 + np.exp(-(a * f + b))) - y) * share
        a, b = a - rate * float(e @ f), b - rate * float(e.sum())
    return a, b


def fitted(rows: DataFrame, group: str, p: str, hit: str, method: str = "isotonic", max_points: int = 200_000) -> DataFrame:
    """(group, method, x, y, a, b): a calibrator per model; none for fewer than 20 rows or one class.

    Rows are first gathered by (p, hit) with counts, and the fits are of these weighted points; the fit is of labelled rows, and
    more than ``max_points`` distinct values of one model raise an error instead of being cut.
    """

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        cols = ["group", "method", "x", "y", "a", "b"]
        if len(pdf) > max_points:
            raise ValueError(f"{len(pdf)} distinct probabilities of one model, more than max_points")
        n = pdf["n"].to_numpy()
        if n.sum() < MIN_POINTS or pdf["hit"].nunique() < 2:
            return pd.DataFrame(columns=cols)
        x, y, n = pdf["p"].to_numpy(), pdf["hit"].to_numpy().astype(float), n.astype(float)
        if method == "platt":
            a, b = platt(x, y, n)
            return pd.DataFrame([(key[0], method, None, None, a, b)], columns=cols)
        bx, by = isotonic(x, y, n)
        return pd.DataFrame([(key[0], method, bx, by, math.nan, math.nan)], columns=cols)

    ship(rows.sparkSession)
    c = rows.groupBy(F.col(group).alias("group"), F.col(p).alias("p"), F.col(hit).cast("int").alias("hit")).agg(F.count("*").alias("n")).where("p is not null and hit is not null")
    return c.groupBy("group").applyInPandas(fit, "group string, method string, x array<double>, y array<double>, a double, b double")
