"""Numeric functions of relation scoring and calibration as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the scoring rule.
CUE_ABSENT, SELF_PAIR, MIN_SCORE = 0.85, 0.5, 0.5
REFLEXIVE = ("interacts", "binds", "phosphorylates", "dimerizes", "oligomerizes")


def round4(c: Column) -> Column:
    """To four places, halves away from zero, on the binary value."""
    return F.round(c * 10000.0) / 10000.0


def section_factor(section: Column) -> Column:
    s = F.lower(F.coalesce(section, F.lit("")))
    return F.when(s.contains("result") | s.contains("abstract") | s.contains("figure"), 1.0).when(s.contains("discussion"), 0.97).when(s.contains("intro"), 0.90).otherwise(0.95)


def margin_factor(margin: Column) -> Column:
    m = F.coalesce(margin, F.lit(0.0))
    return F.lit(1.0) + F.greatest(F.lit(0.0), F.least(F.lit(0.1), (m - 0.01) / 0.05))


def evidence(score: Column) -> Column:
    """A mention's score, where none or zero counts as certain."""
    return F.coalesce(F.nullif(score, F.lit(0.0)), F.lit(1.0))


def composite(p: Column, subject: Column, obj: Column, relational: Column, margin: Column, section: Column, self_pair: Column, label: Column) -> Column:
    """The product of relation probability, weaker mention, cue, margin, section and self-pair factors, at most 1, to four places."""
    cue = F.when(relational, 1.0).otherwise(CUE_ABSENT)
    own = F.when(self_pair & ~F.lower(label).isin(*REFLEXIVE), SELF_PAIR).otherwise(1.0)
    return round4(F.least(F.lit(1.0), p * F.least(evidence(subject), evidence(obj)) * cue * margin_factor(margin) * section_factor(section) * own))


def repenalized(score: Column, old: Column, newly_self: Column, label: Column) -> Column:
    """A score whose pair turned out to be one gene after normalization: the old self-pair factor out, the penalty in."""
    return F.when(newly_self & ~F.lower(label).isin(*REFLEXIVE), round4(score / old * SELF_PAIR)).otherwise(score)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def logit(p: Column, eps: float = 1e-6) -> Column:
    q = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), p))
    return F.ln(q / (F.lit(1.0) - q))


def platt(p: Column, a: float, b: float) -> Column:
    return sigmoid(F.lit(a) * logit(p) + F.lit(b))


def interpolated(p: Column, x: Sequence[float], y: Sequence[float]) -> Column:
    """Piecewise linear through (x, y), x rising; constant beyond the ends."""
    xs, ys = F.array(*[F.lit(float(v)) for v in x]), F.array(*[F.lit(float(v)) for v in y])
    i = F.size(F.filter(xs, lambda v: v <= p))
    at = lambda a, k: F.element_at(a, F.greatest(F.lit(1), F.least(F.lit(len(x)), k)))
    x0, x1, y0, y1 = at(xs, i), at(xs, i + 1), at(ys, i), at(ys, i + 1)
    inner = F.when(x1 > x0, y0 + (y1 - y0) * (p - x0) / (x1 - x0)).otherwise(y0)
    return F.when(i == 0, F.lit(float(y[0]))).when(i >= len(x), F.lit(float(y[-1]))).otherwise(inner)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def centroid(rows: DataFrame, vector: str) -> Column:
    """The mean vector as a literal: one number per dimension comes back, whatever the number of rows."""
    mean = rows.select(F.posexplode(vector).alias("i", "v")).groupBy("i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    return F.array(*[F.lit(r.m) for r in sorted(mean.collect(), key=lambda r: r.i)])


def unit(a: Column) -> Column:
    """A vector at length 1; the zero vector stays."""
    n = F.sqrt(dot(a, a))
    return F.transform(a, lambda v: F.when(n > 0, v.cast("double") / n).otherwise(v.cast("double")))


def top_two(probabilities: Column) -> Column:
    """(place, p) of the two largest of an array; equal values in order of place."""
    placed = F.transform(probabilities, lambda p, i: F.struct((-p).alias("m"), i.alias("place")))
    return F.transform(F.slice(F.array_sort(placed), 1, 2), lambda s: F.struct(s["place"].alias("place"), (-s["m"]).alias("p")))


def decile(score: Column) -> Column:
    """The lower end of a score's tenth in per cent; 1.0 has its own."""
    return (F.floor(score * 10) * 10).cast("int")
