"""Mixing sources to target weights of the total size in tokens.

Every source gets a share of the total. Its records start from rates by number of records (its share of the mix divided by its
share of the records), and entropy balancing tilts them exponentially, w = q * exp(lambda * tokens / mean), until the expected
tokens meet the target; the cap on repeats bounds w. One Newton iteration for all sources is one aggregation over the
(source, tokens) histogram of the whole corpus; only one number per source comes back. Rates are rounded to copies by systematic
rounding along (tokens, hash) within each source: the running total of copies stays within one of the running total of rates, so
counts are off by less than one copy and tokens by less than the longest text of the source. Of ``PHASES`` starting points of the
rounding, each source takes the one whose tokens come closest to its goal.

The running totals of rates are prefix sums in three levels (blocks of lengths, lengths, buckets of a length), so no window holds
more than the blocks of one source, the lengths of one block or about ``CELL`` records, however large a source is.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from mentionmill.session import ship
from mentionmill.staging import staged

#: Place of the tokenizer file; a public byte-level vocabulary by default.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ROUNDS, CLOSE = 60, 1e-6
#: Records of one length and source in one bucket, about; lengths in one block of the prefix sums.
CELL, LENGTHS = 50_000, 1024
#: Starting points of the rounding.
PHASES = 16
#: Sources of a mix that are sent to every task; more are joined by a shuffle.
SENT = 100_000

_encodings: dict[str, object] = {}


def _encoding(path: str):
    if path not in _encodings:
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _encodings[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def with_tokens(docs: DataFrame, text: str, name: str = "n_tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """``docs`` with the number of tokens of a text; null counts as 0. The tokenizer's file is sent to the executors."""
    docs.sparkSession.sparkContext.addFile(tokenizer)
    file = os.path.basename(tokenizer)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoding(SparkFiles.get(file))
        for s in batches:
            yield pd.Series([len(enc.encode_ordinary(t)) if t else 0 for t in s], dtype="int64")

    ship(docs.sparkSession)
    return docs.withColumn(name, F.pandas_udf(run, LongType()).asNondeterministic()(F.col(text)))  # no filter is pushed below it


def source_name(c: Column) -> Column:
    """A source without stray case and blanks."""
    return F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))


def _small(t: DataFrame, sources: int) -> DataFrame:
    """A table of one row per source, sent to every task if that is known to be small."""
    return F.broadcast(t) if sources <= SENT else t


_RATE = "least(cap, base * exp(least(lam * n_tokens / mean, 700d)))"


class Plan:
    """Rates of the sources of a mix: one row per source on the driver, ``lam``, ``base``, ``mean``, ``cap`` and ``goal``."""

    def __init__(self, hist: DataFrame, targets: list):
        sums = hist.groupBy("source").agg(F.sum("m").alias("texts"), F.sum(F.col("m") * F.col("n_tokens")).alias("tokens"))
        got = {r.source: r for r in sums.collect()}
        have = [t for t in targets if t.source in got and t.target_share > 0 and t.max_repeats > 0]
        self.hist = hist
        self.sources = [t.source for t in have]
        self.texts, self.tokens = {s: got[s].texts for s in self.sources}, {s: got[s].tokens for s in self.sources}
        share = sum(t.target_share for t in have)
        total = min((t.max_repeats * self.tokens[t.source] / (t.target_share / share) for t in have), default=0.0)
        self.goal = {t.source: t.target_share / share * total for t in have}
        self.cap = {t.source: float(t.max_repeats) for t in have}
        self.mean = {s: self.tokens[s] / self.texts[s] for s in self.sources}
        whole = sum(self.tokens.values()) / max(1, sum(self.texts.values()))
        self.base = {s: min(self.cap[s], self.goal[s] / whole / self.texts[s]) for s in self.sources}
        self.lam = dict.fromkeys(self.sources, 0.0)
        left = []
        for s in self.sources:
            if self.goal[s] >= self.cap[s] * self.tokens[s] * (1 - 1e-9):
                self.base[s] = self.cap[s]  # a source that bounds the mix: every text as often as allowed
            else:
                left.append(s)
        self._solve(left)

    def rates(self, sources: list[str] | None = None) -> DataFrame:
        """(source, lam, base, mean, cap) of the given sources or all."""
        rows = [(s, self.lam[s], self.base[s], self.mean[s], self.cap[s]) for s in (self.sources if sources is None else sources)]
        t = self.hist.sparkSession.createDataFrame(rows, "source string, lam double, base double, mean double, cap double")
        return _small(t, len(rows))

    def _solve(self, left: list[str]) -> None:
        """Newton iterations on the dual, kept between the bounds known so far; sources that do not meet their goal are an error."""
        low, high = dict.fromkeys(left, -math.inf), dict.fromkeys(left, math.inf)
        for _ in range(ROUNDS):
            if not left:
                return
            x = self.hist.join(self.rates(left), "source").withColumn("w", F.expr(_RATE))
            slope = F.when(F.col("w") < F.col("cap"), F.col("m") * F.col("w") * F.col("n_tokens") * F.col("n_tokens")).otherwise(0.0)
            got = x.groupBy("source").agg(F.sum(F.col("m") * F.col("w") * F.col("n_tokens")).alias("f"), F.sum(slope).alias("d")).collect()
            left = []
            for s, f, d in got:
                gap = f - self.goal[s]
                if abs(gap) <= CLOSE * self.goal[s]:
                    continue
                left.append(s)
                if gap < 0:
                    low[s] = self.lam[s]
                else:
                    high[s] = self.lam[s]
                step = self.lam[s] - gap / (d / self.mean[s]) if d > 0 else math.nan
                if not low[s] < step < high[s]:
                    if math.isinf(low[s]) or math.isinf(high[s]):
                        step = self.lam[s] + (1.0 if gap < 0 else -1.0) * max(1.0, abs(self.lam[s]))
                    else:
                        step = (low[s] + high[s]) / 2
                self.lam[s] = step
        if left:
            raise RuntimeError(f"{len(left)} sources are not within {CLOSE} of their tokens after {ROUNDS} rounds, such as {sorted(left)[0]!r}")


def _laid(cells: DataFrame, plan: Plan) -> DataFrame:
    """Per (source, n_tokens, b): the rate ``w`` and ``start``, the rates of all that comes before, by prefix sums in three levels."""
    x = cells.join(plan.rates(), "source").withColumn("w", F.expr(_RATE)).withColumn("block", F.floor(F.col("n_tokens") / LENGTHS))
    x = x.select("source", "block", "n_tokens", "b", "w", (F.col("m") * F.col("w")).alias("mass"))
    before = lambda by, order: F.coalesce(F.sum("mass").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    lengths = x.groupBy("source", "block", "n_tokens").agg(F.sum("mass").alias("mass"))
    blocks = lengths.groupBy("source", "block").agg(F.sum("mass").alias("mass"))
    blocks = blocks.select("source", "block", before(["source"], "block").alias("s1"))
    lengths = lengths.withColumn("s2", before(["source", "block"], "n_tokens")).join(blocks, ["source", "block"])
    lengths = lengths.select("source", "n_tokens", (F.col("s1") + F.col("s2")).alias("s12"))
    x = x.withColumn("s3", before(["source", "n_tokens"], "b")).join(lengths, ["source", "n_tokens"])
    return x.select("source", "n_tokens", "b", "w", (F.col("s12") + F.col("s3")).alias("start"))


def _copies(phase: Column) -> Column:
    """Copies of the i-th text of a cell: how far the running total of rates, from the phase on, moves past whole numbers."""
    mark = lambda i: F.floor(F.col("start") + F.col("w") * i + phase + F.lit(1e-9))
    return (mark(F.col("i")) - mark(F.col("i") - 1)).cast("int")


def mixture(docs: DataFrame, doc: str, text: str, source: str, targets: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc, source, n_tokens, copies): every document that takes part and how often it is used.

    ``targets`` has source, target_share and max_repeats. Names of sources compare without case and blanks at the ends. Texts of
    sources that are not listed, or null, take no part. Equal texts of one source are one text: the smallest id stands for them,
    and its copies stay within max_repeats. Listed sources without texts cannot be reached; the other shares grow in proportion.
    The total is the largest at which every source can reach its share. Empty and null texts have no tokens and take no part.
    The driver holds one row per source of ``targets``, however many there are.
    """
    want = targets.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats").where("source is not null")
    rows = want.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats")).collect()
    spark = docs.sparkSession
    listed = _small(spark.createDataFrame([(r.source,) for r in rows], "source string"), len(rows))
    key = F.xxhash64(text)
    x = docs.select(F.col(doc).alias("doc"), source_name(F.col(source)).alias("source"), F.col(text).alias("text"), F.unhex(F.md5(text)).alias("digest"), key.alias("h"))
    x = x.where(F.length("text") > 0).join(listed, "source", "left_semi")
    x = with_tokens(x, "text", tokenizer=tokenizer).drop("text")
    units = staged(x.groupBy("source", "digest").agg(F.min("doc").alias("doc"), F.min("n_tokens").alias("n_tokens"), F.min("h").alias("h")), "units").where("n_tokens > 0")
    hist = staged(units.groupBy("source", "n_tokens").agg(F.count("*").alias("m")), "lengths")
    plan = Plan(hist, rows)
    most = hist.agg(F.max("m")).first()[0] or 0
    buckets = 1 << max(0, math.ceil(most / CELL) - 1).bit_length()
    units = units.join(_small(spark.createDataFrame([(s,) for s in plan.sources], "source string"), len(rows)), "source", "left_semi")
    units = units.withColumn("b", F.pmod("h", F.lit(buckets)).cast("int"))
    cells = hist.withColumn("b", F.lit(0)) if buckets == 1 else units.groupBy("source", "n_tokens", "b").agg(F.count("*").alias("m"))
    at = F.row_number().over(Window.partitionBy("source", "n_tokens", "b").orderBy("h", "doc"))
    y = units.withColumn("i", at).join(_laid(cells, plan).hint("merge"), ["source", "n_tokens", "b"])  # the window's partitioning serves the join
    y = staged(y.select("doc", "source", "n_tokens", "w", "start", "i"), "laid")
    each = [F.sum(_copies(F.lit(k / PHASES)) * F.col("n_tokens")).alias(f"p{k}") for k in range(PHASES)]
    phase = [(r[0], min(range(PHASES), key=lambda k: abs(r[k + 1] - plan.goal[r[0]])) / PHASES) for r in y.groupBy("source").agg(*each).collect()]
    y = y.join(_small(spark.createDataFrame(phase, "source string, phase double"), len(rows)), "source")
    y = y.withColumn("copies", _copies(F.col("phase")))
    return y.where("copies > 0").select(F.col("doc").alias(doc), "source", "n_tokens", "copies")


def reached(mix: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, reached_share, tokens, texts, most): the shares really reached; sources without texts have 0."""
    got = mix.groupBy("source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"), F.count("*").alias("texts"), F.max("copies").alias("most"))
    t = targets.select(source_name(F.col("source")).alias("source"), "target_share").join(got, "source", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    t = t.select("source", "target_share", zero("tokens"), zero("texts"), zero("most"))
    all_tokens = mix.agg(F.sum(F.col("copies") * F.col("n_tokens"))).scalar()
    return t.withColumn("reached_share", F.coalesce(F.try_divide("tokens", all_tokens), F.lit(0.0)))
