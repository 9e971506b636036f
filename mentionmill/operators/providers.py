"""What stands in for models: a provider turns rows into mentions, vectors or verdicts.

The default reads stored results; any function of a pandas batch can take its place and runs once per task with what it loads.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionmill.functions import scores
from mentionmill.session import ship


class Provider(Protocol):
    def apply(self, rows: DataFrame) -> DataFrame: ...


class Stored:
    """Results from a table, joined on key columns; rows without a result keep nulls."""

    def __init__(self, table: DataFrame, key: list[str]):
        self.table, self.key = table, key

    def apply(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.table, self.key, "left")


class Batched:
    """A model as a function of a batch. ``load`` runs once per task, ``score(model, batch)`` returns one value per row."""

    def __init__(self, load: Callable[[], object], score: Callable[[object, pd.DataFrame], list], column: str, kind: str, inputs: list[str]):
        self.load, self.score, self.column, self.kind, self.inputs = load, score, column, kind, inputs

    def apply(self, rows: DataFrame) -> DataFrame:
        ship(rows.sparkSession)
        load, score, inputs, column = self.load, self.score, self.inputs, self.column

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = load()
            for b in batches:
                b[column] = score(model, b[inputs])
                yield b

        schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + f", `{self.column}` {self.kind}"
        return rows.mapInPandas(run, schema)


def by_model(rows: DataFrame, providers: dict[str, Provider], model: str = "model") -> DataFrame:
    """Each model's rows through its own provider, so a task loads one model; rows of other models drop out."""
    out = None
    for name in sorted(providers):
        x = providers[name].apply(rows.where(F.col(model) == name))
        out = x if out is None else out.unionByName(x)
    return out if out is not None else rows.limit(0)


def softmax(logits: Column) -> Column:
    """Probabilities of an array of logits, shifted by the largest so that nothing overflows."""
    top = F.array_max(logits)
    e = F.transform(logits, lambda v: F.exp(v - top))
    total = F.aggregate(e, F.lit(0.0), lambda s, v: s + v)
    return F.transform(e, lambda v: v / total)


def pooled(tokens: Column, mask: Column) -> Column:
    """The mean of the token vectors whose mask is set, at length 1; no token gives null."""
    kept = F.transform(F.filter(F.arrays_zip(tokens.alias("v"), mask.alias("m")), lambda z: z["m"] == 1), lambda z: z["v"])
    total = F.aggregate(F.slice(kept, 2, F.greatest(F.size(kept) - 1, F.lit(0))), F.transform(F.get(kept, F.lit(0)), lambda v: v.cast("double")), lambda s, t: F.zip_with(s, t, lambda a, b: a + b.cast("double")))
    return F.when(F.size(kept) > 0, scores.unit(F.transform(total, lambda v: v / F.size(kept))))


def margin(vector: Column, positive: Column, negative: Column) -> Column:
    """Cosine to the positive centroid less that to the negative one."""
    return scores.cosine(vector, positive) - scores.cosine(vector, negative)
