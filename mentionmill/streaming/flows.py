"""The pipeline's steps as streams: new documents become triples, events become windowed counts, repeats drop out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mentionmill.operators import relations as R


def sentence_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1000) -> DataFrame:
    """Sentence tables that arrive in a folder as Parquet files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def triples_flow(sentences: DataFrame, out: str, checkpoint: str, continuous: bool = False) -> StreamingQuery:
    """Rule triples of arriving sentences, appended once each; by default until what is there is done, then it ends."""
    w = R.adjacent_triples(sentences).writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint)
    return (w if continuous else w.trigger(availableNow=True)).start()


def windowed_counts(events: DataFrame, at: str, by: list[str], window: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """(window_start, window_end, by, n) over event time; rows later than the watermark drop out."""
    x = events.withWatermark(at, late).groupBy(F.window(at, window, slide), *by).agg(F.count("*").alias("n"))
    return x.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "n")


def sessions(events: DataFrame, at: str, key: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """(key, session_start, session_end, n): runs of a key's events with no gap as long as ``gap``."""
    x = events.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("s"), key).agg(F.count("*").alias("n"))
    return x.select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def first_seen(events: DataFrame, at: str, key: list[str], late: str = "1 day") -> DataFrame:
    """Each key once within the watermark; state older than it is let go."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(key)
