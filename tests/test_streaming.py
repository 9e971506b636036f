from pyspark.sql import functions as F

from mentionmill.operators import relations as R
from mentionmill.streaming import flows


def test_triples_of_a_stream_equal_the_batch(spark, sf, tmp_path):
    src = str(tmp_path / "in")
    s = spark.read.parquet(f"{sf}/sentences.parquet")
    s.repartition(3).write.parquet(src)
    for _ in range(2):  # the second run finds nothing new
        flows.triples_flow(flows.sentence_stream(spark, src, s.schema), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = R.adjacent_triples(s)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_windows_sessions_and_repeats(spark, sf, tmp_path):
    src = str(tmp_path / "in")
    e = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    e.coalesce(1).write.parquet(src)
    stream = lambda: spark.readStream.schema(e.schema).parquet(src)

    def run(df, name, mode="append"):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name)

    assert run(flows.windowed_counts(stream(), "ts", ["event_type"]), "w", "complete").agg(F.sum("n")).first()[0] == e.count()
    assert run(flows.first_seen(stream(), "ts", ["user_id"]), "f").count() == e.select("user_id").distinct().count()
    batch = flows.sessions(e, "ts", "user_id", "6 hours")
    assert batch.agg(F.sum("n")).first()[0] == e.count()
