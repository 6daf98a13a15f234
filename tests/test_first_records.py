"""First records by state equal the batch answer, whatever comes late, twice, without an id, or after a restart."""

import random

from pyspark.sql import functions as F

from suarakit.operators.quality import keep_first
from suarakit.streaming import first_records, ingest

SCHEMA = "id string, seq long, body string, at timestamp"


def rows_of(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        id_ = rng.choice([None, "", "a", "b", "c", "d", f"x{rng.randrange(30)}"])
        out.append((id_, rng.randrange(10_000) * 1000 + i, f"body {i}"))
    return out


def test_equals_the_batch_answer(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = spark.createDataFrame([], SCHEMA).schema
    given = []
    for turn in range(3):  # the query ends and starts again each time
        part = rows_of(120, turn) + given[:5]  # repeated records
        given += part
        df = spark.createDataFrame(part, "id string, seq long, body string").withColumn("at", F.lit("2024-01-01").cast("timestamp"))
        df.repartition(3).write.mode("append").parquet(source)
        first_records.start(ingest.stream_files(spark, source, schema, 2), out, state, "seq").awaitTermination()
        found = first_records.stored(spark, out, schema, "seq")
        every = spark.createDataFrame(given, "id string, seq long, body string")
        wanted = keep_first(every, ["id"], "seq")
        got = sorted((r.id is None, r.id or "", r.seq, r.body) for r in found.collect())
        assert got == sorted((r.id is None, r.id or "", r.seq, r.body) for r in wanted.collect())


def test_only_first_records_pass(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def deliver(rows):
        df = spark.createDataFrame(rows, "id string, seq long, body string").withColumn("at", F.lit("2024-01-01").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(source)
        first_records.start(ingest.stream_files(spark, source, schema), out, state, "seq").awaitTermination()
        return [r.body for r in spark.read.parquet(out).orderBy("batch", "body").collect()]

    assert deliver([("a", 5, "a5"), ("a", 7, "a7"), ("b", 1, "b1")]) == ["a5", "b1"]
    assert deliver([("a", 6, "a6"), ("b", 1, "again")]) == ["a5", "b1"]
    assert deliver([("a", 2, "a2"), (None, 9, "none")]) == ["a5", "b1", "a2", "none"]


def test_ids_are_forgotten_after_the_horizon(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def deliver(rows):
        df = spark.createDataFrame(rows, "id string, seq long, body string, at string").withColumn("at", F.col("at").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(source)
        options = dict(event_time="at", horizon_ms=3_600_000, lateness="10 minutes")
        first_records.start(ingest.stream_files(spark, source, schema), out, state, "seq", **options).awaitTermination()
        return [r.body for r in spark.read.parquet(out).orderBy("batch", "body").collect()]

    assert deliver([("a", 1, "a1", "2024-01-01 00:00:00"), ("b", 1, "b1", "2024-01-01 00:30:00")]) == ["a1", "b1"]
    # The watermark passes a's last record by more than the horizon, but not yet b's.
    assert deliver([("c", 1, "c1", "2024-01-01 01:20:00")]) == ["a1", "b1", "c1"]
    assert deliver([("a", 9, "a9", "2024-01-01 01:30:00"), ("b", 9, "b9", "2024-01-01 01:30:00")]) == ["a1", "b1", "c1", "a9"]
