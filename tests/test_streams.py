import numpy as np

from suarakit.operators.near_duplicates import deduplicate_arrivals
from suarakit.streaming import ingest
from tests.test_vectors import SCHEMA, clustered, frame


def test_restart_takes_up_where_it_stopped(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "id string, v int"

    def deliver(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = ingest.stream_files(spark, source, spark.createDataFrame([], schema).schema)
        ingest.start_ingest(ingest.distinct_ids(stream), out, state).awaitTermination()
        return sorted(map(tuple, spark.read.parquet(out).collect()), key=str)

    assert deliver([("a", 1), (None, 2), ("a", 1)]) == [("a", 1), (None, 2)]
    assert deliver([("a", 9), (None, 9), ("b", 3)]) == [("a", 1), ("b", 3), (None, 2)]
    assert deliver([("b", 9)]) == [("a", 1), ("b", 3), (None, 2)]


def test_first_records_by_order(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "id string, seq int"

    def deliver(rows):
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(source)
        stream = ingest.stream_files(spark, source, spark.createDataFrame([], schema).schema)
        ingest.start_first_records(stream, out, state, "seq").awaitTermination()
        return sorted(map(tuple, spark.read.parquet(out).select("id", "seq").collect()), key=str)

    many = [("a", i) for i in range(300, 2, -1)] + [(None, i) for i in range(90, 40, -1)]
    assert deliver(many) == [("a", 3), (None, 41)]
    assert deliver([("a", 1), ("b", 7), ("b", 6), (None, 0)]) == [("a", 3), ("b", 6), (None, 41)]


def test_bounded_state_variant_runs(spark, tmp_path):
    source = str(tmp_path / "in")
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS ts, x AS id FROM VALUES ('a'), ('a'), ('b') t(x)")
    df.write.parquet(source)
    stream = ingest.stream_files(spark, source, df.schema)
    kept = ingest.distinct_ids(stream, "id", event_time="ts", horizon="1 hour")
    ingest.start_ingest(kept, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_batches_of_arrivals_equal_one_pass(spark, tmp_path):
    m = clustered(150).astype(np.float32)
    rows = list(enumerate(m))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for lo in (0, 50, 100):
        frame(spark, rows[lo : lo + 50]).coalesce(1).write.mode("append").parquet(source)
    stream = ingest.stream_files(spark, source, spark.createDataFrame([], SCHEMA).schema, 1)
    ingest.start_near_duplicate_intake(stream, out, str(tmp_path / "state"), threshold=0.6).awaitTermination()
    verdicts = spark.read.parquet(f"{out}/verdicts")
    assert verdicts.select("batch").distinct().count() == 3
    expected = sorted(map(tuple, deduplicate_arrivals(frame(spark, rows), threshold=0.6).collect()))
    assert sorted(map(tuple, verdicts.drop("batch").collect())) == expected
    # Running a batch again leaves everything as it was.
    sink = ingest.near_duplicate_sink(out, threshold=0.6)
    sink(frame(spark, rows[50:100]), 1)
    again = spark.read.parquet(f"{out}/verdicts").drop("batch").collect()
    assert sorted(map(tuple, again)) == expected
