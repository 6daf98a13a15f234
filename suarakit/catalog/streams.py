"""Queries run as streams over the fixture files."""

from __future__ import annotations

from pyspark.sql import functions as F

from suarakit.catalog.duplicates import _GREEDY, THRESHOLD
from suarakit.catalog.tables import table
from suarakit.session import prepare, scratch_path
from suarakit.streaming import first_records, ingest

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


@query("""SELECT user_id || '-' || event_type AS id, event_id, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1""")
def distinct_ids_stream(spark, sf):
    """Events replayed as a stream, the first record of each id kept; arrival runs against the event ids."""
    prepare(spark)
    schema = table(spark, sf, "events").schema
    events = ingest.stream_files(spark, f"{sf}/events*.parquet", schema)
    ids = events.select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("id"),
        "event_id",
        "props",
        (-F.col("event_id")).alias("arrival"),
    )
    out = scratch_path(spark, "ingest")
    ingest.start_first_records(ids, f"{out}/table", f"{out}/checkpoint", "arrival").awaitTermination()
    return spark.read.parquet(f"{out}/table").select("id", "event_id", "props")


@query("""WITH e AS (SELECT *, CASE WHEN user_id % 40 <> 7 THEN event_type || '-' || user_id % 40 END AS id FROM events)
SELECT id, event_id, props FROM e QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_id DESC) = 1""")
def first_records_by_state(spark, sf):
    """Events replayed in three batches; state alone knows what came before, and later batches correct earlier ones."""
    prepare(spark)
    events = table(spark, sf, "events").select(
        F.expr("CASE WHEN user_id % 40 <> 7 THEN concat_ws('-', event_type, user_id % 40) END").alias("id"),
        "event_id", "props", (-F.col("event_id")).alias("arrival"),
    )
    source, out = scratch_path(spark, "events"), scratch_path(spark, "ingest")
    for i in range(3):
        events.filter(F.col("event_id") % 3 == i).write.mode("append").parquet(source)
    stream = ingest.stream_files(spark, source, events.schema, 1)
    first_records.start(stream, f"{out}/table", f"{out}/checkpoint", "arrival").awaitTermination()
    return first_records.stored(spark, f"{out}/table", events.schema, "arrival").select("id", "event_id", "props")


@query(_GREEDY)
def near_duplicate_stream(spark, sf):
    """Vectors replayed as a stream of several batches in arrival order."""
    e = table(spark, sf, "embeddings")
    source, out = scratch_path(spark, "arrivals"), scratch_path(spark, "intake")
    # Three writes one after the other, each a third of the ids in order, in as many files as it has parts.
    low, high = e.agg(F.percentile_approx("vec_id", [1 / 3, 2 / 3])).first()[0]
    third = F.when(F.col("vec_id") <= low, 0).when(F.col("vec_id") <= high, 1).otherwise(2)
    parts = max(1, spark.sparkContext.defaultParallelism // 4)
    for i in range(3):
        e.filter(third == i).repartition(parts).write.mode("append").parquet(source)
    stream = ingest.stream_files(spark, source, e.schema, files_per_trigger=parts)
    ingest.start_near_duplicate_intake(
        stream, out, f"{out}/checkpoint", threshold=THRESHOLD
    ).awaitTermination()
    return spark.read.parquet(f"{out}/verdicts").drop("batch")
