"""Resumable intake streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from suarakit import constants as K
from suarakit.operators.ingest import new_records
from suarakit.operators.near_duplicates import split_arrivals
from suarakit.session import materialise, prepare
from suarakit.sources import vector_table


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files as a stream, oldest first."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def distinct_ids(
    stream: DataFrame, id_col: str = "id", event_time: str | None = None, horizon: str | None = None
) -> DataFrame:
    """One record per id: of an earlier micro-batch first, within one whichever comes.

    Without a horizon every id ever seen stays in state, as full de-duplication requires.
    With ``event_time`` and ``horizon`` state is bounded and only repeats within the horizon
    are dropped. Where the first record by some order must stay, use :func:`first_records_sink`.
    """
    if event_time and horizon:
        return stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark([id_col])
    return stream.dropDuplicates([id_col])


def first_records_sink(out: str, order_col: str, id_col: str = "id") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that stores the first record of every new id, in ``order_col`` order.

    One folder per batch below ``out``. A batch is compared with earlier folders only and
    replaces its own, so running it again changes nothing. A missing id counts as one id.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        schema = T.StructType([*batch.schema.fields, T.StructField("batch", T.LongType())])
        if batch_id > 0:
            stored = batch.sparkSession.read.schema(schema).parquet(out).filter(F.col("batch") < batch_id)
        else:
            stored = batch.sparkSession.createDataFrame([], schema)
        fresh = new_records(batch, stored, order_col, id_col)
        fresh.select(*batch.columns).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return process


def start_first_records(
    stream: DataFrame, out: str, checkpoint: str, order_col: str, id_col: str = "id"
) -> StreamingQuery:
    """Store first records until the input is used up; restart to resume."""
    return (
        stream.writeStream.foreachBatch(first_records_sink(out, order_col, id_col))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_ingest(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet table and stop when the input is used up; restart to resume."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def near_duplicate_sink(
    out: str,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    order_col: str = "vec_id",
    threshold: float = K.DUPLICATE_THRESHOLD,
    keep_cols: tuple[str, ...] = (),
    compact_every: int | None = 16,
    **search,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that checks each batch and stores what is new.

    ``out/store`` is a vector table by cell: a batch reads the cells that can matter to it, of
    earlier batches only, and the ids of the rest. ``out/verdicts`` has one folder per batch. A batch
    replaces its own part of both, so one that runs again after a failure gives the same result.
    Every ``compact_every`` batches the table is written anew, up to the batch before.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = prepare(batch.sparkSession)
        # A micro-batch is read several times: for its cells, its search and its rounds.
        batch = materialise(batch)
        if compact_every and batch_id and batch_id % compact_every == 0:
            vector_table.compact(spark, f"{out}/store", batch_id - 1, vec_col)
        store = vector_table.probe(batch, f"{out}/store", vec_col, before=batch_id)
        ids = None if store is None else vector_table.read(spark, f"{out}/store", before=batch_id)
        verdicts, kept = split_arrivals(
            batch, store, id_col, vec_col, order_col, threshold, keep_cols, stored_ids=ids, **search
        )
        verdicts.write.mode("overwrite").parquet(f"{out}/verdicts/batch={batch_id}")
        vector_table.append(materialise(kept), f"{out}/store", batch_id, vec_col)

    return process


def start_near_duplicate_intake(
    stream: DataFrame, out: str, checkpoint: str, **options
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(near_duplicate_sink(out, **options))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
