"""The first record of every id, kept by state: no batch reads what earlier ones stored.

State holds for each id the smallest order seen, nothing else. A record that beats it is passed on,
so a record that comes late but belongs first corrects what was stored; repeats pass nothing on.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_KEY, _NULL = "_key", "_null"


class _Smallest(StatefulProcessor):
    """Passes on the row of smallest order of a key whenever it is smaller than all before.

    With a ``horizon`` in milliseconds a timer forgets an id that long after its last record by
    event time; with ``ttl`` state goes that long after it was written.
    """

    def __init__(self, columns: list[str], order: T.StructField, time: str | None, horizon: int | None, ttl: int | None):
        self.columns, self.order, self.time, self.horizon, self.ttl = columns, order, time, horizon, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        schema = T.StructType([T.StructField("least", self.order.dataType)])
        self.least = handle.getValueState("least", schema, self.ttl)
        if self.horizon:
            self.timer = handle.getValueState("timer", T.StructType([T.StructField("at", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best, latest, order = None, None, self.order.name
        for pdf in rows:
            if self.horizon:
                seen = int(pdf[self.time].max().timestamp() * 1000)
                latest = seen if latest is None else max(latest, seen)
            first = pdf.sort_values(order, kind="stable").head(1)
            if best is None or first[order].iloc[0] < best[order].iloc[0]:
                best = first
        if self.horizon and latest is not None:
            old = self.timer.get() if self.timer.exists() else None
            at = latest + self.horizon
            if old is None or old[0] < at:
                if old is not None:
                    self.handle.deleteTimer(old[0])
                self.handle.registerTimer(at)
                self.timer.update((at,))
        least = self.least.get()[0] if self.least.exists() else None
        value = best[order].iloc[0]
        value = value.item() if hasattr(value, "item") else value
        if least is None or value < least:
            self.least.update((value,))
            yield best[self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.least.clear()
        self.timer.clear()
        yield pd.DataFrame(columns=self.columns)

    def close(self) -> None:
        pass


def first_records(
    stream: DataFrame,
    order_col: str,
    id_col: str = "id",
    event_time: str | None = None,
    horizon_ms: int | None = None,
    lateness: str = "1 hour",
    ttl_ms: int | None = None,
) -> DataFrame:
    """The stream of records that are the first of their id so far, by ``order_col`` (a number, text or time without NULLs).

    A missing id counts as one id. Without ``horizon_ms`` (with ``event_time``; later than
    ``lateness`` is dropped) or ``ttl_ms`` every id stays in state for good, as full
    de-duplication requires; state is on disk and has one number for each id.
    """
    if horizon_ms and not event_time:
        raise ValueError("a horizon needs an event time")
    keyed = stream.withColumns({_KEY: F.coalesce(F.col(id_col).cast("string"), F.lit("")), _NULL: F.col(id_col).isNull()})
    mode = "ProcessingTime" if ttl_ms else "None"
    if horizon_ms:
        keyed = keyed.withWatermark(event_time, lateness)
        mode = "EventTime"
    return keyed.groupBy(_KEY, _NULL).transformWithStateInPandas(
        statefulProcessor=_Smallest(stream.columns, stream.schema[order_col], event_time, horizon_ms, ttl_ms),
        outputStructType=stream.schema,
        outputMode="Update",
        timeMode=mode,
    )


def start(stream: DataFrame, out: str, checkpoint: str, order_col: str, id_col: str = "id", **options) -> StreamingQuery:
    """Store what :func:`first_records` passes on until the input is used up; restart to resume.

    One folder per batch, which a batch that runs again replaces. :func:`stored` reads the result.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    found = first_records(stream, order_col, id_col, **options)
    return (
        found.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored(spark: SparkSession, out: str, schema: T.StructType, order_col: str, id_col: str = "id") -> DataFrame:
    """The first record of every id: corrections win over what they correct."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(out)
    best = rows.groupBy(id_col).agg(F.min_by(F.struct(*schema.fieldNames()), F.struct(order_col, "batch")).alias("_best"))
    return best.select("_best.*")
