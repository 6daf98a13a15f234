"""CSV with line breaks inside fields, read by many tasks a file.

A line break ends a record only outside quotes, which depends on all quotes before it. Each split of
a file counts its quotes and, for both answers to "does it start inside a field?", its record
starts; a prefix sum over the splits, a few numbers each, settles the answers. A second pass puts
lines together to records inside the splits, and only the pieces of records that cross from one split
into the next are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suarakit.schemas import RAW_COMPLAINT

_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the split they are in, in order within it."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """The parts of a batch that belong to one split each."""
    blocks, files = batch.column(1).to_numpy(), batch.column(0)
    codes = files.dictionary_encode().indices.to_numpy()
    edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(codes) != 0)) + 1
    for low, high in zip(np.append(0, edges), np.append(edges, len(blocks))):
        if high > low:
            yield files[int(low)].as_py(), int(blocks[low]), batch.column(2).slice(low, high - low)


def _parity(values: pa.Array, before: int) -> np.ndarray:
    """For each line, whether it starts inside quotes (and one more, for what follows)."""
    quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
    return (np.concatenate([[0], np.cumsum(quotes)]) + before) % 2


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split: parity of its quotes, record starts if it begins outside or inside quotes, and
    whether its first line ends in a carriage return."""
    held: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        for file, block, values in _runs(batch):
            now = held.setdefault((file, block), [0, 0, 0, int(values[0].as_py().endswith("\r"))])
            inside = _parity(values, now[0])
            now[1] += int((inside[:-1] == 0).sum())
            now[2] += int((inside[:-1] == 1).sum())
            now[0] = int(inside[-1])
    keys = list(held)
    columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64())]
    columns += [pa.array([held[k][j] for k in keys], pa.int64()) for j in range(4)]
    yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "parity", "outside", "inside", "cr"])


def _offsets(lines: DataFrame) -> dict[tuple[str, int], tuple[int, int, bool]]:
    """For each split whether it starts inside quotes, how many records start before it in its file,
    and whether the file's lines end in a carriage return, too.

    One row for each split reaches the driver: 8,000 for a terabyte in splits of 128 MB.
    """
    totals = lines.mapInArrow(_totals, "file string, block bigint, parity bigint, outside bigint, inside bigint, cr bigint")
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("start", F.coalesce(F.sum("parity").over(order), F.lit(0)) % 2)
    own = F.when(F.col("start") == 0, F.col("outside")).otherwise(F.col("inside"))
    rows = starts.withColumn("own", own).withColumn("before", F.coalesce(F.sum("own").over(order), F.lit(0)))
    header = F.first("cr").over(Window.partitionBy("file").orderBy("block")) == 1
    rows = rows.withColumn("header", header).select("file", "block", "start", "before", "header")
    return {(r.file, r.block): (r.start, r.before, r.header) for r in rows.collect()}


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, record, value``: the records of CSV files as text, numbered from 0 in each file.

    Where the lines of a file end in a carriage return and a line feed, a line feed stands for both.
    """
    lines = _lines(spark, path)
    shared = spark.sparkContext.broadcast(_offsets(lines))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records that are whole within a split, and pieces (``part`` not null) of those that may not be."""
        state: dict[tuple[str, int], tuple[int, int, list[str], bool]] = {}

        def rows(made):
            columns = list(zip(*made)) if made else [[], [], [], [], []]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["file", "record", "part", "value", "cr"])

        for batch in batches:
            made = []
            for file, block, values in _runs(batch):
                if (file, block) not in state:
                    start, before, _ = shared.value[file, block]
                    # The lines before the first start go on with a record of an earlier split.
                    state[file, block] = (start, before - 1, [], False)
                inside, record, held, own = state[file, block]
                cr = shared.value[file, block][2]
                parity = _parity(values, inside)
                for text, within in zip(values.to_pylist(), parity[:-1].tolist()):
                    if not within:
                        if held:
                            made.append((file, record, None if own else block, "\n".join(held), cr))
                        record, held, own = record + 1, [], True
                    held.append(text)
                state[file, block] = (int(parity[-1]), record, held, own)
            yield rows(made)
        # A split ends where its last record may go on.
        yield rows([(file, record, block, "\n".join(held), shared.value[file, block][2]) for (file, block), (_, record, held, _) in state.items() if held])

    made = lines.mapInArrow(assemble, "file string, record bigint, part bigint, value string, cr boolean")
    pieces = made.where("part is not null").groupBy("file", "record", "cr").agg(F.sort_array(F.collect_list(F.struct("part", "value"))).alias("parts"))
    joined = pieces.select("file", "record", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"), "cr")
    every = made.where("part is null").select("file", "record", "value", "cr").unionByName(joined)
    plain = F.regexp_replace(F.replace("value", F.lit("\r\n"), F.lit("\n")), "\r$", "")
    return every.select("file", "record", F.when(F.col("cr"), plain).otherwise(F.col("value")).alias("value"))


def read_csv_split(spark: SparkSession, path: str, schema: T.StructType = RAW_COMPLAINT, order: str | None = None) -> DataFrame:
    """As :func:`suarakit.sources.readers.read_csv`, with as many tasks as the files have splits.

    ``order`` adds a column that sorts by file and place. Every quote must belong to a quoted field,
    as in all CSV that is written by a program; for files with stray quotes use the other reader.
    """
    found = records(spark, path).where("record > 0")  # after the header
    parsed = found.where("value <> ''").select("file", "record", F.from_csv("value", schema.toDDL(), _OPTIONS).alias("row"))
    columns = ["row.*"] + ([F.struct("file", "record").alias(order)] if order else [])
    return parsed.select(*columns)
