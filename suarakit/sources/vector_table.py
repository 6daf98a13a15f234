"""A vector table kept by cell, for intake in batches.

Rows lie in one folder for each cell and batch, so a query batch reads only the cells that can
matter to it, a batch that is written again replaces exactly what it wrote, and compaction merges
the files of a cell. A cell is that of the nearest pivot, and a pivot is a stored row. What the
triangle inequality needs (how far a cell reaches from its pivot) is kept beside the rows, one
small file a batch. ``version=N`` folders hold a table each; the newest one that is complete counts, so
a compaction that dies half-way leaves the old table in place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suarakit.operators import index as I
from suarakit.operators.neighbours import pivot_angles, pivot_router
from suarakit.session import materialise

CELLS = 256


def _fs(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _fs(spark, path)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    numbers = [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]
    return sorted(n for n in numbers if fs.exists(_fs(spark, f"{path}/version={n}/_complete")[1]))


def _root(spark: SparkSession, path: str) -> str | None:
    found = _versions(spark, path)
    return f"{path}/version={found[-1]}" if found else None


def _complete(spark: SparkSession, root: str) -> None:
    fs, marker = _fs(spark, f"{root}/_complete")
    fs.create(marker, True).close()


def _pivots(spark: SparkSession, root: str) -> np.ndarray:
    """At most CELLS vectors (or as many as the table was made with), by cell."""
    rows = spark.read.parquet(f"{root}/pivots").orderBy("cell").select("vec").toArrow()
    return I.matrix(rows["vec"].combine_chunks())


def _assigned(rows: DataFrame, vec_col: str, pivots: np.ndarray) -> DataFrame:
    """``rows`` with the cell and the angle to its pivot."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)
    at = rows.columns.index(vec_col)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            angles = pivot_angles(I.matrix(batch.column(at)), shared.value)
            cell = angles.argmin(axis=1)
            columns = [*batch.columns, pa.array(angles[np.arange(len(cell)), cell].astype(np.float64)), pa.array(cell.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "angle", "cell"])

    return rows.mapInArrow(assign, T.StructType([*rows.schema.fields, *T.StructType.fromDDL("angle double, cell int").fields]))


def _write(rows: DataFrame, vec_col: str, root: str, pivots: np.ndarray, batch: int | None) -> None:
    """Rows and reach of a batch (of their own batches if None), replacing what these batches wrote before."""
    placed = materialise(_assigned(rows, vec_col, pivots))
    if batch is not None:
        placed = placed.withColumn("batch", F.lit(batch).cast("bigint"))
    # One file for each cell and batch, whatever wrote the rows.
    dealt = placed.drop("angle").repartition("cell")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("cell", "batch").parquet(f"{root}/rows")
    reach = placed.groupBy("cell", "batch").agg(F.max("angle").alias("reach"), F.count("*").alias("n")).coalesce(1)
    reach.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{root}/reach")


def _start(rows: DataFrame, vec_col: str, root: str, cells: int) -> np.ndarray:
    """Pivots of a new table: the stored rows nearest to k-means centres of a sample."""
    spark = rows.sparkSession
    given = materialise(rows.select(F.monotonically_increasing_id().alias("sid"), F.col(vec_col).alias("vec")))
    n = given.count()
    k = max(1, min(cells, n // 64))
    sample = materialise(I.sample_rows(given, n, 256 * k))
    centres = I.coarse_centres(sample, k, 5 if k > 1 else 0)
    near = _assigned(sample, "vec", centres)
    # Each centre gives way to its nearest row; centres without rows go.
    chosen = near.groupBy("cell").agg(F.min_by("vec", F.struct("angle", "sid")).alias("vec")).collect()
    made = [(i, [float(x) for x in r["vec"]]) for i, r in enumerate(sorted(chosen, key=lambda r: r["cell"]))]
    spark.createDataFrame(made, "cell int, vec array<double>").coalesce(1).write.mode("overwrite").parquet(f"{root}/pivots")
    return _pivots(spark, root)


def append(rows: DataFrame, path: str, batch: int, vec_col: str = "embedding", cells: int = CELLS) -> None:
    """Store the rows of a batch. A batch written again replaces its own rows.

    Zero vectors have no direction, so nothing can be near them, and they are not stored.
 A batch
    that compaction has merged is finished: writing it again changes nothing.
    """
    spark = rows.sparkSession
    rows = rows.where(F.exists(vec_col, lambda x: x != 0))
    root = _root(spark, path)
    if root is None:
        if rows.isEmpty():
            return
        root = f"{path}/version=0"
        _write(rows, vec_col, root, _start(rows, vec_col, root, cells), batch)
        _complete(spark, root)
        return
    if batch <= merged_through(spark, root):
        return
    _drop_batch(spark, root, batch)
    if not rows.isEmpty():
        _write(rows, vec_col, root, _pivots(spark, root), batch)


def _drop_batch(spark: SparkSession, root: str, batch: int) -> None:
    """Remove what an earlier attempt of the batch left in cells that this one may not touch."""
    fs, folder = _fs(spark, f"{root}/rows")
    for cell in fs.listStatus(folder):
        fs.delete(_fs(spark, f"{cell.getPath().toString()}/batch={batch}")[1], True)
    fs.delete(_fs(spark, f"{root}/reach/batch={batch}")[1], True)


def merged_through(spark: SparkSession, root: str) -> int:
    """The last batch that compaction merged, -1 before the first time."""
    fs, marker = _fs(spark, f"{root}/merged")
    return int(spark.read.parquet(f"{root}/merged").first()["batch"]) if fs.exists(marker) else -1


def _rows(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/rows")


def read(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """All rows, or those of batches before ``before``, with their cell and batch; None if there is no table."""
    root = _root(spark, path)
    if root is None:
        return None
    rows = _rows(spark, root)
    return rows if before is None else rows.where(F.col("batch") < before)


def probe(queries: DataFrame, path: str, vec_col: str = "embedding", before: int | None = None) -> DataFrame | None:
    """The rows of all cells that may hold the nearest stored vector of any query; the others are not read.

    Exact: a cell is left out only if the triangle inequality proves that none of its rows is as
    near as the nearest pivot, which is stored itself. The driver gets numbers of cells.
    """
    spark = queries.sparkSession
    root = _root(spark, path)
    if root is None:
        return None
    reach = spark.read.parquet(f"{root}/reach")
    if before is not None:
        reach = reach.where(F.col("batch") < before)
    radius = {r["cell"]: r["reach"] for r in reach.groupBy("cell").agg(F.max("reach").alias("reach")).collect()}
    pivots = _pivots(spark, root)
    far = np.array([radius.get(c, -np.inf) for c in range(len(pivots))])
    shared = spark.sparkContext.broadcast((pivots, far))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        route = pivot_router(shared.value[0], np.zeros(len(shared.value[0])), shared.value[1], False, None)
        for batch in batches:
            if batch.num_rows:
                seen = np.union1d(seen, route(I.matrix(batch.column(0)).astype(np.float64), np.zeros(batch.num_rows))[1])
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32))], names=["cell"])

    asked = queries.where(F.exists(vec_col, lambda x: x != 0)).select(vec_col).mapInArrow(cells, "cell int")
    wanted = [r["cell"] for r in asked.distinct().collect()]
    rows = _rows(spark, root).where(F.col("cell").isin(wanted))
    return rows if before is None else rows.where(F.col("batch") < before)


def compact(spark: SparkSession, path: str, through: int, vec_col: str = "embedding", cells: int = CELLS) -> None:
    """Write the table anew with pivots that fit it, one file for each cell up to batch ``through``.

    Only batches whose results are committed may be merged. Merged rows
    count as of batch ``through``. Readers of the old version are not disturbed; it is deleted by the next compaction.
    """
    versions = _versions(spark, path)
    if not versions:
        return
    old, new = f"{path}/version={versions[-1]}", f"{path}/version={versions[-1] + 1}"
    fs, folder = _fs(spark, new)
    fs.delete(folder, True)  # of a compaction that did not get to its end
    rows = _rows(spark, old).drop("cell")
    merged = F.when(F.col("batch") <= through, F.lit(through)).otherwise(F.col("batch")).cast("bigint")
    rows = rows.withColumn("batch", merged)
    _write(rows, vec_col, new, _start(rows, vec_col, new, cells), None)
    spark.createDataFrame([(through,)], "batch bigint").coalesce(1).write.parquet(f"{new}/merged")
    _complete(spark, new)
    for version in versions[:-1]:
        fs.delete(_fs(spark, f"{path}/version={version}")[1], True)
