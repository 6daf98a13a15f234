"""Approximate nearest neighbours from inverted lists with residual codes.

Stored vectors are dealt to lists of about ``LIST_ROWS`` around centroids, so what a query has to
look at does not grow with the store: a few lists, found through a coarse level of centroids
and the children of its nearest ones. A list holds one byte a dimension and a scale for the difference between vector and
centroid. The best candidates by these codes are compared exactly, with the vectors themselves.

Coarse centroids come from k-means steps that each are one Spark job over a sample; every cell then
clusters its own sample in a task of its own. Samples bound the fitting alone: every vector is
assigned and coded. Centroids reach the driver and every task, at most ``CENTROID_BYTES`` of them;
a store too large for that gets longer lists.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suarakit.session import materialise, scratch_path

LIST_ROWS = 256
CENTROID_BYTES = 64 << 20
BLOCK_ROWS = 4096
# Most that the similarity of unit vectors changes if one is rounded to half precision, and products to single.
HALF_OFF = 1e-3


@dataclass(frozen=True)
class Search:
    """How many coarse cells and lists a query probes, and how many candidates are compared exactly."""

    cells: int = 48
    lists: int = 160
    candidates: int = 32


class Centroids(NamedTuple):
    """Coarse centroids, and those of the lists: cell c has the lists from first[c] to first[c + 1]."""

    coarse: np.ndarray
    lists: np.ndarray
    first: np.ndarray


@dataclass(frozen=True)
class Index:
    """``rows``: sid, list, id, ord, vec, code, scale. Read back from a written table."""

    centroids: Centroids
    rows: DataFrame
    n: int


def unit(vectors: np.ndarray) -> np.ndarray:
    m = vectors.astype(np.float64)
    size = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, size, out=np.zeros_like(m), where=size > 0).astype(np.float32)


def matrix(lists: pa.Array) -> np.ndarray:
    return unit(lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1))


def _means(units: np.ndarray, cell: np.ndarray, old: np.ndarray) -> np.ndarray:
    sums = np.zeros(old.shape, np.float64)
    np.add.at(sums, cell, units)
    moved = unit(sums)
    empty = ~moved.any(axis=1)
    moved[empty] = old[empty]
    return moved


def _local_kmeans(units: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Centroids of vectors that are in a random order already."""
    centroids = units[:k].copy()
    for _ in range(rounds):
        centroids = _means(units, (units @ centroids.T).argmax(axis=1), centroids)
    return centroids


def sample_rows(rows: DataFrame, n: int, wanted: int) -> DataFrame:
    """About ``wanted`` rows by their hash, the same ones each time."""
    if n <= wanted:
        return rows
    return rows.where(F.pmod(F.xxhash64("sid"), F.lit(1 << 20)) < max(1, int((1 << 20) * wanted / n)))


def coarse_centres(sample: DataFrame, k: int, rounds: int) -> np.ndarray:
    """k-means by one job a round: tasks add up their vectors, the sums of a centroid meet by a shuffle."""
    spark = sample.sparkSession
    seeds = sample.orderBy(F.xxhash64("sid", F.lit(1)), "sid").limit(k).select("vec").toArrow()
    centroids = matrix(seeds["vec"].combine_chunks())
    dim = centroids.shape[1]
    schema = "cell int, sums array<double>"
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(centroids)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(shared.value), dim))
            for batch in batches:
                units = matrix(batch.column(0))
                np.add.at(sums, (units @ shared.value.T).argmax(axis=1), units)
            full = np.flatnonzero(sums.any(axis=1))
            offsets = pa.array(np.arange(len(full) + 1, dtype=np.int32) * dim)
            yield pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(sums[full].ravel()))], names=["cell", "sums"]
            )

        def total(table: pa.Table) -> pa.Table:
            sums = np.stack(table["sums"].to_pylist()).sum(axis=0)
            return pa.table({"cell": table["cell"].slice(0, 1), "sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})

        found = sample.select("vec").mapInArrow(add, schema).groupBy("cell").applyInArrow(total, schema).collect()
        for row in found:
            centroids[row["cell"]] = unit(np.array([row["sums"]]))[0]
    return centroids


def _nearest_cells(units: np.ndarray, centroids: Centroids, cells: int) -> np.ndarray:
    scores = units @ centroids.coarse.T
    cells = min(cells, scores.shape[1])
    return np.argpartition(-scores, cells - 1, axis=1)[:, :cells]


def nearest_lists(units: np.ndarray, centroids: Centroids, cells: int, lists: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and lists: for each vector the best lists among those of its best coarse cells."""
    near = _nearest_cells(units, centroids, cells)
    flat, row = near.ravel(), np.repeat(np.arange(len(units)), near.shape[1])
    order = np.argsort(flat, kind="stable")
    rows, numbers, scores = [], [], []
    edges = np.flatnonzero(np.diff(flat[order])) + 1
    for part in np.split(order, edges):
        cell = flat[part[0]] if len(part) else 0
        low, high = int(centroids.first[cell]), int(centroids.first[cell + 1])
        if high == low or not len(part):
            continue
        found = units[row[part]] @ centroids.lists[low:high].T
        best = min(lists, high - low)
        top = np.argpartition(-found, best - 1, axis=1)[:, :best]
        rows.append(np.repeat(row[part], best))
        numbers.append((top + low).ravel())
        scores.append(np.take_along_axis(found, top, axis=1).ravel())
    rows, numbers, scores = np.concatenate(rows), np.concatenate(numbers), np.concatenate(scores)
    order = np.lexsort((numbers, -scores, rows))
    rows, numbers = rows[order], numbers[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows, "left")
    return rows[place < lists], numbers[place < lists]


def _children(rows: DataFrame, coarse: np.ndarray, n: int, list_rows: int, rounds: int, sample: int) -> Centroids:
    """Lists of every coarse cell, as many as its size needs, each fitted on a bounded sample of the cell."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(coarse)

    def cell_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = (matrix(batch.column(1)) @ shared.value.T).argmax(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], names=["cell", *batch.schema.names])

    schema = T.StructType([T.StructField("cell", T.IntegerType()), rows.schema["sid"], rows.schema["vec"]])
    celled = rows.select("sid", "vec").mapInArrow(cell_of, schema)
    sizes = {r["cell"]: r["n"] for r in celled.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    wanted = [math.ceil(sizes.get(c, 0) / list_rows) for c in range(len(coarse))]
    lists = spark.sparkContext.broadcast(wanted)
    some = sample_rows(rows, n, sample * sum(wanted)).select("sid", "vec").mapInArrow(cell_of, schema)
    most = F.get(F.array(*[F.lit(sample * w) for w in wanted]), F.col("cell"))
    order = Window.partitionBy("cell").orderBy(F.xxhash64("sid", F.lit(2)), "sid")
    some = some.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)

    def cluster(table: pa.Table) -> pa.Table:
        cell = table["cell"][0].as_py()
        order = np.argsort(table["place"].to_numpy())
        units = matrix(table["vec"].combine_chunks())[order]
        made = _local_kmeans(units, min(lists.value[cell], len(units)), rounds)
        return pa.table({"cell": pa.array([cell] * len(made), pa.int32()), "vec": pa.array(made.tolist(), pa.list_(pa.float32()))})

    made = some.groupBy("cell").applyInArrow(cluster, "cell int, vec array<float>").toArrow()
    cells = made["cell"].to_numpy()
    order = np.argsort(cells, kind="stable")
    vectors = np.array(made["vec"].to_pylist(), np.float32)[order]
    first = np.searchsorted(cells[order], np.arange(len(coarse) + 1))
    return Centroids(coarse, vectors, first)


def build(rows: DataFrame, list_rows: int = LIST_ROWS, rounds: int = 5, sample: int = 48) -> Index:
    """Index over ``id, ord, vec``; the vectors are neither null nor zero."""
    spark = rows.sparkSession
    rows = materialise(rows.select(F.monotonically_increasing_id().alias("sid"), "id", "ord", "vec"))
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dim")).first()
    n, dim = size["n"], size["dim"]
    n_lists = max(1, min(math.ceil(n / list_rows), CENTROID_BYTES // (4 * dim)))
    list_rows = math.ceil(n / n_lists)
    coarse = n_lists if n_lists <= 32 else math.ceil(math.sqrt(n_lists))
    centroids = coarse_centres(materialise(sample_rows(rows, n, 256 * coarse)), coarse, rounds if coarse > 1 else 0)
    if n_lists <= 32:
        centroids = Centroids(centroids, centroids, np.arange(len(centroids) + 1))
    else:
        centroids = _children(rows, centroids, n, list_rows, rounds, sample)
    shared = spark.sparkContext.broadcast(centroids)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            units = matrix(batch.column(3))
            _, lists = nearest_lists(units, shared.value, 6, 1)
            rest = units - shared.value.lists[lists]
            scale = np.maximum(np.abs(rest).max(axis=1), 1e-12) / 127
            codes = np.rint(rest / scale[:, None]).astype(np.int8)
            flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(dim), len(codes), [None, pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lists.astype(np.int32)), flat.cast(pa.binary()), pa.array(scale.astype(np.float32))],
                names=[*batch.schema.names, "list", "code", "scale"],
            )

    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("list int, code binary, scale float").fields])
    path = scratch_path(spark, "index")
    rows.mapInArrow(code, schema).write.parquet(path)
    return Index(centroids, spark.read.schema(schema).parquet(path), n)


def _ask(queries: DataFrame, index: Index, search: Search) -> DataFrame:
    """Blocks ``list, asked`` of queries that probe a list, formed within each task."""
    shared = queries.sparkSession.sparkContext.broadcast(index.centroids)
    # A query goes to every list it probes, so its direction goes in half precision.
    member = T.StructType([queries.schema["id"], queries.schema["ord"], T.StructField("vec", T.BinaryType())])
    schema = T.StructType([T.StructField("list", T.IntegerType()), T.StructField("asked", T.ArrayType(member))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            units = matrix(batch.column(2))
            rows, lists = nearest_lists(units, shared.value, search.cells, search.lists)
            order = np.argsort(lists, kind="stable")
            rows, lists = rows[order], lists[order]
            half = np.ascontiguousarray(units, dtype=np.float16)
            flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * half.shape[1]), len(half), [None, pa.py_buffer(half.tobytes())])
            values = pa.StructArray.from_arrays([batch.column(0), batch.column(1), flat.cast(pa.binary())], ["id", "ord", "vec"])
            values = values.take(pa.array(rows))
            starts = np.flatnonzero(np.append(True, lists[1:] != lists[:-1]))
            starts = np.unique(np.concatenate([starts, np.arange(0, len(lists), BLOCK_ROWS)]))
            offsets = pa.array(np.append(starts, len(lists)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists[starts].astype(np.int32)), pa.ListArray.from_arrays(offsets, values)], names=["list", "asked"]
            )

    return queries.select("id", "ord", "vec").mapInArrow(pack, schema)


def _candidates(met: DataFrame, index: Index, most: int, ordered: bool, best_only: bool, id_type: T.DataType) -> DataFrame:
    """For each block of queries and part of a list, every query's best entries by code.

    The similarity is between ``low`` and ``high``. With ``best_only`` entries go that cannot be as
    near as another one of the part.
    """
    shared = met.sparkSession.sparkContext.broadcast(index.centroids.lists)
    schema = T.StructType([T.StructField("id", id_type), *T.StructType.fromDDL("sid bigint, score float, low float, high float").fields])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asked, entries = batch.column(1)[i].values, batch.column(2)[i].values
                codes = np.frombuffer(b"".join(entries.field("code").to_pylist()), np.int8).reshape(len(entries), -1)
                centroid = shared.value[batch.column(0)[i].as_py()]
                vectors = centroid + codes * entries.field("scale").to_numpy()[:, None]
                units = np.frombuffer(b"".join(asked.field("vec").to_pylist()), np.float16).reshape(len(asked), -1).astype(np.float32)
                scores = units @ vectors.T
                # A code is off by half a step a dimension, a query by the rounding to half precision.
                off = entries.field("scale").to_numpy() * (0.5 * math.sqrt(codes.shape[1])) + HALF_OFF
                if ordered:
                    scores[entries.field("ord").to_numpy()[None, :] >= asked.field("ord").to_numpy()[:, None]] = -np.inf
                k = min(most, scores.shape[1])
                top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
                rows, best = np.repeat(np.arange(len(units)), k), top.ravel()
                found = scores[rows, best]
                low, high = (found - off[best]).astype(np.float32), (found + off[best]).astype(np.float32)
                good = np.isfinite(found)
                if best_only:
                    good &= high >= np.repeat(low.reshape(-1, k).max(axis=1), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        asked.field("id").take(pa.array(rows[good])), entries.field("sid").take(pa.array(best[good])),
                        pa.array(found[good].astype(np.float32)), pa.array(low[good]), pa.array(high[good]),
                    ],
                    names=schema.names,
                )

    return met.select("list", "asked", "entries").mapInArrow(score, schema)


def candidates(
    queries: DataFrame, index: Index, ordered: bool = False, search: Search = Search(), best_only: bool = False
) -> DataFrame:
    """``id, sid, score``: at most ``search.candidates`` stored rows for each query, judged by code.

    With ``best_only`` only those of them that may be the nearest, as far as the codes tell.
    """
    asked = _ask(queries, index, search)
    part = F.floor(F.pmod(F.xxhash64("sid"), F.lit(1 << 20)) / F.lit(1 << 20) * F.col("parts")).cast("int")
    sizes = index.rows.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts"))
    # A crowded list is cut into parts, and a query asks each of them.
    entries = index.rows.select("list", "sid", "ord", "code", "scale").join(sizes, "list").withColumn("part", part)
    stored = entries.groupBy("list", "part").agg(F.collect_list(F.struct("sid", "ord", "code", "scale")).alias("entries"))
    found = _candidates(stored.join(asked, "list"), index, search.candidates, ordered, best_only, queries.schema["id"].dataType)
    order = Window.partitionBy("id").orderBy(F.desc("score"), "sid")
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= search.candidates)
    if best_only:
        found = found.withColumn("low", F.max("low").over(Window.partitionBy("id"))).where("high >= low")
    return found.select("id", "sid", "score")


def nearest(
    queries: DataFrame, index: Index, ordered: bool = False, search: Search = Search(), places: int = 9, best_only: bool = False
) -> DataFrame:
    """``id, far, sim, s_ord, s_id`` of the candidates, compared exactly; ``queries`` are ``id, ord, vec`` of unique ids."""
    found = candidates(queries, index, ordered, search, best_only)
    theirs = index.rows.select("sid", F.col("id").alias("s_id"), F.col("ord").alias("s_ord"), F.col("vec").alias("theirs"))
    pairs = found.join(theirs, "sid").join(queries.select("id", "vec"), "id")
    schema = T.StructType(
        [queries.schema["id"], *T.StructType.fromDDL("far double, sim double, s_ord bigint").fields, T.StructField("s_id", index.rows.schema["id"].dataType)]
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            mine, other = (
                batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.float64) for c in ("vec", "theirs")
            )
            sim = (mine * other).sum(axis=1) / np.maximum(np.linalg.norm(mine, axis=1) * np.linalg.norm(other, axis=1), 1e-300)
            sim = np.round(sim, places)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(-sim), pa.array(sim), batch.column("s_ord"), batch.column("s_id")], names=schema.names
            )

    return pairs.mapInArrow(compare, schema)
