"""Nearest stored vector by cosine similarity.

Both tables are cut into blocks of a bounded number of vectors. Blocks that can matter to
each other meet in an equi-join (a store below a checked size is broadcast instead), a task multiplies two blocks as matrices and passes on one
row per query vector, and an aggregation keeps the best. Neither all pairs of vectors nor a
whole table ever exist in one place.

Which blocks meet is decided by cells:

* ``exact`` puts every stored vector into the cell of its nearest pivot. A query skips a cell
  if the triangle inequality on the sphere proves that nothing in it can win.
* ``index`` looks into a few inverted lists of bounded length (:mod:`suarakit.operators.index`),
  whatever the size of the store. It may miss neighbours; measure its recall.
* ``lsh`` puts vectors with equal random-hyperplane signatures of a given layout into one cell.
  Without a layout it is the same as ``index``: the bands a layout needs for a fixed recall grow
  with the store, those lists do not.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suarakit import constants as K
from suarakit.operators import index as I
from suarakit.operators.quality import keep_first
from suarakit.session import materialise

# A query row goes to every stored block that may matter to it, so blocks are large: the rows of a
# block and of a cell, and the query rows that go together.
BLOCK_ROWS = 1 << 16
BLOCK_BYTES = 16 << 20
CELL_ROWS = 1 << 16
QUERY_ROWS = 8192
BROADCAST_BYTES = 32 << 20
MAX_PIVOTS = 256
# Similarities computed at once: so many queries by so many stored rows, which fit a core's cache.
_CHUNK = 512
_TILE = 1024
# Similarities equal to so many places tie, whatever order they were summed in.
_STABLE = 9

# (unit vectors, order) -> (row numbers, cells), both sorted by cell
Router = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Lsh:
    """Signature layout of the approximate method."""

    bands: int = 16
    bits: int = 8
    seed: int = 7

    @staticmethod
    def sized(rows: int, similarity: float = K.DUPLICATE_THRESHOLD, recall: float = 0.9) -> Lsh:
        """Layout for a store of so many rows: two vectors of this similarity share a band so often.

        Bits grow with the logarithm of the store, so a cell holds about as many vectors at any
        size; the number of bands follows from the recall wanted.
        """
        bits = max(8, math.ceil(math.log2(max(rows, 2))) + 1)
        agree = 1 - math.acos(min(1.0, max(-1.0, similarity))) / math.pi
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(agree**bits)))
        return Lsh(bands, bits)


def _unit(vectors: np.ndarray) -> np.ndarray:
    m = vectors.astype(np.float64)
    size = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, size, out=np.zeros_like(m), where=size > 0)


def _given(lists: pa.Array) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _matrix(lists: pa.Array) -> np.ndarray:
    return _unit(_given(lists))


def pivot_angles(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ pivots.T, -1.0, 1.0))


# --- cells ------------------------------------------------------------------------------

def _pivot_cell(pivots: np.ndarray):
    @F.pandas_udf("cell long, angle double")
    def assign(vec: pd.Series) -> pd.DataFrame:
        if not len(vec):
            return pd.DataFrame({"cell": [], "angle": []})
        angle = pivot_angles(_unit(np.stack(vec.to_numpy())), pivots)
        cell = angle.argmin(axis=1)
        return pd.DataFrame({"cell": cell, "angle": angle[np.arange(len(cell)), cell]})

    # Not repeated in the steps that use the cell.
    return assign.asNondeterministic()


def pivot_router(
    pivots: np.ndarray,
    pivot_order: np.ndarray,
    radius: np.ndarray,
    ordered: bool,
    min_similarity: float | None,
) -> Router:
    """Probe the cells that may hold a vector at least as near as the best pivot known."""
    # A score is rounded to four places before it meets the threshold.
    limit = math.pi if min_similarity is None else math.acos(
        min(1.0, max(-1.0, min_similarity - 1e-4))
    )

    def route(units: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        angle = pivot_angles(units, pivots)
        known = angle
        if ordered:
            known = np.where(pivot_order[None, :] < order[:, None], angle, math.pi)
        reach = np.minimum(known.min(axis=1), limit) + 1e-6
        cells, rows = np.nonzero((angle - radius[None, :] <= reach[:, None]).T)
        return rows, cells

    return route


def _n_pivots(n: int, block_rows: int) -> int:
    return max(1, min(MAX_PIVOTS, n // min(4 * block_rows, CELL_ROWS)))


def _pivot_cells(
    s: DataFrame, n: int, block_rows: int, ordered: bool, min_similarity: float | None
) -> tuple[DataFrame, Router, list[int]]:
    """Stored rows with their cell, the query router, and the number of parts per cell."""
    n_pivots = _n_pivots(n, block_rows)
    if n_pivots == 1:
        everything = lambda units, order: (
            np.arange(len(units)), np.zeros(len(units), dtype=np.int64)
        )
        return s.withColumn("cell", F.lit(0).cast("long")), everything, [math.ceil(n / block_rows)]
    # At most MAX_PIVOTS rows reach the driver, whatever the size of the store.
    chosen = s.orderBy(F.xxhash64("id"), "id").limit(n_pivots).collect()
    pivots = _unit(np.array([r["vec"] for r in chosen]))
    assigned = s.withColumn("_c", _pivot_cell(pivots)("vec"))
    cells = (
        assigned.groupBy(F.col("_c.cell").alias("cell"))
        .agg(F.max("_c.angle").alias("radius"), F.count("*").alias("n"))
        .collect()
    )
    radius, parts = np.full(len(pivots), -np.inf), [0] * len(pivots)
    for c in cells:
        radius[c["cell"]] = c["radius"]
        parts[c["cell"]] = math.ceil(c["n"] / block_rows)
    router = pivot_router(
        pivots, np.array([r["ord"] for r in chosen]), radius, ordered, min_similarity
    )
    return assigned.select("id", "ord", "vec", F.col("_c.cell").alias("cell")), router, parts


def _lsh_cells(units: np.ndarray, lsh: Lsh) -> np.ndarray:
    rng = np.random.default_rng(lsh.seed)
    planes = rng.standard_normal((units.shape[1], lsh.bands * lsh.bits))
    signs = (units @ planes > 0).reshape(len(units), lsh.bands, lsh.bits)
    bucket = signs @ (1 << np.arange(lsh.bits, dtype=np.int64))
    return bucket + (np.arange(lsh.bands, dtype=np.int64) << lsh.bits)


def _lsh_router(lsh: Lsh) -> Router:
    def route(units: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cells = _lsh_cells(units, lsh).ravel()
        rows = np.repeat(np.arange(len(units)), lsh.bands)
        by_cell = np.argsort(cells, kind="stable")
        return rows[by_cell], cells[by_cell]

    return route


def _lsh_cell(lsh: Lsh):
    @F.pandas_udf("array<long>")
    def assign(vec: pd.Series) -> pd.Series:
        if not len(vec):
            return pd.Series([], dtype=object)
        return pd.Series(list(_lsh_cells(_unit(np.stack(vec.to_numpy())), lsh)))

    return assign


# --- blocks -----------------------------------------------------------------------------

def _pack_queries(q: DataFrame, route: Router, block_rows: int) -> DataFrame:
    """Blocks ``cell, q_rows`` formed inside each task, without a shuffle."""
    member = T.StructType([q.schema["id"], q.schema["ord"], q.schema["vec"]])
    schema = T.StructType(
        [T.StructField("cell", T.LongType()), T.StructField("q_rows", T.ArrayType(member))]
    )

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= min(QUERY_ROWS, block_rows):
                yield pa.concat_batches(held)
                held, n = [], 0
        if n:
            yield pa.concat_batches(held)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            units = _matrix(batch.column("vec"))
            order = batch.column("ord").to_numpy(zero_copy_only=False)
            rows, cells = route(units, order)
            structs = batch.to_struct_array()
            # One block per cell, cut again where a cell exceeds the block size.
            edges = np.flatnonzero(np.diff(cells)) + 1
            for start, stop in zip(np.r_[0, edges], np.r_[edges, len(cells)]):
                for lo in range(start, stop, block_rows):
                    hi = min(lo + block_rows, stop)
                    values = structs.take(pa.array(rows[lo:hi]))
                    offsets = pa.array([0, hi - lo], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([cells[lo]], pa.int64()), pa.ListArray.from_arrays(offsets, values)],
                        names=["cell", "q_rows"],
                    )

    return q.select("id", "ord", "vec").mapInArrow(pack, schema)


def _pack_store(s: DataFrame) -> DataFrame:
    """Blocks ``cell, part, s_rows``; a hashed part number splits crowded cells evenly."""
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    return (
        s.withColumn("part", part)
        .groupBy("cell", "part")
        .agg(F.collect_list(F.struct("id", "ord", "vec")).alias("s_rows"))
    )


def _meet(asked: DataFrame, stored: DataFrame, n_blocks: int) -> DataFrame:
    """Pairs of blocks, spread over several tasks per core however few store blocks there are.

    Each store block is copied to as many slices as that takes; a query block goes to one.
    """
    cores = asked.sparkSession.sparkContext.defaultParallelism
    slices = F.lit(max(1, math.ceil(4 * cores / n_blocks)))
    one = F.pmod(F.xxhash64(F.get("q_rows", F.lit(0))["id"]), slices).cast("int")
    every = F.explode(F.sequence(F.lit(0), slices - 1))
    return asked.withColumn("slice", one).join(
        stored.withColumn("slice", every), ["cell", "part", "slice"]
    )


class _Stored:
    """A stored block in (order, id) order, rounded to single precision.

    Products in single precision say which pairs can matter; only those are computed in double
    precision, whose value decides. Unit vectors in double precision are made for a few rows at a
    time, so a block takes little more than the vectors as given and once in single precision.
    """

    def __init__(self, rows: pa.StructArray):
        # In (order, id) order the first maximum is also the tie winner.
        place = pc.sort_indices(
            pa.RecordBatch.from_arrays([rows.field("ord"), rows.field("id")], ["ord", "id"]),
            sort_keys=[("ord", "ascending"), ("id", "ascending")],
        )
        self.ids, self.order = rows.field("id").take(place), rows.field("ord").take(place).to_numpy()
        self.place, self.given = place.to_numpy(), _given(rows.field("vec"))
        self.single = np.empty(self.given.shape[::-1], np.float32)
        for lo in range(0, len(place), _TILE):
            self.single[:, lo : lo + _TILE] = self.units(slice(lo, lo + _TILE)).T
        # How far a product in single precision may be off.
        self.off = (self.given.shape[1] + 8) * 2.0**-23

    def units(self, at) -> np.ndarray:
        return _unit(self.given[self.place[at]])

    def chunks(self, queries: pa.StructArray, ordered: bool):
        """Ids and unit vectors of some queries, and how many of the stored rows come before each (None: all)."""
        order = queries.field("ord").to_numpy()
        for lo in range(0, len(queries), _CHUNK):
            part = queries.slice(lo, _CHUNK)
            before = np.searchsorted(self.order, order[lo : lo + _CHUNK], "left") if ordered else None
            if before is None or before.any():
                yield part.field("id"), _matrix(part.field("vec")), before

    def tiles(self, units: np.ndarray, before: np.ndarray | None) -> Iterator[tuple[int, np.ndarray]]:
        """First stored row and products in single precision; -inf for rows that do not come before."""
        single = units.astype(np.float32)
        for lo in range(0, len(self.order) if before is None else int(before.max()), _TILE):
            products = single @ self.single[:, lo : lo + _TILE]
            if before is not None and before.min() < lo + products.shape[1]:
                products[np.arange(lo, lo + products.shape[1])[None, :] >= before[:, None]] = -np.inf
            yield lo, products

    def exact(self, units: np.ndarray, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Similarities of pairs in double precision. They are rounded, so copies tie whatever order they were summed in."""
        out = np.empty(len(rows))
        step = max(1, (1 << 17) // units.shape[1])
        for lo in range(0, len(rows), step):
            cut = slice(lo, lo + step)
            out[cut] = np.einsum("ij,ij->i", units[rows[cut]], self.units(at[cut]))
        return np.round(out, _STABLE)


def _first_best(stored: _Stored, units: np.ndarray, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries that have any, place and similarity of their best stored row; of equal ones the first, within a
    block as between blocks."""
    slack = np.float32(2 * stored.off)
    top = np.full(len(units), -np.inf, np.float32)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for lo, products in stored.tiles(units, before):
        best = products.max(axis=1)
        top = np.maximum(top, best)
        better = np.flatnonzero((best >= top - slack) & (best > -np.inf))
        if len(better):
            some = products[better]
            row, at = np.divmod(np.flatnonzero(some >= (top[better] - slack)[:, None]), some.shape[1])
            # Compared exactly at once, and of a query's equal ones in this tile only the first stays.
            found.append(_firsts(better[row], at + lo, stored.exact(units, better[row], at + lo)))
    return _firsts(*(np.concatenate(c) for c in zip(*found)))


def _firsts(rows: np.ndarray, at: np.ndarray, sims: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((at, -sims, rows))
    rows, at, sims = rows[order], at[order], sims[order]
    first = np.append(True, rows[1:] != rows[:-1])[: len(rows)]
    return rows[first], at[first], sims[first]


def _best_matches(pairs: DataFrame, ordered: bool, min_similarity: float | None) -> DataFrame:
    """For each pair of blocks, every query's best stored vector, as ``id, far, s_ord, s_id``."""
    q_type = pairs.schema["q_rows"].dataType.elementType
    s_type = pairs.schema["s_rows"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("id", q_type["id"].dataType),
            T.StructField("far", T.DoubleType()),
            T.StructField("sim", T.DoubleType()),
            T.StructField("s_ord", T.LongType()),
            T.StructField("s_id", s_type["id"].dataType),
        ]
    )

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                stored = _Stored(batch.column("s_rows")[i].values)
                for ids, units, before in stored.chunks(batch.column("q_rows")[i].values, ordered):
                    rows, best, sims = _first_best(stored, units, before)
                    if min_similarity is not None:
                        good = np.round(sims, 4) >= min_similarity
                        rows, best, sims = rows[good], best[good], sims[good]
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(rows)), pa.array(-sims), pa.array(sims), pa.array(stored.order[best]), stored.ids.take(pa.array(best))],
                        names=schema.names,
                    )

    return pairs.select("q_rows", "s_rows").mapInArrow(multiply, schema)


def _similar(
    stored: _Stored, units: np.ndarray, before: np.ndarray | None, min_similarity: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Queries and stored rows of all pairs whose similarity, rounded to four places, is at least ``min_similarity``."""
    bound = math.ceil(min_similarity * 1e4 - 1e-6) / 1e4 - 5e-5
    low, high = np.float32(bound - 2 * stored.off), np.float32(bound + 2 * stored.off)
    for lo, products in stored.tiles(units, before):
        flat = products.ravel()
        near = np.flatnonzero(flat >= low)
        if len(near):
            rows, at = np.divmod(near, products.shape[1])
            unsure = np.flatnonzero(flat[near] < high)
            sims = stored.exact(units, rows[unsure], at[unsure] + lo)
            wrong = unsure[np.round(sims, 4) < min_similarity]
            yield np.delete(rows, wrong), np.delete(at, wrong) + lo


def _all_matches(pairs: DataFrame, ordered: bool, min_similarity: float, counts: bool) -> DataFrame:
    """Every match of at least ``min_similarity`` as ``id, s_id``, or their number for each query as ``id, n``."""
    q_type = pairs.schema["q_rows"].dataType.elementType
    s_type = pairs.schema["s_rows"].dataType.elementType
    last = T.StructField("n", T.LongType()) if counts else T.StructField("s_id", s_type["id"].dataType)
    schema = T.StructType([T.StructField("id", q_type["id"].dataType), last])

    def pairs_of(stored: _Stored, ids: pa.Array, held: list) -> pa.RecordBatch:
        rows, at = (pa.array(np.concatenate(c)) for c in zip(*held))
        return pa.RecordBatch.from_arrays([ids.take(rows), stored.ids.take(at)], names=schema.names)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                stored = _Stored(batch.column("s_rows")[i].values)
                for ids, units, before in stored.chunks(batch.column("q_rows")[i].values, ordered):
                    n, held, size = np.zeros(len(ids), np.int64), [], 0
                    for rows, at in _similar(stored, units, before, min_similarity):
                        if counts:
                            n += np.bincount(rows, minlength=len(n))
                            continue
                        held.append((rows, at))
                        size += len(rows)
                        if size >= 1 << 18:
                            yield pairs_of(stored, ids, held)
                            held, size = [], 0
                    if held:
                        yield pairs_of(stored, ids, held)
                    rows = np.flatnonzero(n)
                    if len(rows):
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(n[rows])], names=schema.names)

    return pairs.select("q_rows", "s_rows").mapInArrow(multiply, schema)


# --- search -----------------------------------------------------------------------------

def _side(df: DataFrame, id_col: str, vec_col: str, order_col: str | None) -> DataFrame:
    order = F.col(order_col).cast("long") if order_col else F.lit(0).cast("long")
    # A zero vector has no direction and therefore no neighbours.
    return df.select(
        F.col(id_col).alias("id"), order.alias("ord"), F.col(vec_col).alias("vec")
    ).filter(F.exists("vec", lambda x: x != 0))


def _met(
    q: DataFrame, s: DataFrame, size, ordered: bool, min_similarity: float | None, lsh: Lsh | None, block_rows: int, broadcast_bytes: int
) -> DataFrame:
    """Blocks of both sides that can matter to each other."""
    if lsh is not None:
        routed = s.withColumn("cell", F.explode(_lsh_cell(lsh)("vec")))
        router = _lsh_router(lsh)
        crowd = routed.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).alias("parts"))

        def with_parts(df: DataFrame) -> DataFrame:
            return df.join(crowd, "cell")

    else:
        routed, router, crowd = _pivot_cells(s, size["n"], block_rows, ordered, min_similarity)

        def with_parts(df: DataFrame) -> DataFrame:
            # One literal per pivot: small by construction.
            sizes = F.array(*[F.lit(p) for p in crowd])
            return df.withColumn("parts", F.get(sizes, F.col("cell").cast("int")))

    copies = lsh.bands if lsh is not None else 1
    stored = _pack_store(with_parts(routed))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    asked = with_parts(_pack_queries(q, router, block_rows)).select("cell", part, "q_rows")
    # Entries as they are stored, and an id and an order beside them.
    entry = s.schema["vec"].dataType.elementType
    width = {T.DoubleType(): 8, T.LongType(): 8}.get(entry, 4)
    if copies * size["n"] * (size["dim"] * width + 64) <= broadcast_bytes:
        # A store of this checked size goes to every task, and the batch is not shuffled.
        return asked.join(F.broadcast(stored), ["cell", "part"])
    return _meet(asked, stored, copies * math.ceil(size["n"] / block_rows))


def _size(s: DataFrame):
    return s.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dim")).first()


def _block_rows(size) -> int:
    return max(64, min(BLOCK_ROWS, BLOCK_BYTES // (4 * size["dim"])))


def earlier_matches(
    rows: DataFrame,
    min_similarity: float,
    id_col: str = "key",
    vec_col: str = "vec",
    method: str = "exact",
    lsh: Lsh | None = None,
    search: I.Search | None = None,
    block_rows: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    counts: bool = False,
) -> DataFrame:
    """Pairs ``id, s_id`` of rows and earlier rows (of smaller id) that are as similar, or with
    ``counts`` their number for each row as ``id, n``.

    Crowded places have many pairs: count them before asking for them. ``method="index"`` finds no
    more pairs of a row than ``search`` compares exactly.
    """
    q = s = _side(rows, id_col, vec_col, id_col)
    size = _size(s)
    if not size["n"]:
        last = F.lit(0).cast("long").alias("n") if counts else F.col("id").alias("s_id")
        return q.select("id", last)
    if method == "index" or method == "lsh" and lsh is None:
        found = I.nearest(q, I.build(s), True, search or I.Search(), _STABLE).where(F.round("sim", 4) >= min_similarity)
        return found.groupBy("id").agg(F.count("*").alias("n")) if counts else found.select("id", "s_id")
    if _n_pivots(size["n"], block_rows or _block_rows(size)) > 1:
        s = materialise(s)
    met = _met(q, s, size, True, min_similarity, lsh, block_rows or _block_rows(size), broadcast_bytes)
    found = _all_matches(met, True, min_similarity, counts)
    if counts:
        return found.groupBy("id").agg(F.sum("n").alias("n"))
    # Several bands may hold the same pair.
    return found if lsh is None else found.distinct()


def nearest(
    batch: DataFrame,
    store: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    order_col: str | None = None,
    min_similarity: float | None = None,
    method: str = "exact",
    lsh: Lsh | None = None,
    search: I.Search | None = None,
    block_rows: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    distinct_store: bool = False,
    store_id_col: str | None = None,
    store_order_col: str | None = None,
) -> DataFrame:
    """``id, similarity, nearest_id`` for every row of ``batch``; NULLs without a neighbour.

    With ``order_col`` only stored rows of a smaller order compete. ``min_similarity`` ignores
    worse neighbours (judged on the score rounded to four places) and prunes harder. Equal
    similarities go to the earlier, then the smaller id. ``distinct_store`` promises that no
    two stored vectors are identical and saves collapsing them. Ids of ``batch`` are unique;
    the store may name its id and order columns otherwise. ``search`` says how far ``index`` looks.
    """
    q = _side(batch, id_col, vec_col, order_col)
    s = _side(store, store_id_col or id_col, vec_col, order_col and (store_order_col or order_col))
    ordered = order_col is not None
    size = _size(s)
    ids = batch.select(F.col(id_col).alias("id"))
    if not size["n"]:
        return ids.select("id", F.lit(None).cast("double").alias("similarity"),
                          F.lit(None).cast(s.schema["id"].dataType).alias("nearest_id"))
    if block_rows is None:
        block_rows = _block_rows(size)

    if not distinct_store:
        # Identical stored vectors tie, and the first of them wins: the others cannot matter.
        tie = F.struct("ord", "id")
        s = keep_first(s.withColumn("_tie", tie), ["vec"], "_tie", long_keys=True).drop("_tie")
        if _n_pivots(size["n"], block_rows) > 1:
            # Choosing pivots, measuring cells and packing blocks all read the store.
            s = materialise(s)

    def answered(found: DataFrame) -> DataFrame:
        best = found.groupBy("id").agg(F.min(F.struct("far", "s_ord", "s_id", "sim")).alias("b"))
        return ids.join(best, "id", "left").select(
            "id", F.col("b.sim").alias("similarity"), F.col("b.s_id").alias("nearest_id")
        )

    if method == "index" or method == "lsh" and lsh is None:
        found = I.nearest(q, I.build(s), ordered, search or I.Search(), _STABLE, best_only=True)
        if min_similarity is not None:
            found = found.where(F.round("sim", 4) >= min_similarity)
        return answered(found)
    if method not in ("exact", "lsh"):
        raise ValueError(f"unknown method {method!r}")
    pairs = _met(q, s, size, ordered, min_similarity, lsh if method == "lsh" else None, block_rows, broadcast_bytes)
    return answered(_best_matches(pairs, ordered, min_similarity))
