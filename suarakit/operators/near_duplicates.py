"""Near-duplicate verdicts against a store, and first-come de-duplication."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suarakit import constants as K
from suarakit.functions.vectors import verdict
from suarakit.operators.neighbours import earlier_matches, nearest
from suarakit.session import materialise


def check_duplicates(
    batch: DataFrame,
    store: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    order_col: str | None = None,
    threshold: float = K.DUPLICATE_THRESHOLD,
    **search,
) -> DataFrame:
    """``id, is_duplicate, similarity_score, duplicate_of`` against the nearest stored row.

    A stored row with the same id is found like any other and then not counted as a
    duplicate; the next nearest is not looked at.
    """
    found = nearest(batch, store, id_col, vec_col, order_col, **search)
    v = verdict(F.col("similarity"), F.col("nearest_id"), F.col("id"), threshold)
    return found.select(F.col("id").alias(id_col), v.alias("v")).select(id_col, "v.*")


def numbered(
    df: DataFrame, id_col: str, vec_col: str, order_col: str, carry: Sequence[str] = ()
) -> DataFrame:
    """Arrivals ``key, id, vec`` and carried columns; keys rise along the order, then the id.

    The order may be of any type that sorts. Rows are dealt by ranges and written once, so a
    key belongs to one row for good, whether or not its id is unique or present.
    """
    rows = df.select(
        F.col(id_col).alias("id"), F.col(vec_col).alias("vec"), F.col(order_col).alias("ord"),
        *[F.col(c).alias(f"c_{c}") for c in carry],
    )
    rows = rows.repartitionByRange("ord", "id").sortWithinPartitions("ord", "id")
    return materialise(rows.withColumn("key", F.monotonically_increasing_id()).drop("ord"))


def _pass_over(rows: DataFrame) -> DataFrame:
    """Keys to keep of the rows ``key, id, earlier`` of one task, in one pass in key order."""
    schema = T.StructType([rows.schema["key"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, taken = set(), set()
        for batch in batches:
            fresh = []
            for key, id_, earlier in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if id_ not in taken and not any(k in kept for k in earlier or ()):
                    kept.add(key)
                    fresh.append(key)
                    if id_ is not None:
                        taken.add(id_)
            yield pa.RecordBatch.from_arrays([pa.array(fresh, pa.int64())], names=["key"])

    return rows.select("key", "id", "earlier").coalesce(1).sortWithinPartitions("key").mapInArrow(run, schema)


def _settled(undecided: DataFrame, edges: DataFrame, finish_at: int) -> DataFrame:
    """Keys kept among ``undecided`` (key, id), given all ``edges`` (u, v) from rows to earlier similar ones.

    Rounds on the edges alone: rows without an earlier undecided one that resembles them or has
    their id are kept; rows that resemble a kept one or have its id are dropped; edges to and from
    decided rows go. Once ``finish_at`` rows and edges or fewer are left, one task passes over them.
    """
    kept = []
    while True:
        # Rows that neither resemble nor share an id with others need no round.
        n, m = undecided.count(), edges.count()
        if n + m <= finish_at:
            earlier = edges.groupBy(F.col("u").alias("key")).agg(F.collect_list("v").alias("earlier"))
            kept.append(_pass_over(undecided.join(earlier, "key", "left")))
            return reduce(DataFrame.unionAll, kept)
        first = undecided.where("id is not null").groupBy(F.col("id").alias("i")).agg(F.min("key").alias("first"))
        joined = undecided.join(first, F.col("id") == F.col("i"), "left")
        ready = joined.where(F.coalesce(F.col("first") == F.col("key"), F.lit(True))).select("key", "id")
        fresh = materialise(ready.join(edges.select(F.col("u").alias("key")).distinct(), "key", "left_anti"))
        kept.append(fresh.select("key"))
        near = edges.join(fresh.select(F.col("key").alias("v")), "v").select(F.col("u").alias("key"))
        rest = undecided.join(fresh.select("key").unionAll(near).distinct(), "key", "left_anti")
        rest = materialise(rest.join(fresh.select(F.col("id").alias("taken")).distinct(), F.col("id") == F.col("taken"), "left_anti"))
        for end in ("u", "v"):
            edges = edges.join(rest.select(F.col("key").alias(end)), end, "left_semi")
        undecided, edges = rest, materialise(edges.select("u", "v"))


def _kept_keys(
    rows: DataFrame, threshold: float, edges_per_row: int = 64, finish_at: int = 1 << 20, **search
) -> DataFrame:
    """Keys of the rows that are stored when each meets those stored before it.

    Edges from rows to earlier similar ones are found once, and the rest happens on the edges. In
    crowded places edges grow with the square of the rows; so they are counted first, and while
    there are more than ``edges_per_row`` for each row, a round of vector search keeps the rows
    without an edge and drops what resembles them, which empties such places.
    """
    kept = []
    undecided = rows.select("key", "id", "vec")
    # Each row has at most as many edges as there are rows before it: no need to count few rows.
    n = most = undecided.count()
    while n > 2 * edges_per_row:
        near = materialise(earlier_matches(undecided, threshold, counts=True, **search).toDF("k", "n"))
        total = near.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        if total <= edges_per_row * most:
            break
        first = undecided.where("id is not null").groupBy(F.col("id").alias("i")).agg(F.min("key").alias("first"))
        waiting = undecided.join(near, F.col("key") == F.col("k"), "left").join(first, F.col("id") == F.col("i"), "left")
        waits = F.col("k").isNotNull() | F.coalesce(F.col("first") < F.col("key"), F.lit(False))
        split = materialise(waiting.select("key", "id", "vec", waits.alias("waits")))
        fresh, rest = split.filter("not waits").drop("waits"), split.filter("waits").drop("waits")
        kept.append(fresh.select("key"))
        options = dict(id_col="key", vec_col="vec", order_col="key", min_similarity=threshold, **search)
        free = nearest(rest, fresh, **options).filter("similarity IS NULL").select(F.col("id").alias("k"))
        taken = fresh.select(F.col("id").alias("i")).distinct()
        open_rows = rest.join(free, F.col("key") == F.col("k")).join(taken, F.col("id") == F.col("i"), "left_anti")
        undecided = materialise(open_rows.select("key", "id", "vec"))
        n = undecided.count()
    edges = materialise(earlier_matches(undecided, threshold, **search).toDF("u", "v"))
    kept.append(_settled(undecided.select("key", "id"), edges, finish_at))
    return reduce(DataFrame.unionAll, kept)


def first_come(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    order_col: str = "vec_id",
    threshold: float = K.DUPLICATE_THRESHOLD,
    **search,
) -> DataFrame:
    """Rows kept when each is compared, in order, with those kept before it."""
    rows = numbered(df, id_col, vec_col, order_col, df.columns)
    kept = rows.join(_kept_keys(rows, threshold, **search), "key", "left_semi")
    return kept.select(*[F.col(f"c_{c}").alias(c) for c in df.columns])


def split_arrivals(
    batch: DataFrame,
    store: DataFrame | None = None,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    order_col: str = "vec_id",
    threshold: float = K.DUPLICATE_THRESHOLD,
    carry: Sequence[str] = (),
    stored_ids: DataFrame | None = None,
    **search,
) -> tuple[DataFrame, DataFrame]:
    """Check-then-store in arrival order: a verdict for every row, and the rows to store.

    Each row is compared with the store and with the rows stored before it; only rows that
    are no duplicate are stored. A row whose id is stored already, by the store or by an
    earlier row of the batch, is checked but not stored again; rows without an id are told
    apart. There are as many verdicts as rows. ``store`` may be the part of a larger one that can
    matter to the batch; ``stored_ids`` then has the ids of all of it. ``search`` goes to :func:`nearest`, for
    instance ``method="lsh"``.
    """
    rows = numbered(batch, id_col, vec_col, order_col, carry)
    fresh, stored_best = rows, None
    # Decisions go by the options of the rounds, verdicts by those of the search.
    rounds = {k: search.pop(k) for k in ("edges_per_row", "finish_at") if k in search}
    if store is not None:
        seeds = store.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
        best = nearest(rows, seeds, "key", "vec", store_id_col="id", **search)
        stored_best = materialise(best.toDF("key", "s_sim", "s_id"))
        similar = F.coalesce(F.round("s_sim", 4) >= threshold, F.lit(False))
        known = seeds.select("id") if stored_ids is None else stored_ids.select(F.col(id_col).alias("id"))
        new = rows.join(known.distinct(), "id", "left_anti")
        fresh = new.join(stored_best.filter(~similar).select("key"), "key", "left_semi")
    keys = materialise(_kept_keys(fresh, threshold, **rounds, **search))
    kept = rows.join(keys, "key", "left_semi")
    candidates = kept.select("id", "vec", F.col("key").alias("ord"))
    found = nearest(
        rows, candidates, "key", "vec", "key", store_id_col="id", store_order_col="ord", **search
    ).withColumnRenamed("id", "key")
    if stored_best is not None:
        # Stored rows came first, so they win ties.
        older = F.col("s_sim").isNotNull() & (F.col("similarity").isNull() | (F.col("s_sim") >= F.col("similarity")))
        found = found.join(stored_best, "key").select(
            "key", F.when(older, F.col("s_sim")).otherwise(F.col("similarity")).alias("similarity"),
            F.when(older, F.col("s_id")).otherwise(F.col("nearest_id")).alias("nearest_id"),
        )
    v = verdict(F.col("similarity"), F.col("nearest_id"), F.col("id"), threshold)
    judged = rows.select("key", "id").join(found, "key").join(keys.withColumn("stored", F.lit(True)), "key", "left")
    verdicts = judged.select(
        F.col("id").alias(id_col), v.alias("v"), F.coalesce("stored", F.lit(False)).alias("is_stored")
    ).select(id_col, "v.*", "is_stored")
    stored = kept.select(
        F.col("id").alias(id_col), F.col("vec").alias(vec_col), *[F.col(f"c_{c}").alias(c) for c in carry]
    )
    return verdicts, stored


def deduplicate_arrivals(batch: DataFrame, store: DataFrame | None = None, *args, **options) -> DataFrame:
    """The verdicts of :func:`split_arrivals`: one row per arrival, plus ``is_stored``."""
    return split_arrivals(batch, store, *args, **options)[0]
