"""Mixing sources to target weights by entropy balancing.

Each document gets a rate: how often the mix takes each of its words on average. Among all
rates that meet every source's token target, the wanted ones stay closest, in relative entropy
weighted by tokens, to the base rates. They have the form min(cap, base * exp(tilt of source)),
and the tilts maximise a concave dual function; Newton's method finds them from sums over
documents. Rates are then rounded to whole copies so that every source keeps its target.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from suarakit.llm.common import column, small_batches, text_key, written


def token_count(text: Column) -> Column:
    """Number of words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def share_targets(sources: DataFrame, weights: tuple[float, ...] = (3, 1, 2), budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Add ``target`` to one row per source (``source``, ``source_size``).

    Weights repeat along the sources in code point order, null last. All targets together are
    ``budget`` times all tokens, as far as the cap of ``cap`` times the source allows: what a
    capped source can't take goes to the others by weight until none is above its cap.

    Sources reach their cap in the order of cap / weight, so the level at which the rest share
    follows from running sums in that order. The windows run over one row per source.
    """
    order = F.col("source").isNull(), "source"
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(*order)) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    everything = Window.partitionBy(F.lit(0))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    shared = (
        ranked.withColumn("total", F.lit(float(budget)) * F.sum("source_size").over(everything))
        .withColumn("full_before", F.coalesce(F.sum("most").over(by_ratio), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("full_before")) / F.col("weight_left"))
    )
    # The first source in this order that stays below its cap fixes the level of all after it.
    below = F.col("level") * F.col("weight") <= F.col("most")
    first = F.min(F.when(below, F.struct(F.col("most") / F.col("weight"), "rank", "level"))).over(everything)
    final = first["level"]
    target = F.when(F.col("source_size") == 0, 0.0).when(final.isNull(), F.col("most")).otherwise(F.least("most", final * F.col("weight")))
    return shared.withColumn("target_", target).select("source", "source_size", F.col("target_").alias("target"))


def newton_tilts(cells: DataFrame, targets: DataFrame, cap: float = 2.0, steps: int = 40, tolerance: float = 1e-9) -> DataFrame:
    """The tilt of each source from its cells (``source``, ``base``, ``tokens``) and ``target``.

    Documents of one source and base rate have one rate, so the sums over documents that
    Newton's method needs are sums over cells. Every step is a distributed sum by source of
    the gradient (tokens taken less the target) and the curvature (tokens taken below the cap),
    for all sources at once. A step that would cross a kink is kept inside the bracket known so far.
    """
    state = targets.withColumn("tilt", F.lit(0.0)).withColumn("low", F.lit(-60.0)).withColumn("high", F.lit(60.0))
    cells = written(cells, "cells")
    for step in range(steps):
        rate = F.col("base") * F.exp("tilt")
        taken = F.col("tokens") * F.least(F.lit(float(cap)), rate)
        bent = F.when(rate < cap, F.col("tokens") * rate).otherwise(0.0)
        joined = cells.join(state, cells["source"].eqNullSafe(state["source"])).drop(cells["source"])
        sums = joined.groupBy("source", "target", "source_size", "tilt", "low", "high").agg(F.sum(taken).alias("g"), F.sum(bent).alias("h"))
        gap = F.col("g") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - gap / F.col("h")
        inside = (F.col("h") > 0) & (newton > F.col("low_")) & (newton < F.col("high_"))
        done = F.abs(gap) <= tolerance * F.greatest(F.col("target"), F.lit(1.0))
        moved = (
            sums.withColumn("low_", low)
            .withColumn("high_", high)
            .withColumn("done", done)
            .withColumn("tilt_", F.when(F.col("done"), F.col("tilt")).when(inside, newton).otherwise((F.col("low_") + F.col("high_")) / 2))
            .select("source", "target", "source_size", F.col("tilt_").alias("tilt"), F.col("low_").alias("low"), F.col("high_").alias("high"), "done")
        )
        moved = written(moved, "tilts")
        state = moved.drop("done")
        if moved.where(~F.col("done")).isEmpty():
            break
    return state


def _diffuse(sizes: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """Whole copies, the rate rounded down or up, so that tokens taken follow the rates.

    Sizes come in falling order: each document takes the copy that brings the running total
    nearer to what the rates ask, and the small ones at the end even out what is left.
    """
    copies = np.floor(rates + 1e-9).astype(np.int64)
    part = np.maximum(rates - copies, 0.0)
    owed = 0.0
    for i in np.flatnonzero(part > 1e-9):
        owed += part[i] * sizes[i]
        if 2 * owed >= sizes[i]:
            copies[i] += 1
            owed -= sizes[i]
    return copies


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[float, ...] = (3, 1, 2),
    budget: float = 1.5,
    cap: float = 2.0,
    base: Column | None = None,
    group_rows: int = 2048,
) -> DataFrame:
    """How much of each document the mix takes: id, key, source, size, source_size, target, rate, copies, taken.

    ``base`` (default 1) is a column of ``docs`` with the rate before balancing. Rounding works
    in groups of about ``group_rows`` documents dealt by a hash, however large a source is and
    however many rows are equal, so
    a source misses its target by a few of its smallest documents per group; the outcome depends
    on the rows alone, not on their order or partitions. A source of no words has target 0.
    Documents without words, null texts included, are taken as often as their rate rounds to,
    which is no words. Null sources form one source; equal rows share a rate and may differ in
    copies by one. No rows give no rows.
    """
    small_batches(docs.sparkSession)
    text = column(docs, text_column).cast("string")
    rate = F.lit(1.0) if base is None else F.coalesce(base.cast("double"), F.lit(0.0))
    sized = written(
        docs.select(
            column(docs, id_column).alias("id"),
            text_key(text).alias("key"),
            column(docs, source_column).cast("string").alias("source"),
            token_count(text).alias("size"),
            rate.alias("base"),
        ),
        "sized",
    )
    # Equal rows are counted, and dealt out again in runs that may go to different groups.
    alike = sized.groupBy(*sized.columns).agg(F.count(F.lit(1)).alias("alike"))
    alike = alike.withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("alike") - 1) / group_rows))))
    in_run = F.least(F.lit(group_rows), F.col("alike") - F.col("run") * group_rows).cast("int")
    dealt = alike.withColumn("one", F.explode(F.sequence(F.lit(1), in_run))).drop("alike", "one")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    sources = written(sources, "sources")
    targets = share_targets(sources.drop("rows"), weights, budget, cap)
    cells = sized.groupBy("source", "base").agg(F.sum("size").cast("double").alias("tokens"))
    tilts = newton_tilts(cells, targets, cap)
    tilts = tilts.join(sources.select(F.col("source").alias("s"), "rows"), F.col("source").eqNullSafe(F.col("s")))
    tilts = written(
        tilts.select(F.col("source").alias("s"), "source_size", "target", "tilt", F.ceil(F.col("rows") / group_rows).alias("groups")),
        "balanced",
    )
    rated = dealt.join(tilts, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rated = rated.withColumn("rate", F.least(F.lit(float(cap)), F.col("base") * F.exp("tilt")))
    rated = rated.withColumn("bucket", F.pmod(F.xxhash64("id", "key", "run", F.lit("mix")), F.col("groups")))

    def round_group(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("size", "descending"), ("id", "ascending"), ("key", "ascending")])
        sizes = rows["size"].to_numpy()
        copies = _diffuse(sizes.astype(np.float64), rows["rate"].to_numpy())
        return rows.append_column("copies", pa.array(copies)).append_column("taken", pa.array(copies * sizes))

    rated = rated.select("id", "key", "source", "size", "source_size", "target", "rate", "bucket")
    added = StructType.fromDDL("copies bigint, taken bigint").fields
    return rated.groupBy("source", "bucket").applyInArrow(round_group, StructType([*rated.schema, *added])).drop("bucket")


def cross_balance(
    cells: DataFrame, margins: dict[str, dict], cap: float = 2.0, steps: int = 60, tolerance: float = 1e-8
) -> DataFrame:
    """``cells`` (``base``, ``tokens``, and the columns of ``margins``) with the rate that meets targets cutting across each other.

    ``margins`` gives for each column (say source, language, length band) the tokens wanted of
    some of its values. Of all rates that meet them the ones nearest to the base rates in
    relative entropy are min(cap, base * exp(sum of the tilts of a cell's values)). The tilts
    are a vector: each Newton step is one job that sums, over all cells, the gradient and the
    curvature between every two values that share cells; with a cap, and where targets can't
    all be met, damped steps end at the best compromise. A value without a target has no tilt. The
    driver has the tilts and the curvature, as wide as there are targets; it never sees cells.
    """
    spark = small_batches(cells.sparkSession)
    names = [(column_, value) for column_, wanted in margins.items() for value in wanted]
    targets = np.array([float(margins[c][v]) for c, v in names])
    place = {name: i for i, name in enumerate(names)}
    tilts, size = np.zeros(len(names)), len(names)
    wide = [cells[c] for c in margins]
    given = written(cells.select(*wide, "base", "tokens"), "crossed")
    columns = list(margins)

    def members(batch: pa.RecordBatch) -> np.ndarray:
        """One column for each margin: the place of the cell's value, or ``size`` if it has no target."""
        return np.stack([[place.get((c, v), size) for v in batch.column(i).to_pylist()] for i, c in enumerate(columns)], axis=1).reshape(-1, len(columns))

    def sums_at(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, int], float] = {}
            potential = 0.0
            for batch in batches:
                if not batch.num_rows:
                    continue
                of = members(batch)
                tilt = np.append(shared.value, 0.0)[of].sum(axis=1)
                base, tokens = batch.column(len(columns)).to_numpy(), batch.column(len(columns) + 1).to_numpy()
                rate = base * np.exp(np.clip(tilt, -60, 60))
                free = rate < cap
                taken = tokens * np.where(free, rate, cap)
                # The conjugate of the entropy: linear beyond the cap.
                potential += float((tokens * np.where(free, rate, cap * (1 + np.log(np.maximum(rate, 1e-300) / cap)))).sum())
                for i in range(len(columns)):
                    for key, n in zip(*_summed(of[:, i], taken)):
                        held[key, -1] = held.get((key, -1), 0.0) + n
                    for j in range(len(columns)):
                        for key, n in zip(*_summed(of[:, i] * (size + 1) + of[:, j], np.where(free, taken, 0.0))):
                            at = divmod(key, size + 1)
                            held[at] = held.get(at, 0.0) + n
            held[-1, -1] = potential
            rows = list(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([held[r] for r in rows], pa.float64())],
                names=["i", "j", "n"],
            )

        return run

    def evaluate(at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        shared = spark.sparkContext.broadcast(at)
        sums = given.mapInArrow(sums_at(shared), "i int, j int, n double").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
        taken, bend, potential = np.zeros(size), np.zeros((size, size)), 0.0
        for i, j, n in sums:
            if i == j == -1:
                potential = n
            elif i < size and j == -1:
                taken[i] = n
            elif i < size and j < size:
                bend[i, j] = n
        return potential - targets @ at, taken - targets, bend

    value, slope, bend = evaluate(tilts)
    for _ in range(steps):
        if np.abs(slope).max(initial=0.0) <= tolerance * max(1.0, targets.max(initial=0.0)):
            break
        # Margins of the same tokens are not independent: a small ridge picks one of the equal solutions.
        ridge = 1e-9 * max(1.0, np.trace(bend) / max(1, size))
        step = np.linalg.solve(bend + ridge * np.eye(size), slope)
        step *= min(1.0, 4.0 / max(1e-300, np.abs(step).max()))
        share = 1.0
        while share > 1e-6:
            ahead = evaluate(tilts - share * step)
            if ahead[0] <= value - 1e-4 * share * (slope @ step) + 1e-12 * abs(value):
                break
            share /= 2
        else:
            break
        tilts = tilts - share * step
        value, slope, bend = ahead
    shared = spark.sparkContext.broadcast(tilts)

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tilt = np.append(shared.value, 0.0)[members(batch)].sum(axis=1) if batch.num_rows else np.zeros(0)
            rate = np.minimum(cap, batch.column(len(columns)).to_numpy() * np.exp(np.clip(tilt, -60, 60)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], names=[*batch.schema.names, "rate"])

    return given.mapInArrow(rated, StructType([*given.schema.fields, *StructType.fromDDL("rate double").fields]))


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[float]]:
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct.tolist(), np.bincount(at, values, len(distinct)).tolist()
