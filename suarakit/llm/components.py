"""Connected components of an edge table, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suarakit.llm.common import written


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (``a``, ``b``: bigint): the smallest node it is linked to.

    Alternates two kinds of rewiring: every node hands its larger neighbours to the smallest
    one it knows, then does the same with its smaller ones. Edges never multiply, long chains
    halve, and the loop ends when each component is a star around its smallest node. Sums of
    edges are combined before each shuffle; a node of many edges is a skewed join key, which
    adaptive execution splits. Loops and repeated edges do no harm, no edges give no rows.
    """
    state = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = None
    for _ in range(rounds):
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        state = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
