"""Incremental intake of crawled records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suarakit import constants as K
from suarakit.operators.quality import keep_first


def new_records(batch: DataFrame, store: DataFrame, order: str, id_col: str = "id") -> DataFrame:
    """First record per id that the store does not hold yet.

    A missing id counts as an ordinary id: one such record is accepted, ever. Ids of any type
    are compared by how they print, so a store that keeps them otherwise still knows them. NULL is
    split into a value and a flag, so that de-duplication and anti-join share one shuffle, and a
    hot id is down to one row before the join.
    """

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {"_key": F.coalesce(F.col(id_col).cast("string"), F.lit("")), "_null": F.col(id_col).isNull()}
        )

    first = keep_first(keyed(batch), ["_key", "_null"], order)
    known = keyed(store.select(id_col)).select("_key", "_null").distinct()
    return first.join(known, ["_key", "_null"], "left_anti").drop("_key", "_null")


def ingest(batch: DataFrame, store: DataFrame, order: str, id_col: str = "id") -> DataFrame:
    """Store plus the new records of the batch."""
    return store.unionByName(
        new_records(batch, store, order, id_col), allowMissingColumns=True
    )


def empty_streak_cut(log: DataFrame, streak: int = K.EMPTY_PAGES_TO_STOP) -> DataFrame:
    """Crawl-log rows a crawler would have visited before giving up.

    ``log`` holds rows of ``source`` and consecutive ``page`` numbers; a page that a resumed
    crawl logged again counts once, and as empty if it was empty every time. A source ends at
    the page completing its first run of ``streak`` empty pages. Each empty page votes for
    the ``streak`` pages it could help to complete; a page with all votes completes a run.
    Votes aggregate by (source, page), so a long source is never sorted in one task.
    """
    distinct = log.groupBy("source", "page").agg(F.max("n_links").alias("n_links"))
    votes = distinct.filter(F.col("n_links") == 0).select(
        "source", F.explode(F.sequence("page", F.col("page") + (streak - 1))).alias("page")
    )
    cuts = (
        votes.groupBy("source", "page")
        .count()
        .filter(F.col("count") == streak)
        .groupBy("source")
        .agg(F.min("page").alias("cut_page"))
    )
    return (
        log.join(cuts, "source", "left")
        .filter(F.col("cut_page").isNull() | (F.col("page") <= F.col("cut_page")))
        .select("source", "page", "n_links", "cut_page")
    )
