"""Following links from list pages to stored pages, as a crawler would, over tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from suarakit import constants as K
from suarakit.operators.ingest import empty_streak_cut
from suarakit.session import materialise


def reachable(seeds: DataFrame, edges: DataFrame, most_steps: int = 1000) -> DataFrame:
    """``page, depth``: pages that can be reached from ``seeds`` (page), seeds included, and in how many steps.

    ``edges`` are ``src, dst``. Each step joins the pages found last with their links and keeps
    those not found before; it ends with the step that finds nothing. Pages and links are
    numbers or addresses, never texts.
    """
    edges = materialise(edges.where("src is not null and dst is not null and src <> dst").distinct())
    last = materialise(seeds.where("page is not null").select("page").distinct().withColumn("depth", F.lit(0)))
    found = last
    for depth in range(1, most_steps + 1):
        if last.isEmpty():
            break
        ahead = edges.join(last.select(F.col("page").alias("src")), "src", "left_semi").select(F.col("dst").alias("page")).distinct()
        last = materialise(ahead.join(found.select("page"), "page", "left_anti").withColumn("depth", F.lit(depth)))
        # A plan of one step on top of a table, however many steps there were.
        found = materialise(found.unionAll(last))
    return found


def reachable_by_address(seeds: DataFrame, links: DataFrame, names: DataFrame, most_steps: int = 1000) -> DataFrame:
    """As :func:`reachable`, for ``links`` (page, address) that lead to all pages with that address in ``names``.

    An address is followed once, however many pages link to it, and however many have it: links and
    pages are never paired, so the work follows their number and not their product.
    """
    last = materialise(seeds.where("page is not null").select("page").distinct().withColumn("depth", F.lit(0)))
    found, followed = last, None
    for depth in range(1, most_steps + 1):
        if last.isEmpty():
            break
        ahead = links.join(last.select("page"), "page", "left_semi").select("address").distinct()
        if followed is not None:
            ahead = ahead.join(followed, "address", "left_anti")
        ahead = materialise(ahead)
        followed = ahead if followed is None else materialise(followed.unionAll(ahead))
        pages = names.join(ahead, "address", "left_semi").select("page").distinct()
        last = materialise(pages.join(found.select("page"), "page", "left_anti").withColumn("depth", F.lit(depth)))
        found = materialise(found.unionAll(last))
    return found


def list_pages_to_visit(log: DataFrame, streak: int = K.EMPTY_PAGES_TO_STOP) -> DataFrame:
    """Rows of a crawl log ``source, page, n_links, url`` before each source's first run of pages without links."""
    cut = empty_streak_cut(log.select("source", "page", "n_links"), streak).select("source", "page").distinct()
    return log.join(cut, ["source", "page"], "left_semi")


def follow(
    links: DataFrame,
    pages: DataFrame,
    is_list: Column,
    source: Column,
    number: Column,
    streak: int = K.EMPTY_PAGES_TO_STOP,
) -> DataFrame:
    """``page, depth`` of the stored pages that a crawl from the list pages comes to.

    ``pages`` has ``page`` and ``address``, ``links`` has ``page`` and the ``address`` it points
    to; links to pages that are not stored lead nowhere. A source's list pages are read in the order
    of ``number`` until ``streak`` of them in a row have no link to a stored page.
    """
    names = materialise(pages.where("address is not null").select("address", "page").distinct())
    known = names.select("address").distinct()
    links = materialise(links.select("page", "address").distinct().join(known, "address", "left_semi"))
    listed = pages.where(is_list).select(source.alias("source"), number.alias("number"), "page")
    # Addresses count, not the pages that have them: a list page is empty if it has none.
    counted = listed.join(links.groupBy("page").agg(F.count("*").alias("n_links")), "page", "left")
    ordered = counted.withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    log = ordered.select("source", F.col("number").alias("page"), "n_links", F.col("page").alias("url"))
    seeds = list_pages_to_visit(log, streak).select(F.col("url").alias("page"))
    ways = [df.where("page is not null") for df in (links, names)]
    return reachable_by_address(seeds, *ways)
