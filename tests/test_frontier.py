"""Following links over tables against a crawler in memory."""

import random

from pyspark.sql import functions as F

from suarakit.operators import frontier


def walk(seeds, edges):
    depth, last, step = {s: 0 for s in seeds}, set(seeds), 0
    while last:
        step += 1
        last = {d for s, d in edges if s in last} - depth.keys()
        depth |= {d: step for d in last}
    return depth


def test_reachable_equals_a_walk(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(230)] + [(5, 5), (1, 2), (1, 2)] + [(300 + i, 301 + i) for i in range(12)]
    seeds = [1, 7, 7, 300]
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "src long, dst long").repartition(4)
    found = frontier.reachable(spark.createDataFrame([(s,) for s in [*seeds, None]], "page long"), df)
    rows = found.collect()
    assert len(rows) == len({r.page for r in rows})
    assert {r.page: r.depth for r in rows} == walk(seeds, edges)
    assert frontier.reachable(spark.createDataFrame([], "page long"), df).count() == 0
    assert {r.page for r in frontier.reachable(spark.createDataFrame([(300,)], "page long"), df, most_steps=2).collect()} == {300, 301, 302}


def test_follow_stops_a_source_after_empty_pages(spark):
    # Source a has links on pages 1 and 6, but pages 2 to 4 have none: page 6 is never read.
    pages = [(f"a{i}", f"/a{i}", "a", i) for i in range(1, 8)] + [(f"b{i}", f"/b{i}", "b", i) for i in range(1, 4)]
    pages += [(x, f"/{x}", None, None) for x in ("one", "two", "three", "deep", "lost")]
    links = [("a1", "/one"), ("a1", "/gone"), ("a6", "/lost"), ("b1", "/two"), ("b3", "/three"), ("two", "/deep"), ("deep", "/two"), ("b2", None)]
    p = spark.createDataFrame(pages, "page string, address string, source string, number int")
    ln = spark.createDataFrame(links, "page string, address string")
    found = frontier.follow(ln, p, F.col("source").isNotNull(), F.col("source"), F.col("number"))
    got = {r.page: r.depth for r in found.collect()}
    assert got == {"a1": 0, "a2": 0, "a3": 0, "a4": 0, "b1": 0, "b2": 0, "b3": 0, "one": 1, "two": 1, "three": 1, "deep": 2}


def test_links_and_pages_of_one_address_are_not_paired(spark, monkeypatch):
    """Before, each of the 300 links made a row for each of the 300 pages that answer to it."""
    pages = [(f"a{i}", f"/list{i}", "a", i) for i in range(300)] + [(f"x{i}", "/same", None, None) for i in range(300)]
    pages += [("y", "/y", None, None), (None, "/y", None, None)]
    links = [(f"a{i}", "/same") for i in range(300)] + [("x7", "/y"), ("y", "/same"), ("y", "/list3"), (None, "/y")]
    p = spark.createDataFrame(pages, "page string, address string, source string, number int")
    ln = spark.createDataFrame(links * 2, "page string, address string")
    sizes, plain = [], frontier.materialise
    monkeypatch.setattr(frontier, "materialise", lambda df: (sizes.append((out := plain(df)).count()), out)[1])
    found = frontier.follow(ln, p, F.col("source").isNotNull(), F.col("source"), F.col("number")).collect()
    assert len(found) == 601
    assert {r.page: r.depth for r in found} == {f"a{i}": 0 for i in range(300)} | {f"x{i}": 1 for i in range(300)} | {"y": 2}
    assert max(sizes) <= len(pages)
