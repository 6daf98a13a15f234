"""Dictionaries as tables against the inlined ones, and against brute force."""

import random
import time

import pytest
from pyspark.sql import functions as F

from suarakit import constants as K
from suarakit.functions.category import first_keyword as inlined
from suarakit.functions.text import expand_slang
from suarakit.operators import dictionaries as D


def keyword_rows(words):
    return [(i, w, v) for i, (w, v) in enumerate(words)]


def test_equals_the_chain_on_the_present_list(spark):
    rng = random.Random(1)
    keys = list(K.CATEGORY_KEYWORDS)
    texts = [" ".join(rng.choice([*keys, "persampahan", "universitas", "xx", "é"]) for _ in range(rng.randrange(6))) for _ in range(300)] + [None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "value int, t string").repartition(3)
    words = spark.createDataFrame(keyword_rows(K.CATEGORY_KEYWORDS.items()), "rank int, word string, value string")
    wanted = {r.value: r.w for r in df.select("value", inlined(F.col("t"), K.CATEGORY_KEYWORDS, F.lit(None).cast("string")).alias("w")).collect()}
    for limit in (D.BROADCAST_BYTES, 300):
        got = {r.value: r.topic for r in D.first_keyword(df, "t", words, "topic", limit).collect()}
        assert got == wanted


def test_ranks_repeats_and_empty_words(spark):
    words = spark.createDataFrame([(3, "ab", "x"), (1, "b", None), (2, "a", "y"), (1, "c", "z"), (9, "", "all"), (0, None, "no"), (5, "ab", "later")], "rank int, word string, value string")
    df = spark.createDataFrame([(1, "ab"), (2, "a"), (3, "q"), (4, None), (5, "cb")], "i int, t string")
    for limit in (D.BROADCAST_BYTES, 100):
        got = {r.i: r.value for r in D.first_keyword(df, "t", words, broadcast_bytes=limit).collect()}
        assert got == {1: None, 2: "y", 3: "all", 4: None, 5: None}
    assert D.first_keyword(df, "t", words.limit(0)).where("value is not null").count() == 0
    replaced = D.first_keyword(df, "t", words, out="t")
    assert replaced.columns == ["i", "t"] and {r.i: r.t for r in replaced.collect()}[2] == "y"


def test_time_does_not_follow_the_number_of_keywords(spark):
    df = spark.range(20_000).select(F.concat_ws(" ", F.md5(F.col("id").cast("string")), F.lit("jalan rusak")).alias("t")).repartition(4).cache()
    df.count()
    times = []
    for n in (100, 100_000):
        words = spark.range(n).select((F.col("id") + 1).alias("rank"), F.sha2(F.col("id").cast("string"), 256).alias("word"), F.lit("no").alias("value"))
        words = words.unionByName(spark.createDataFrame([(10**9, "rusak", "yes")], "rank long, word string, value string"))
        D.first_keyword(df, "t", words).count()
        start = time.perf_counter()
        assert D.first_keyword(df, "t", words).where("value = 'yes'").count() == 20_000
        times.append(time.perf_counter() - start)
    assert times[1] < 10 * times[0] + 5, times


@pytest.mark.parametrize("limit", [D.BROADCAST_BYTES, 0])
def test_words_as_the_inlined_dictionary(spark, limit):
    rng = random.Random(2)
    slang = list(K.SLANG)
    pick = lambda: rng.choice([*slang, "kata", "É", "İ", "(", "x,y"])
    texts = ["  ".join(rng.choice(["", "(", ",", "!!"]) + rng.choice([str.upper, str.lower])(pick()) + rng.choice(["", ".", ")", "?"]) for _ in range(rng.randrange(9))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "", "   ", "\n yg \t tdk"])], "long int, t string").repartition(3)
    dictionary = spark.createDataFrame(list(K.SLANG.items()), "word string, long string")
    wanted = sorted((r.long, r.w) for r in df.select("long", expand_slang(F.col("t")).alias("w")).collect() if r.w is not None)
    found = D.expand_words(df, "t", dictionary, limit)
    assert found.columns == df.columns
    assert sorted((r.long, r.t) for r in found.collect() if r.t is not None) == wanted


@pytest.mark.parametrize("limit", [D.BROADCAST_BYTES, 0])
def test_a_million_entries(spark, limit):
    df = spark.createDataFrame([(i, f"w{i * 3}, yg (W{i + 5})") for i in range(50)], "i int, t string")
    entries = spark.range(1_000_000).select(F.concat(F.lit("w"), "id").alias("word"), F.concat(F.lit("long"), "id").alias("long"))
    got = {r.i: r.t for r in D.expand_words(df, "t", entries, limit).collect()}
    assert got == {i: f"long{i * 3}, yg (long{i + 5})" for i in range(50)}
