import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from suarakit.llm import winnowing
from tests.llm import fixtures

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def expected(text, items):
    words = WORD.findall(fixtures.lower(text))
    hit, found = set(), set()
    for item_id, item in items:
        theirs = WORD.findall(fixtures.lower(item))
        size = min(13, len(theirs))
        windows = {tuple(theirs[i : i + size]) for i in range(len(theirs) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add("null" if item_id is None else str(item_id))
    return len(words), len(hit), len(found), ",".join(sorted(found))


def benchmark(given):
    rng = random.Random(3)
    long = [t for t in given if t and len(t.split()) > 40]
    cut = [" ".join(t.split()[5 : 5 + n]) for t, n in zip(long, (13, 14, 30, 12, 7, 6, 3, 1))]
    return [(i, t) for i, t in enumerate(cut)] + [
        (20, "the the the the the the the the the the the the the the"),
        (21, fixtures.sentence(rng, 40)),
        (22, None),
        (23, ""),
        (None, cut[0]),
        (24, cut[0].upper()),
        (24, "one"),
    ]


def test_matches_brute_force(spark):
    given = fixtures.texts() + ["the " * 40, "well the the the"]
    items = benchmark(given)
    docs = fixtures.documents(spark, given)
    found = winnowing.decontaminate(docs, spark.createDataFrame(items, "item_id bigint, text string"))
    rows = found.select("id", "n_words", "n_hit", "n_items", F.concat_ws(",", "items")).collect()
    wanted = [(r[0], *expected(r[1], items)) for r in fixtures.rows(given)]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, wanted))
    assert sum(r[2] > 0 for r in wanted) > 8


@pytest.mark.parametrize("k", [1, 4, 13])
def test_any_gram_length(spark, k):
    given = fixtures.texts(11, 25)
    items = benchmark(given)
    found = winnowing.decontaminate(
        fixtures.documents(spark, given), spark.createDataFrame(items, "item_id bigint, text string"), k=k
    )
    wanted = [expected(r[1], items)[1] for r in fixtures.rows(given)]
    assert sorted(r[0] for r in found.select("n_hit").collect()) == sorted(wanted)


def test_nothing_in_nothing_out(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert winnowing.decontaminate(fixtures.nothing(spark), items).count() == 0
    docs = fixtures.documents(spark)
    found = winnowing.decontaminate(docs, items.where("false"))
    assert found.count() == docs.count() and found.where("n_hit > 0 or n_items > 0").isEmpty()


def test_query_digest(spark, sf_dir):
    from suarakit.llm.queries import QUERIES

    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op2_winnowing"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n_words, n_hit, n_items, names = expected(texts[r.doc_id], items)
        digest = hashlib.sha256(names.encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n_words, n_hit, n_items, digest)
        assert r.contaminated == (n_hit > 0 and 20 * n_hit >= n_words)
