import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from suarakit.llm import treeweighting as tree
from tests.llm import fixtures


def reference_log2(training, text, depth):
    """Context-tree weighting by the book: sequential counts, recursive mixing, no pruning."""
    from functools import cache

    counts = Counter()
    for t in training:
        line = [255] * depth + list(t) + [254]
        for i in range(depth, len(line)):
            for bit in range(8):
                node, value = (line[i] >> (8 - bit)) | (1 << bit), line[i] >> (7 - bit) & 1
                for d in range(depth + 1):
                    counts[node, tuple(line[i - d : i]), value] += 1

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    children = {}
    for node, context, _ in counts:
        if context:
            children.setdefault((node, context[1:]), set()).add(context)

    @cache
    def weighted(node, context):
        own = kt(counts[node, context, 0], counts[node, context, 1])
        below = children.get((node, context))
        if not below:
            return own
        return np.logaddexp(math.log(0.5) + own, math.log(0.5) + sum(weighted(node, c) for c in below))

    def one(node, line, i, d):
        context = tuple(line[i - d : i])
        a, b = counts[node, context, 0], counts[node, context, 1]
        p = (b + 0.5) / (a + b + 1)
        if d == depth or (node, context) not in children:
            return p
        share = math.exp(math.log(0.5) + kt(a, b) - weighted(node, context))
        return share * p + (1 - share) * one(node, line, i, d + 1)

    line, total = [255] * depth + list(text) + [254], 0.0
    for i in range(depth, len(line)):
        for bit in range(8):
            p = one((line[i] >> (8 - bit)) | (1 << bit), line, i, 0)
            total += math.log2(p if line[i] >> (7 - bit) & 1 else 1 - p)
    return total


def test_scores_match_the_book(spark):
    training = ["abracadabra", "abra abra", "the cat", "über", "", "abracadabra"]
    texts = ["abracadabra", "cab", "", "zzz", "über the"]
    for depth in (0, 1, 3):
        model, words = tree.learn(spark.createDataFrame([(t,) for t in training], "text string"), depth=depth)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        for r in tree.score(docs, model, words).collect():
            wanted = reference_log2([t.encode() for t in training], texts[r.id].encode(), depth) * math.log10(2)
            # A context without children of a node is a leaf of its tree here and there alike.
            assert r.score == pytest.approx(wanted, rel=2e-3, abs=2e-3), (depth, texts[r.id])


def test_next_bytes_add_up_to_one(spark):
    given = [t for t in fixtures.texts() if t]
    model, _ = tree.learn(spark.createDataFrame([(t,) for t in given], "text string"), most_contexts=300)
    assert len(model.table) == 300
    assert np.allclose((10.0 ** model.table.astype(np.float64)).sum(axis=1), 1, atol=1e-4)


def base_scores(rows, training):
    tokens = lambda t: [w for w in fixtures.lower(t).translate({c: 32 for c in range(9, 14)}).split(" ") if w] + [0]
    counts = Counter(w for t in training for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        own = tokens(t)
        out.append((i, len(own), sum(counts[w] > 0 for w in own), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), 6)))
    return out


@pytest.mark.parametrize("most_words", [1 << 20, 20])
def test_base_scores_match_brute_force(spark, most_words):
    given = fixtures.texts()
    docs = fixtures.documents(spark, given)
    aside = tree.held_out(F.col("doc_id"), 7, 2)
    rows = [(r[0], r[1]) for r in fixtures.rows(given)]
    import zlib

    training = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    model, words = tree.learn(docs.where(~aside), most_words=most_words, most_contexts=500)
    got = tree.score(docs, model, words).select("id", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, base_scores(rows, training)))


def test_nothing_learnt_or_scored(spark):
    docs = fixtures.documents(spark)
    model, words = tree.learn(fixtures.nothing(spark))
    out = tree.score(docs, model, words)
    assert out.count() == docs.count() and out.where("n_known > 0").isEmpty()
    byte = out.where("n_tokens = 1").select("score").distinct().collect()
    assert byte[0][0] == pytest.approx(-8 * math.log10(2), rel=1e-5)
    assert tree.score(fixtures.nothing(spark), model, words).count() == 0


def test_held_out_text_compresses(spark, sf_dir):
    from suarakit.llm.queries import QUERIES

    out = QUERIES["op6_context_tree"](spark, sf_dir)
    rows = {r.held_out: r for r in out.groupBy("held_out").agg(F.avg("bits_per_byte").alias("bits"), F.count("*").alias("n")).collect()}
    # Letters by frequency alone take more than four bits.
    assert rows[True].bits < 3 and rows[False].bits <= rows[True].bits


@pytest.mark.parametrize("most", [1, 40])
def test_contexts_that_are_not_looked_up_score_as_by_the_book(spark, most):
    training = ["abracadabra", "abra abra", "the cat sat", "über", "", "a much rarer text, seen once"]
    texts = ["abracadabra", "a much rarer", "", "zzz", "über the cat", "once"]
    docs = spark.createDataFrame([*enumerate(texts), (0, texts[0])], "doc_id bigint, text string")
    for depth in (2, 5):
        rows = spark.createDataFrame([(t,) for t in training], "text string")
        model, words = tree.learn(rows, depth=depth, most_contexts=most, most_codes=most)
        got = tree.score(docs, model, words).collect()
        assert len(got) == len(texts) + 1 and len(model.codes) == most
        for r in got:
            wanted = reference_log2([t.encode() for t in training], texts[r.id].encode(), depth) * math.log10(2)
            assert r.score == pytest.approx(wanted, rel=1e-5, abs=1e-5), (depth, texts[r.id])
