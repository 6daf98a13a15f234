import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from suarakit.llm import arrays, languages
from suarakit.llm.treeweighting import held_out
from tests.llm import fixtures


def mixture_by_hand(likelihood, steps):
    shares = np.full(likelihood.shape[1], 1 / likelihood.shape[1])
    for _ in range(steps):
        weighted = likelihood * shares
        shares = (weighted / weighted.sum(axis=1, keepdims=True)).mean(axis=0)
    return shares


def test_em_matches_one_text_at_a_time():
    rng = np.random.default_rng(3)
    likelihood = rng.random((40, 3)).astype(np.float32)
    first = np.array([0, 10, 10, 39, 40])
    shares, _ = languages._mixture(likelihood, first, np.full((4, 3), 1 / 3), 6)
    for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
        if b > a:
            assert np.allclose(shares[i], mixture_by_hand(likelihood[a:b].astype(float), 6), atol=1e-5)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    aside = held_out(F.col("doc_id"), 4, 2)
    out = languages.identify(docs, languages.learn(docs.where(~aside))).where(held_out(F.col("id"), 4, 2))
    joined = out.join(docs, F.col("id") == F.col("doc_id"))
    right = joined.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.95 and 0 <= right[1] and right[2] <= 1


def test_mixed_text_has_two_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    model = languages.learn(docs)
    long = {r.lang: r.text for r in docs.where("n_chars between 1500 and 4000").orderBy("doc_id").collect()}
    texts = [long["en"], long["de"], long["en"][:1500] + " " + long["de"][:1500]]
    chosen, _, _ = languages.infer(next(arrays.pieces(pa.array(texts))), model)
    sets = [{model.languages[j] for j in np.flatnonzero(c > 0.05)} for c in chosen]
    assert sets == [{"en"}, {"de"}, {"en", "de"}] and np.allclose(chosen.sum(axis=1), 1)


def test_awkward_rows(spark):
    docs = fixtures.documents(spark)
    model = languages.learn(docs)
    assert model.languages == ["de", "en"]
    out = languages.identify(docs, model)
    assert out.count() == docs.count()
    joined = out.join(docs.select("doc_id", F.col("text").alias("t")).distinct(), (F.col("id") == F.col("doc_id")) & F.xxhash64("t").eqNullSafe(F.col("key")))
    bad = joined.where((F.col("lang_pred") == "und") != F.coalesce(~F.col("t").rlike(r"\p{L}"), F.lit(True)))
    assert bad.isEmpty()
    assert languages.identify(fixtures.nothing(spark), model).count() == 0
    blank = languages.learn(docs.where("false"))
    assert languages.identify(docs, blank).where("lang_pred <> 'und' or score <> 0").isEmpty()


def test_result_ignores_neighbours(spark):
    docs = fixtures.documents(spark)
    model = languages.learn(docs)
    a = sorted(map(repr, languages.identify(docs.repartition(1), model).select("id", "key", "lang_pred", F.round("score", 4)).collect()))
    b = sorted(map(repr, languages.identify(docs.repartition(8), model).select("id", "key", "lang_pred", F.round("score", 4)).collect()))
    assert a == b
