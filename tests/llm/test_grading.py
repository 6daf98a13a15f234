import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from suarakit.llm import arrays, grading
from tests.llm import fixtures


def test_loss_slopes_match_differences():
    rng = np.random.default_rng(0)
    latent, grades, weight = rng.normal(size=50), rng.integers(0, 4, 50), rng.random(50)
    thresholds = np.array([-1.0, 0.2, 1.5])
    _, by_latent, by_threshold = grading._loss(latent, grades, thresholds, weight)
    for i in range(3):
        e = np.zeros(3)
        e[i] = 1e-6
        up = grading._loss(latent, grades, thresholds + e, weight)[0]
        down = grading._loss(latent, grades, thresholds - e, weight)[0]
        assert abs((up - down) / 2e-6 - by_threshold[i]) < 1e-4
    up, down = (grading._loss(latent + e, grades, thresholds, weight)[0] for e in (1e-6, -1e-6))
    assert abs((up - down) / 2e-6 - by_latent.sum()) < 1e-4


def test_features_do_not_depend_on_neighbours():
    given = [t for t in fixtures.texts() if t is not None]
    together = grading.features(next(arrays.pieces(pa.array(given))))
    for i, text in enumerate(given):
        slots, values, first = grading.features(next(arrays.pieces(pa.array([text]))))
        a, b = together[2][i], together[2][i + 1]
        assert sorted(zip(slots, values)) == sorted(zip(together[0][a:b], together[1][a:b]))


def test_held_out_accuracy(spark, sf_dir):
    d = sf_dir.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    aside = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    model = grading.fit(grading.rated_sample(docs, labels.where(~aside)))
    assert (np.diff(model.thresholds) > 0).all()
    graded = grading.grade(docs, model).join(labels.where(aside), F.col("id") == F.col("doc_id"))
    rates = {
        r.g: r
        for r in graded.groupBy(grading.grade_of(F.col("quality"), F.col("toxic")).alias("g"))
        .agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.avg("expected_grade").alias("grade"))
        .collect()
    }
    assert rates[2].kept > 0.97 and rates[1].kept < 0.15 and rates[0].kept < 0.4
    assert rates[0].grade < rates[2].grade - 0.7


def test_awkward_rows(spark):
    docs = fixtures.documents(spark)
    labels = spark.createDataFrame(
        [(0, 1, 0), (0, 1, 0), (3, 0, None), (6, None, 1), (None, 1, 0), (9, None, None), (12, 1, 0), (12, 0, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    sample = grading.rated_sample(docs, labels)
    assert sorted(r.grade for r in sample.collect()) == [0, 1, 1, 1, 1, 2]  # id 12 stands for three rows
    model = grading.fit(sample, iterations=3)
    out = grading.grade(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in out)
    assert len({r.latent for r in out if r.key == 42}) <= 1
    assert grading.grade(fixtures.nothing(spark), model).count() == 0
    blank = grading.fit(grading.rated_sample(docs, labels.where("false")))
    assert grading.grade(docs, blank).select("tail_probability").distinct().count() == 1
