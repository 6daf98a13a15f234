"""The pipeline's stages on awkward rows, and the whole of it on the small tables."""

import inspect

import corpus_pipeline
from suarakit.llm import stages
from tests.llm import fixtures


def tables(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i * 3, 1 if i % 4 else 0, 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, " ".join(fixtures.texts()[5].split()[2:40])), (2, None)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_keep_columns_and_make_up_no_rows(spark, tmp_path):
    folder = tables(spark, str(tmp_path), fixtures.documents(spark))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    given = {(r.doc_id, r.source) for r in docs.collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        stage(spark, docs, folder).write.parquet(f"{folder}/stage{i}")
        after = spark.read.parquet(f"{folder}/stage{i}")
        rows = [(r.doc_id, r.source) for r in after.collect()]
        assert set(rows) <= given, name
        if i < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns and after.count() <= docs.count()
        docs = after
    assert docs.count() > 0


def test_stages_decide_as_their_operators_do(spark, tmp_path):
    folder = tables(spark, str(tmp_path), fixtures.documents(spark))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = stages.keep_one_copy(spark, docs, folder).collect()
    assert sum(r.text in (None, "", "   \n\t ") for r in kept) == 1  # all texts without words are one group
    assert sum(r.doc_id == 0 for r in kept) == 1
    clean = stages.drop_contaminated(spark, docs, folder).collect()
    assert 15 not in {r.doc_id for r in clean} and len(clean) < docs.count()
    cut = stages.cut_repeats(spark, docs, folder)
    assert cut.count() == docs.count() and cut.where("text is not null and n_chars <> length(text)").isEmpty()


def test_empty_tables(spark, tmp_path):
    folder = tables(spark, str(tmp_path), fixtures.nothing(spark))
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert 0.3 * n < out.count() < n
    assert out.where("taken > 2 * size or taken <> copies * size").isEmpty()
