"""Plans keep the properties that matter on large tables."""

from suarakit.catalog import QUERIES
from suarakit.operators import ingest, quality, report


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_exact_duplicates_shrink_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["quality_filter_keep_first"](spark, sf_dir))
    assert text.count("WindowGroupLimit") == 2
    final, exchange, partial = (text.index(s) for s in ("Final", "Exchange hashpartitioning", "Partial"))
    assert final < exchange < partial


def test_intake_shuffles_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = spark.createDataFrame([(1, "a")], "seq int, id string")
        store = spark.createDataFrame([("a",)], "id string")
        text = plan(ingest.new_records(batch, store, "seq"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2


def test_scans_read_only_what_they_need(spark, sf_dir):
    text = QUERIES["nik_validity"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in text
    text = QUERIES["conversation_records"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "EqualTo(role,user)" in text and "EqualTo(role,assistant)" in text


def test_expensive_columns_are_computed_once(spark):
    df = spark.createDataFrame([(1, "t", "b" * 30)], "seq int, judul string, isi string")
    text = plan(quality.filter_quality(quality.clean_columns(df), "seq"))
    # One address pattern per cleaned column, none repeated in filters.
    assert text.count("https?") == 2


def test_no_cross_joins_and_no_single_partition_windows(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("label_distribution_pct", "annotate_resume_merge", "ingest_new_only", "empty_streak_cut",
                     "label_samples", "documents_against_benchmark", "dup_top1"):
            text = plan(QUERIES[name](spark, sf_dir))
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
            assert "windowspecdefinition(unspecified" not in text, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_samples_rank_narrow_rows(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = plan(report.samples_per_label(rows, "lang", "doc_id", values=("en", "fr")))
    ranked = text[text.index("WindowGroupLimit"):]
    assert "text" not in ranked.split("FileScan")[0]
