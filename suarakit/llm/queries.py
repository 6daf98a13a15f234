"""Named queries that apply the operators to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suarakit.llm import (
    collocations,
    credentials,
    grading,
    labeller,
    languages,
    linechunks,
    mixing,
    periodic,
    simhash,
    sketches,
    treeweighting,
    warc,
    winnowing,
)
from suarakit.llm.sql import SQL  # noqa: F401
from suarakit.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_archives(_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return warc.record_summary(warc.read_archives(spark, files)).withColumnRenamed("id", "page_id")


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        winnowing.is_contaminated().alias("contaminated"),
    )


def op3_ordinal_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = grading.fit(grading.rated_sample(docs, _table(spark, sf_dir, "labels")))
    return grading.grade(docs, model).withColumnRenamed("id", "doc_id").drop("key", "latent")


def op4_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.scan(_table(spark, sf_dir, "documents"))
    counts = [credentials.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select(
        F.col("id").alias("doc_id"),
        *counts,
        F.sha2(credentials.listed(F.col("base")), 256).alias("base_sha256"),
        credentials.listed(F.col("findings")).alias("spans"),
        F.size(F.filter("findings", lambda s: s["verdict"] == "owned")).cast("bigint").alias("n_owned"),
        F.size(F.filter("findings", lambda s: s["verdict"] == "example")).cast("bigint").alias("n_example"),
    )


def op5_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "rate", "copies")


def op6_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    aside = treeweighting.held_out(F.col("doc_id"), 7, 2)
    model, words = treeweighting.learn(docs.where(~aside).select("text"))
    scored = treeweighting.score(docs, model, words)
    return scored.withColumn("held_out", treeweighting.held_out(F.col("id"), 7, 2)).withColumnRenamed("id", "doc_id").drop("key")


def op7_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sketches.fingerprint_edits(_table(spark, sf_dir, "documents"))
    return made.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        sketches.printed(F.col("sketch")).alias("fingerprint"),
        sketches.printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        sketches.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        sketches.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        sketches.distinct_shingles(F.col("sketch")).alias("distinct_shingles"),
        sketches.containment(F.col("sketch"), F.col("edited_sketch")).alias("contained_in_edited"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op9_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return linechunks.remove_repeats(docs, counts="words_removed")


def op10_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    aside = treeweighting.held_out(F.col("doc_id"), 4, 2)
    model = languages.learn(docs.where(~aside))
    found = languages.identify(docs, model)
    return found.select(
        F.col("id").alias("doc_id"),
        treeweighting.held_out(F.col("id"), 4, 2).alias("held_out"),
        "lang_pred",
        "score",
        F.array_sort(F.map_keys("mixture")).alias("languages"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(collocations.frequent_phrases(_table(spark, sf_dir, "documents")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    number = F.crc32(F.col("doc_id").cast("string"))
    given = docs.select("doc_id", periodic.with_tail_repeated(F.col("text"), number).alias("text"))
    found = periodic.periodic_runs(given).withColumn("best", periodic.longest(F.col("runs")))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periodic.listed(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_block_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    found = labeller.main_text(pages, labeller.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_warc_chunks": op1_warc_chunks,
    "op2_winnowing": op2_winnowing,
    "op3_ordinal_grades": op3_ordinal_grades,
    "op4_secret_ownership": op4_secret_ownership,
    "op5_entropy_balancing": op5_entropy_balancing,
    "op6_context_tree": op6_context_tree,
    "op7_bottom_k": op7_bottom_k,
    "op8_simhash": op8_simhash,
    "op9_line_chunks": op9_line_chunks,
    "op10_language_mixture": op10_language_mixture,
    "op11_collocations": op11_collocations,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_block_labels": op13_block_labels,
    "pipeline": pipeline,
}
