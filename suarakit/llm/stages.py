"""The operators as stages of a corpus pipeline: (spark, docs, sf_dir) to the documents that go on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suarakit.llm import grading, linechunks, mixing, simhash, winnowing
from suarakit.llm.common import column, fresh, text_key, written


def _without(docs: DataFrame, rejected: DataFrame, once: bool = False) -> DataFrame:
    """``docs`` less the rows whose id and text are in ``rejected`` (``id``, ``key``).

    ``once`` keeps one row of those equal in id and text; it uses the partitions of the join.
    """
    names = docs.columns
    key, id_, other = fresh(names, "key__"), fresh(names, "id__"), fresh(names, "other_key__")
    rejected = rejected.select("id", "key").distinct().toDF(id_, other)
    keyed = docs.withColumn(key, text_key(column(docs, "text").cast("string")))
    kept = keyed.join(rejected, column(keyed, "doc_id").eqNullSafe(rejected[id_]) & (keyed[key] == rejected[other]), "left_anti")
    return (kept.dropDuplicates(["doc_id", key]) if once else kept).drop(key)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the rated ones among them, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = grading.fit(grading.rated_sample(docs, labels))
    graded = written(grading.grade(docs, model).select("id", "key", "kept"), "graded")
    return _without(docs, graded.where("not kept"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier one has; ``n_chars`` follows the text."""
    out = linechunks.remove_repeats(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(out.schema["n_chars"].dataType), "n_chars"))
    return out


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    return _without(docs, simhash.near_duplicates(docs).where("not keeper"), once=True)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty stands in a benchmark window."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, winnowing.decontaminate(docs, benchmark).where(winnowing.is_contaminated()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.mix(docs).select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "rate", "copies", "taken"
    )
