"""The jobs a user runs, composed from the operators.

Functions named after a noun return DataFrames; ``run_*`` functions also write.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suarakit import constants as K
from suarakit.functions import jsonx
from suarakit.functions.binding import compute_once
from suarakit.functions.labels import is_complete
from suarakit.functions.pii import mask_pii
from suarakit.functions.prompts import intake_prompt
from suarakit.functions.text import normalise
from suarakit.operators import annotate as A
from suarakit.operators import ingest, pages, quality, records, report
from suarakit.operators.embed import EncoderFactory, embed
from suarakit.operators.near_duplicates import split_arrivals
from suarakit.schemas import (
    ANNOTATED_COMPLAINT, CLEAN_COMPLAINT, LABEL_COLUMNS, PAGE_FIELDS, URGENCY_COMPLAINT,
)
from suarakit.session import prepare, scratch_path
from suarakit.sources import readers, writers
from suarakit.sources.csv_records import read_csv_split


# --- preprocessing ----------------------------------------------------------------------

def clean_complaints(
    raw: DataFrame, order: str, min_length: int = K.MIN_BODY_LENGTH
) -> DataFrame:
    """Raw complaints -> cleaned, normalised, filtered and de-duplicated, with input text."""
    df = quality.drop_hopeless_bodies(quality.drop_columns(raw), min_length=min_length)
    df = quality.normalise_categories(quality.clean_columns(df))
    df = quality.filter_quality(df, order, min_length=min_length)
    return quality.add_inference_input(df)


def run_preprocessing(spark: SparkSession, input_path: str, output_dir: str, stray_quotes: bool = False) -> DataFrame:
    """CSV in, clean CSV and fine-tuning JSON lines out; returns the preview rows.

    ``counters`` in the output says how many rows came in, were removed and left. A file with
    ``stray_quotes`` (outside quoted fields) has to be read by one task.
    """
    prepare(spark)
    seen = report.Counted()
    if stray_quotes:
        rows = readers.with_order(readers.read_csv(spark, input_path), "seq")
    else:
        rows = read_csv_split(spark, input_path, order="seq")
    raw = seen.count(rows, "read")
    made = seen.count(clean_complaints(raw, "seq"), "kept")
    # Written once; everything below reads that.
    path = scratch_path(spark, "clean")
    made.write.parquet(path)
    clean = spark.read.schema(made.schema).parquet(path)
    writers.write_csv(clean.select(*CLEAN_COMPLAINT.fieldNames()), f"{output_dir}/clean")
    recorded = records.finetune_records(clean)
    writers.write_records(recorded, f"{output_dir}/finetuning")
    _, bad = records.split_bad(recorded)
    writers.write_json(bad.drop("record", "seq"), f"{output_dir}/quarantine")
    seen.values["removed"] = seen.values["read"] - seen.values["kept"]
    seen.saved(spark, f"{output_dir}/counters")
    top = report.preview(clean, "seq", limits={"judul": 60, "input_text": 120})
    return top.select("id", "judul", "kategori", "input_text")


# --- annotation -------------------------------------------------------------------------

def _labelled_input(
    spark: SparkSession,
    clean_path: str,
    previous_path: str | None,
    cols: tuple[str, ...],
    schema: T.StructType,
) -> DataFrame:
    previous = readers.previous_output(spark, previous_path, schema) if previous_path else None
    return A.resume(read_csv_split(spark, clean_path, CLEAN_COMPLAINT), previous, cols)


def _stored(spark: SparkSession, annotated: DataFrame) -> DataFrame:
    """Written once, so that no label is computed twice; CSV is for the user alone."""
    path = scratch_path(spark, "annotated")
    annotated.write.parquet(path)
    return spark.read.schema(annotated.schema).parquet(path)


def run_full_annotation(
    spark: SparkSession,
    clean_path: str,
    output_dir: str,
    model: A.ModelFactory,
    previous_path: str | None = None,
    **options,
) -> DataFrame:
    """Label what is unlabelled; annotated CSV and training JSON lines; label distributions."""
    prepare(spark)
    df = _labelled_input(spark, clean_path, previous_path, LABEL_COLUMNS, ANNOTATED_COMPLAINT)
    seen = report.Counted()
    annotated = A.annotate_full(df, model, inspect=seen.answers, **options)
    stored = _stored(spark, annotated.select(*ANNOTATED_COMPLAINT.fieldNames()))
    writers.write_csv(stored, f"{output_dir}/annotated")
    done = is_complete(options.get("nullable", ()))
    seen.values.update(records.export_counts(stored, options.get("nullable", ())).first().asDict())
    seen.values["empty_summaries"] = stored.filter(done & (F.col("summary") == "")).count()
    seen.saved(spark, f"{output_dir}/counters")
    training = records.instruction_records(stored, options.get("nullable", ()))
    writers.write_json(training, f"{output_dir}/training")
    return report.label_distributions(stored, ("intent", "kategori", "urgency", "sentiment"))


def run_urgency_annotation(
    spark: SparkSession,
    clean_path: str,
    output_dir: str,
    model: A.ModelFactory,
    previous_path: str | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Fill the urgency column; returns its distribution and two sample rows per level."""
    prepare(spark)
    df = _labelled_input(spark, clean_path, previous_path, ("urgency",), URGENCY_COMPLAINT)
    seen = report.Counted()
    annotated = A.annotate_urgency(df, model, inspect=seen.answers, **options)
    stored = _stored(spark, annotated.select(*URGENCY_COMPLAINT.fieldNames()))
    writers.write_csv(stored, f"{output_dir}/urgency")
    seen.saved(spark, f"{output_dir}/counters")
    samples = report.samples_per_label(
        stored, "urgency", "id", values=("high", "medium", "low"), limits={"judul": 80, "isi": 100}
    )
    return report.value_percentages(stored, "urgency"), samples


def annotated_with(
    df: DataFrame, responses: DataFrame, cols: tuple[str, ...] = LABEL_COLUMNS
) -> DataFrame:
    """Full annotation from stored answers ``id, raw, status`` instead of a live model."""
    return A.annotate(df, ~is_complete(), A.stored_answers(responses), A.parse_full_labels, cols, needs=("kategori",))


# --- schema conversion ------------------------------------------------------------------

def run_conversion(spark: SparkSession, input_path: str, output_dir: str) -> DataFrame:
    """Training JSON lines of schema 1 to schema 2; bad lines go to the quarantine."""
    prepare(spark)
    seen = report.Counted()
    lines = readers.read_converted_jsonl(spark, input_path)
    converted = _stored(spark, seen.count(lines, "lines", converted=F.col("record").isNotNull()))
    writers.write_records(converted, f"{output_dir}/training")
    _, bad = records.split_bad(converted)
    bad.select("value").write.mode("errorifexists").text(f"{output_dir}/quarantine")
    seen.values["errors"] = seen.values["lines"] - seen.values["converted"]
    seen.saved(spark, f"{output_dir}/counters")
    return converted_distributions(converted)


def converted_distributions(converted: DataFrame) -> DataFrame:
    """Label counts of converted records; outputs that are no JSON count as NULL."""
    names = ("intent", "category", "urgency", "sentiment")
    good = converted.filter(F.col("record").isNotNull()).select("record.output")
    parsed = compute_once(good, v=jsonx.parse_strict(F.col("output")))
    texts = [F.try_variant_get("v", F.lit(f"$.{n}"), "string").alias(n) for n in names]
    return report.label_distributions(parsed.select(*texts), names, keep_null=True)


# --- intake -----------------------------------------------------------------------------

def masked_prompts(df: DataFrame, text_col: str = "isi") -> DataFrame:
    """Adds ``masked`` and the prompt built from it; raw text never reaches the prompt."""
    masked = compute_once(df, masked=mask_pii(F.col(text_col)))
    return masked.withColumn("prompt", intake_prompt(F.col("masked")))


def intake(
    df: DataFrame,
    responses: Callable[[DataFrame], DataFrame],
    id_col: str = "id",
    text_col: str = "isi",
) -> DataFrame:
    """Mask, ask, parse. ``responses`` maps ``id, prompt`` rows to ``id, raw`` rows."""
    prompts = masked_prompts(df, text_col)
    return A.intake_labels(prompts, responses(prompts.select(id_col, "prompt")), id_col)


def normalised_vectors(
    df: DataFrame, encoder: EncoderFactory, text_col: str = "isi"
) -> DataFrame:
    """Normalised text and its vector, encoded once."""
    return embed(df.withColumn("text", normalise(F.col(text_col))), encoder, "text")


def run_near_duplicate_intake(
    spark: SparkSession,
    complaints: DataFrame,
    encoder: EncoderFactory,
    store_path: str,
    verdict_path: str,
    order_col: str = "seq",
    threshold: float = K.DUPLICATE_THRESHOLD,
    **search,
) -> DataFrame:
    """Normalise, embed, check against the vector store, store what is new.

    ``complaints`` has ``complaint_id, isi, category`` and an order column of any type that
    sorts. ``search`` goes to the neighbour search, for instance ``method="lsh"``.
    """
    store = writers.read_vector_store(spark, store_path) if readers.exists(spark, store_path) else None
    # The encoder is a model: write its result once and work on that.
    normalised_vectors(complaints, encoder).write.mode("errorifexists").parquet(f"{verdict_path}/vectors")
    vectors = spark.read.parquet(f"{verdict_path}/vectors")
    verdicts, new = split_arrivals(
        vectors, store, "complaint_id", "embedding", order_col, threshold, ("text", "category"), **search
    )
    verdicts.write.mode("errorifexists").parquet(f"{verdict_path}/verdicts")
    writers.add_to_vector_store(new, store_path)
    return spark.read.parquet(f"{verdict_path}/verdicts")


# --- crawl ------------------------------------------------------------------------------

def complaints_from_pages(
    stored_pages: DataFrame,
    known: DataFrame | None = None,
    rules: dict[str, dict] | None = None,
    order: str = "url",
) -> DataFrame:
    """Stored pages -> complaint table without repeated ids, added to what is known.

    Of pages with one id the first in ``order`` counts, any column of the stored pages that
    tells when a page was fetched.
    """
    keep = () if order in PAGE_FIELDS.fieldNames() else (order,)
    fields = quality.flag_incomplete(pages.page_fields(stored_pages, rules, keep))
    if known is None:
        first = quality.keep_first(fields, ["id"], order)
    else:
        first = ingest.ingest(fields, known, order)
    return first.drop(*keep)


def run_complaints_from_pages(
    spark: SparkSession,
    stored_pages: DataFrame,
    output_dir: str,
    known: DataFrame | None = None,
    rules: dict[str, dict] | None = None,
    order: str = "url",
) -> DataFrame:
    """As :func:`complaints_from_pages`, saved as CSV and JSON; returns the counters."""
    prepare(spark)
    path = f"{output_dir}/complaints"
    seen = report.Counted()
    found = seen.count(complaints_from_pages(stored_pages, known, rules, order), "complaints", incomplete=F.col("is_incomplete"))
    found.write.mode("errorifexists").parquet(path)
    table = spark.read.schema(found.schema).parquet(path)
    writers.write_csv(table, f"{output_dir}/csv")
    writers.write_json(table, f"{output_dir}/json")
    return seen.saved(spark, f"{output_dir}/counters")
