"""Readers with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suarakit.operators.records import convert_lines
from suarakit.schemas import RAW_COMPLAINT
from suarakit.session import exists
from suarakit.sources.csv_records import read_csv_split


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType = RAW_COMPLAINT, multi_line: bool = True
) -> DataFrame:
    """CSV with a header and doubled quotes; an empty field is NULL.

    Complaints contain line breaks, so each file is read by one task, unless ``multi_line=False``
    says that no field has one. :func:`suarakit.sources.csv_records.read_csv_split` takes many.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines in column ``value``."""
    return spark.read.text(path)


def read_converted_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their converted record; NULL marks lines for the quarantine."""
    return convert_lines(read_lines(spark, path))


def with_order(df: DataFrame, column: str = "seq") -> DataFrame:
    """Order rows by file name and position, for file inputs that carry no order of their own."""
    return df.withColumn(
        column,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def previous_output(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Annotated table of an earlier run, or None before the first one."""
    return read_csv_split(spark, path, schema) if exists(spark, path) else None
