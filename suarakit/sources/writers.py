"""Writers. None of them overwrites: rerun into a new path, or append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suarakit.schemas import VECTOR_ROW


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header and doubled quotes, white space kept; NULL and '' both become an empty field."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line, nulls kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_records(df: DataFrame, path: str, record: str = "record", mode: str = "errorifexists") -> None:
    """JSON lines of the struct column ``record``; rows without a record are left out."""
    lines = df.filter(F.col(record).isNotNull()).select(
        F.to_json(F.col(record), {"ignoreNullFields": "false"}).alias("value")
    )
    lines.write.mode(mode).text(path)


def add_to_vector_store(vectors: DataFrame, path: str) -> None:
    """Append ``complaint_id, text, category, embedding`` rows to the vector table."""
    columns = [F.col(f.name).cast(f.dataType) for f in VECTOR_ROW.fields]
    vectors.select(*columns).write.mode("append").parquet(path)


def read_vector_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VECTOR_ROW).parquet(path)
