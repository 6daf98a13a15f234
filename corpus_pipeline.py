"""A corpus from raw documents: graded, cleared of repeats, near copies and benchmark text, and mixed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of ``docs``. Rows with null ids or texts pass through the same rules as all others, and
extra columns come along.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from suarakit.llm import stages  # noqa: E402
from suarakit.session import scratch_path  # noqa: E402

STAGES = [
    ("quality classifier", stages.keep_good),
    ("line dedup", stages.cut_repeats),
    ("simhash near-dedup", stages.keep_one_copy),
    ("benchmark decontamination", stages.drop_contaminated),
    ("mixing sources", stages.mix_sources),
]

# Fitting, hashing by seeded digests and rounding of copies have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
