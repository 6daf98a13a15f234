"""What several operators share: names, keys, reliable copies and bounded bit maps."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suarakit.session import scratch_path, shared_dir, ship


def fresh(names: Iterable[str], wanted: str) -> str:
    """A column name that clashes with none of ``names``, whatever their case."""
    taken = {n.lower() for n in names}
    name = wanted
    while name.lower() in taken:
        name += "_"
    return name


def column(df: DataFrame, name: str) -> Column:
    """Column by its exact name, dots and blanks included."""
    return df["`" + name.replace("`", "``") + "`"]


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound what a Python worker gets at once; long rows come in batches of fewer rows."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """Write once below the shared folder and read back: a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more; anything outside the scratch folder stays."""
    for table in tables:
        spark = table.sparkSession
        root = f"{shared_dir(spark)}/suarakit/"
        folders = {name.rsplit("/", 1)[0] for name in table.inputFiles()}
        plain = lambda name: name.split(":", 1)[-1].replace("///", "/")
        for folder in folders:
            if plain(folder).startswith(plain(root)):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def in_map(df: DataFrame, hashed: Column, probe) -> DataFrame:
    """Rows of ``df`` whose hash is in a broadcast bit map."""
    names = df.columns
    keyed = df.withColumn(fresh(names, "hash__"), hashed)

    def run(batches):
        for batch in batches:
            found = in_bit_map(probe.value, batch.column(batch.num_columns - 1).to_numpy().view(np.uint64))
            yield batch.filter(pa.array(found)).select(names)

    return keyed.mapInArrow(run, df.schema)


def text_key(text: Column) -> Column:
    """Together with the id this names a document: rows equal in both are one document."""
    return F.xxhash64(text)


def bit_map(hashes: DataFrame, column: str, per_member: int = 16, most_bits: int = 1 << 27) -> np.ndarray:
    """Bits set at the top bits of each distinct hash, as a filter before an exact join.

    The size follows the number of hashes but never exceeds ``most_bits`` (16 MB): the driver
    gets at most most_bits / 64 rows. A fuller map lets more rows through; none is lost.
    """
    n = hashes.agg(F.approx_count_distinct(column)).first()[0]
    bits = 1 << 16
    while bits < min(most_bits, per_member * n):
        bits <<= 1
    shift = 64 - bits.bit_length() + 1
    at = F.shiftrightunsigned(F.col(column), shift)
    words = (
        hashes.select(F.shiftright(at, 6).alias("w"), at.bitwiseAND(F.lit(63)).cast("int").alias("b"))
        .groupBy("w")
        .agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("m"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.uint64)
    out[words["w"].to_numpy()] = words["m"].to_numpy().view(np.uint64)
    return out


def in_bit_map(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - (len(words) * 64).bit_length() + 1)
    return (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0
