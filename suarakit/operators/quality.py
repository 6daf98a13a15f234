"""Column pruning, cleaning, category normalisation, quality filter, exact duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from suarakit import constants as K
from suarakit.functions.binding import compute_once
from suarakit.functions.category import normalise_category
from suarakit.functions.chars import is_blank
from suarakit.functions.prompts import inference_input
from suarakit.functions.text import clean_text


def drop_columns(df: DataFrame, cols: Sequence[str] = ("url",)) -> DataFrame:
    """Drop the named columns; absent names are ignored."""
    return df.drop(*cols)


def clean_columns(df: DataFrame, cols: Sequence[str] = ("judul", "isi")) -> DataFrame:
    return compute_once(df, **{c: clean_text(F.col(c)) for c in cols})


def normalise_categories(df: DataFrame, col: str = "kategori") -> DataFrame:
    return compute_once(df, **{col: normalise_category(F.col(col))})


def keep_first(
    df: DataFrame, keys: Sequence[str], order: str, long_keys: bool = False
) -> DataFrame:
    """First row per key in ``order``; rows with a NULL key form one group.

    The rank filter lets Spark keep one row per key and task *before* the shuffle, so a key
    holding a third of the table sends a handful of rows, not a third of the table. With
    ``long_keys`` a leading hash makes the sort compare whole keys only where hashes agree;
    without it the result is partitioned by the keys and can be joined on them as it is.
    """
    by = [F.xxhash64(*keys), *keys] if long_keys else list(keys)
    first = W.partitionBy(*by).orderBy(order)
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def filter_quality(
    df: DataFrame,
    order: str,
    body: str = "isi",
    title: str | None = "judul",
    min_length: int = K.MIN_BODY_LENGTH,
) -> DataFrame:
    """Rows with title and body, a body of at least ``min_length`` characters, first copy only."""
    present = df.na.drop(subset=[body] + ([title] if title else []))
    return keep_first(present.filter(F.length(body) >= min_length), [body], order, long_keys=True)


def drop_hopeless_bodies(
    df: DataFrame, body: str = "isi", min_length: int = K.MIN_BODY_LENGTH
) -> DataFrame:
    """Early length filter on raw text. Cleaning never lengthens a text, so this is safe ahead
    of :func:`filter_quality` and spares cleaning what would be dropped anyway."""
    return df.filter(F.length(body) >= min_length)


def add_inference_input(df: DataFrame, title: str = "judul", body: str = "isi") -> DataFrame:
    return df.withColumn("input_text", inference_input(F.col(title), F.col(body)))


def flag_incomplete(df: DataFrame, cols: Sequence[str] = ("id", "judul", "isi")) -> DataFrame:
    """Mark rows lacking any of ``cols`` (NULL or '') but keep them."""
    missing = F.lit(False)
    for c in cols:
        missing = missing | (F.coalesce(F.col(c), F.lit("")) == "")
    return df.withColumn("is_incomplete", missing)


def drop_blank_lines(df: DataFrame, col: str = "value") -> DataFrame:
    return df.filter(~is_blank(F.col(col)))
