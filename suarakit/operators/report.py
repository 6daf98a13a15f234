"""Distributions, counters, previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``value, count`` without NULLs, most frequent first, ties by value."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("value"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "value")
    )


def value_percentages(df: DataFrame, col: str) -> DataFrame:
    """``value, count, pct``: share of the non-NULL rows in percent, one decimal.

    The total is a scalar subquery over the same counts, so no task sees all groups.
    """
    counts = (
        df.filter(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("value"))
        .agg(F.count("*").alias("count"))
    )
    total = counts.agg(F.sum("count")).scalar()
    # rint gives half-to-even on the scaled value.
    pct = F.rint(F.col("count") / total * 100 * 10) / 10
    return counts.withColumn("pct", pct).orderBy(F.desc("count"), "value")


def label_distributions(
    df: DataFrame, cols: Sequence[str], keep_null: bool = False
) -> DataFrame:
    """``field, value, count`` for several label columns in one pass over the data."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in cols])
    )
    long = df.select(pairs.alias("p")).select("p.*")
    if not keep_null:
        long = long.filter(F.col("value").isNotNull())
    return long.groupBy("field", "value").agg(F.count("*").alias("count"))


def samples_per_label(
    df: DataFrame,
    label: str,
    order: str,
    values: Sequence[str],
    n: int = 2,
    limits: dict[str, int] | None = None,
) -> DataFrame:
    """First ``n`` rows of each of the label ``values``, long texts cut for display.

    ``order`` is unique. Ranking sees only label and order; the texts of the few winners, at
    most ``n`` per value, are fetched by a join with that bounded list.
    """
    narrow = df.filter(F.col(label).isin(*values)).select(label, order)
    rank = F.row_number().over(W.partitionBy(label).orderBy(order))
    winners = narrow.withColumn("_rank", rank).filter(F.col("_rank") <= n).select(order)
    rows = df.join(F.broadcast(winners), order, "left_semi")
    cut = {c: F.left(F.col(c), F.lit(size)) for c, size in (limits or {}).items()}
    return rows.withColumns(cut) if cut else rows


def preview(df: DataFrame, order: str, n: int = 3, limits: dict[str, int] | None = None) -> DataFrame:
    """First ``n`` rows, long texts cut for display."""
    cut = {c: F.left(F.col(c), F.lit(size)) for c, size in (limits or {}).items()}
    top = df.orderBy(order).limit(n)
    return top.withColumns(cut) if cut else top


class Counted:
    """Counters of a job, gathered while its own writes run.

    Counts are observed on the rows as they pass; nothing is read again for them.
    """

    def __init__(self) -> None:
        self._observations: list[Observation] = []
        self._values: dict[str, int] = {}

    def count(self, df: DataFrame, name: str, **conditions: Column) -> DataFrame:
        """``df`` with its rows counted as ``name``, and those meeting each condition by its name."""
        observation = Observation()
        self._observations.append(observation)
        marks = [F.count_if(c).alias(n) for n, c in conditions.items()]
        return df.observe(observation, F.count(F.lit(1)).alias(name), *marks)

    def answers(self, answered: DataFrame) -> None:
        """Count stored model answers by status."""
        for row in answered.groupBy("status").count().collect():
            self._values[f"answers_{row['status']}"] = row["count"]

    @property
    def values(self) -> dict[str, int]:
        """What is known so far; waits for counts whose rows are being written."""
        while self._observations:
            self._values.update(self._observations.pop(0).get)
        return self._values

    def saved(self, spark: SparkSession, path: str) -> DataFrame:
        """Write the counters as one JSON line and return them as one row."""
        row = spark.createDataFrame([self.values])
        row.write.mode("errorifexists").json(path)
        return row


def counters(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: ``total`` and the number of rows meeting each named condition."""
    return df.agg(
        F.count("*").alias("total"),
        *[F.count_if(cond).alias(name) for name, cond in conditions.items()],
    )
