"""Benchmark decontamination by winnowing.

The smallest k-gram hash of every window of w neighbouring k-grams is a fingerprint. Two texts
that share a span of w + k - 1 words share a fingerprint at the same place of that span, so
joining fingerprints and extending every hit to both sides by comparing words finds all shared
spans of that length or more, and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from suarakit.llm import arrays
from suarakit.llm.common import bit_map, column, in_bit_map, small_batches, text_key, written

_HIT = "at int, k int, h bigint, lead int, words string"
_HITS_ARROW = pa.list_(
    pa.struct([("at", pa.int32()), ("k", pa.int32()), ("h", pa.int64()), ("lead", pa.int32()), ("words", pa.string())])
)


def fingerprints(hashes: np.ndarray, first: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the fingerprints in word hashes; ``first`` bounds the documents."""
    n = len(hashes) - k + 1
    if n < w or not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = np.zeros(n, np.uint64)
    for j in range(k):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
    grams = arrays.mix(grams)
    windows = n - w + 1
    best, at = grams[:windows].copy(), np.zeros(windows, np.int64)
    for j in range(1, w):  # of equal hashes the rightmost
        lower = grams[j : j + windows] <= best
        best[lower] = grams[j : j + windows][lower]
        at[lower] = j
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    within = row[:windows] == row[k + w - 2 :][:windows]
    places = np.unique((np.arange(windows) + at)[within])
    return places, grams[places]


def _scan(lengths: list[tuple[int, int]], span: int, probe) -> callable:
    """mapInArrow function: the rows' keys, number of words, and fingerprints with their surroundings.

    ``probe`` (a broadcast bit map or None for all) says which fingerprints to report.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if probe is None else probe.value
        for batch in batches:
            counts, lists = np.zeros(batch.num_rows, np.int64), [[] for _ in range(batch.num_rows)]
            for piece in arrays.pieces(batch.column(batch.num_columns - 1)):
                words = arrays.runs(piece, arrays.ALNUM)
                counts[piece.first : piece.first + len(piece.starts)] = np.diff(words.first)
                hashes = arrays.word_hashes(piece, words)
                lowered = arrays.LOWER[piece.data].tobytes()
                for k, w in lengths:
                    places, grams = fingerprints(hashes, words.first, k, w)
                    # A whole short item is looked up as it is: its length is part of the hash.
                    grams = arrays.mix(grams + np.uint64(k))
                    if wanted is not None:
                        keep = in_bit_map(wanted, grams)
                        places, grams = places[keep], grams[keep]
                    room = span - k if w > 1 else 0
                    for at, h in zip(places.tolist(), grams.view(np.int64).tolist()):
                        row = words.row[at]
                        low = max(at - room, words.first[row])
                        high = min(at + k + room, words.first[row + 1])
                        text = b" ".join(lowered[words.starts[i] : words.ends[i]] for i in range(low, high))
                        lists[piece.first + row].append(
                            {"at": at - int(words.first[row]), "k": k, "h": h, "lead": int(at - low), "words": text.decode()}
                        )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(counts), pa.array(lists, _HITS_ARROW)], names=[*batch.schema.names[:-1], "n_words", "hits"]
            )

    return run


def _with_hits(df: DataFrame, lengths: list[tuple[int, int]], span: int, probe=None) -> DataFrame:
    """Replace the last column, a text, by its number of words and its fingerprints."""
    kept = df.schema.fields[:-1]
    made = StructType.fromDDL("n_words bigint").fields + [
        StructField("hits", ArrayType(StructType.fromDDL(_HIT)))
    ]
    return df.mapInArrow(_scan(lengths, span, probe), StructType([*kept, *made]))


def _equal_run(start: Column, limit: Column, sign: int) -> Column:
    """Number of equal words from ``start`` (relative to the fingerprint) on, at most ``limit``."""

    def differs(i: Column) -> Column:
        ours = F.get(F.col("ours"), F.col("lead") + start + sign * i)
        theirs = F.get(F.col("theirs"), F.col("item_lead") + start + sign * i)
        return F.coalesce(ours != theirs, F.lit(True))

    first = F.array_position(F.transform(F.sequence(F.lit(0), limit - 1), differs), True)
    return F.when(limit <= 0, 0).when(first == 0, limit).otherwise(first - 1).cast("int")


def contaminated_spans(hits: DataFrame, items: DataFrame, span: int) -> DataFrame:
    """Join document fingerprints with item fingerprints and extend: doc keys, item_id, from, to."""
    joined = (
        hits.join(items, "h")
        .where("k = item_k")
        .withColumn("ours", F.split("words", " "))
        .withColumn("theirs", F.split("item_words", " "))
    )
    k, room = F.col("k"), F.lit(span) - F.col("k")
    left = F.least("lead", "item_lead", room)
    right = F.least(F.size("ours") - F.col("lead") - k, F.size("theirs") - F.col("item_lead") - k, room)
    return (
        joined.where(_equal_run(F.lit(0), k, 1) == k)
        .withColumn("low", F.when(F.col("whole"), F.col("at")).otherwise(F.col("at") - _equal_run(F.lit(-1), left, -1)))
        .withColumn("high", F.when(F.col("whole"), F.col("at") + k).otherwise(F.col("at") + k + _equal_run(k, right, 1)))
        .where(F.col("whole") | (F.col("high") - F.col("low") >= span))
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    span: int = 13,
    k: int = 7,
) -> DataFrame:
    """One row per document row: its key, number of words, hit words and the items found in it.

    A window is ``span`` consecutive words of an item, or a whole item of fewer words; document
    words inside any occurrence of a window are hit. Columns: id, ``key`` (see ``text_key``),
    n_words, n_hit, items (sorted array of item ids as strings), n_items.

    Nulls and texts without words have no words and no hits, items without words no windows;
    a null item id counts as one item whose id reads ``null``. Equal rows each get their
    result. An empty benchmark hits nothing. Memory: a piece of text, and a bit map whose size
    is bounded whatever the benchmark; the join itself is an ordinary equi-join.
    """
    spark = small_batches(docs.sparkSession)
    k = min(k, span)
    item_id = F.coalesce(column(benchmark, item_column).cast("string"), F.lit("null"))
    texts = benchmark.select(item_id.alias("item_id"), column(benchmark, item_text).cast("string").alias("text")).distinct()
    # Lengths of items that are shorter than a window: each is looked up as one gram.
    counted = _with_hits(texts, [], span).where(F.col("n_words").between(1, span - 1))
    short = sorted(r[0] for r in counted.select("n_words").distinct().collect())
    lengths = [(k, span - k + 1)] + [(n, 1) for n in short]
    whole = F.col("n_words") < span
    of_item = (
        _with_hits(texts, lengths, span)
        .select("item_id", "n_words", F.explode("hits").alias("x"))
        .where(F.when(whole, (F.col("x.k") == F.col("n_words")) & (F.size(F.split("x.words", " ")) == F.col("n_words"))).otherwise(
            (F.col("x.k") == k) & (F.size(F.split("x.words", " ")) >= span)
        ))
        .select(
            "x.h",
            F.col("x.k").alias("item_k"),
            F.col("x.lead").alias("item_lead"),
            F.col("x.words").alias("item_words"),
            "item_id",
            whole.alias("whole"),
        )
    )
    # One row for each surrounding, whatever the number of items that share it.
    items = written(
        of_item.groupBy("h", "item_k", "item_lead", "item_words", "whole").agg(F.collect_set("item_id").alias("item_ids")),
        "items",
    )
    probe = spark.sparkContext.broadcast(bit_map(items, "h"))
    text = column(docs, text_column).cast("string")
    keyed = docs.select(column(docs, id_column).alias("id"), text_key(text).alias("key"), text.alias("text"))
    scanned = written(_with_hits(keyed, lengths, span, probe), "scanned")
    hits = scanned.where(F.size("hits") > 0).select("id", "key", F.explode("hits").alias("x")).select("id", "key", "x.*").distinct()
    found = contaminated_spans(hits, items, span)
    by_doc = found.groupBy("id", "key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("items"),
        F.array_sort(F.collect_set(F.struct("low", "high"))).alias("spans"),
    )
    # Words covered by the union of the spans, which come in order.
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("int").alias("upto"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["upto"], s["high"]).alias("upto"),
            (acc["n"] + F.greatest(F.lit(0), s["high"] - F.greatest(acc["upto"], s["low"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    by_doc = by_doc.select(F.col("id").alias("hit_id"), F.col("key").alias("hit_key"), "items", covered.alias("n_hit"))
    return scanned.join(by_doc, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key")), "left").select(
        "id",
        "key",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.size(F.coalesce("items", F.array().cast("array<string>"))).cast("bigint").alias("n_items"),
    )


def is_contaminated() -> Column:
    """At least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
