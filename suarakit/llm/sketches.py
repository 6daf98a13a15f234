"""Bottom-k sketches of word shingles, in DataFrame functions alone.

The sketch of a text is the k smallest of its distinct shingle hashes. The k smallest of the
union of two sketches are the sketch of the union of the texts, so sketches merge across parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from suarakit.functions.binding import let
from suarakit.llm.common import column, text_key

_SPACE = r"[\x20\x09-\x0D]+"


def shingle_hashes(text: Column, shingle: int = 5) -> Column:
    """Hashes of all runs of ``shingle`` words; a text of fewer words is one run, one of none has none."""
    words = F.filter(F.split(F.lower(text), _SPACE), lambda w: w != "")

    def of(w: Column) -> Column:
        rest = F.size(w) - (shingle - 1)
        runs = F.transform(F.slice(w, 1, rest), lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, shingle)]))
        return F.when(rest >= 1, runs).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def sketch(text: Column, k: int = 128, shingle: int = 5) -> Column:
    """The k smallest distinct shingle hashes in rising order; null reads as empty."""
    hashes = shingle_hashes(F.coalesce(text, F.lit("")), shingle)
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = 128) -> Column:
    """Sketch of the union of two texts."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(parts: DataFrame, by: str, sketch_column: str, k: int = 128) -> DataFrame:
    """One sketch for each value of ``by`` from the sketches of its parts.

    Ranks are cut to k before the shuffle as well, so a group of any number of parts stays small.
    """
    hashes = parts.select(column(parts, by).alias(by), F.explode(sketch_column).alias("h")).distinct()
    ranked = hashes.withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy("h"))).where(F.col("r") <= k)
    merged = ranked.groupBy(by).agg(F.sort_array(F.collect_list("h")).alias(sketch_column))
    groups = parts.select(column(parts, by).alias("group_")).distinct()
    empty = F.array().cast("array<bigint>")
    return groups.join(merged, groups["group_"].eqNullSafe(merged[by]), "left").select(
        F.col("group_").alias(by), F.coalesce(sketch_column, empty).alias(sketch_column)
    )


def resemblance(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated share of shingles in common, 0 to 1; two texts without shingles are alike."""

    def of(union: Column) -> Column:
        shared = F.size(F.array_intersect(F.array_intersect(union, a), b))
        return F.when(F.size(union) == 0, 1.0).otherwise(shared / F.size(union))

    return let(merge(a, b, k), of)


def distinct_shingles(s: Column, k: int = 128) -> Column:
    """Estimated number of distinct shingles: exact below k, else from the k-th smallest hash."""
    share = (F.element_at(s, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too, 0 to 1; 1 if ``a`` has none."""
    n_a, n_b, near = distinct_shingles(a, k), distinct_shingles(b, k), resemblance(a, b, k)
    shared = near * (n_a + n_b) / (1 + near)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / n_a))


def printed(s: Column) -> Column:
    """A sketch as a string: 16 hex digits for each hash."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def with_next(docs: DataFrame, rows: DataFrame, id_column: str, carried: tuple[str, ...], bucket_rows: int = 2000) -> DataFrame:
    """Add ``next_<c>`` for every carried column: its value in the next row by falling id, after the last the first.

    ``docs`` is only read for its ids: quantiles that are ids themselves cut the order into
    buckets of about ``bucket_rows`` rows (at most 4,096 buckets). The first row of a bucket is
    also dealt to the bucket before it, so one shuffle by bucket suffices. Rows of one id are
    ordered by ``key``, then ``text``; null ids come last.
    """
    ids = docs.select(column(docs, id_column).cast("bigint").alias("id"))
    n, top = ids.agg(F.count("id"), F.max("id")).first()
    buckets = max(1, min(4096, n // bucket_rows))
    heads: list[int] = []
    if n:
        shares = [i / buckets for i in range(1, buckets)]
        picked = ids.agg(F.percentile_approx("id", shares, 100_000)).first()[0] if shares else []
        heads = sorted({top, *picked}, reverse=True)
    order = [F.col("extra"), F.col("id").desc_nulls_last(), F.col("key"), F.col("text")]
    step = 64
    own = F.struct(F.lit(0).alias("bucket"), F.lit(0).alias("extra"))
    copy, is_head = F.struct(F.lit(0).alias("bucket"), F.lit(1).alias("extra")), F.lit(True)
    if heads:
        # How many heads are at or above the id: whole steps first, then within one step.
        blocks = F.array(*[F.array(*[F.lit(h) for h in heads[i : i + step]]) for i in range(0, len(heads), step)])
        whole = F.size(F.filter(F.array(*[F.lit(h) for h in heads[::step]]), lambda h: h >= F.col("id")))
        part = F.size(F.filter(F.get(blocks, whole - 1), lambda h: h >= F.col("id")))
        at = F.when(F.col("id").isNull(), len(heads) - 1).otherwise((whole - 1) * step + part - 1).cast("int")
        rows = rows.withColumn("at", at)
        is_head = F.coalesce(F.array_contains(F.get(blocks, F.floor(F.col("at") / step).cast("int")), F.col("id")), F.lit(False))
        own = F.struct(F.col("at").alias("bucket"), F.lit(0).alias("extra"))
        copy = F.struct(F.pmod(F.col("at") - 1, F.lit(len(heads))).alias("bucket"), F.lit(1).alias("extra"))
    dealt = F.inline(F.when(is_head, F.array(own, copy)).otherwise(F.array(own)))
    rows = rows.select(*[c for c in rows.columns if c != "at"], dealt)
    window = Window.partitionBy("bucket").orderBy(*order)
    return rows.select("*", *[F.lead(c).over(window).alias(f"next_{c}") for c in carried]).where("extra = 0").drop("bucket", "extra")


def fingerprint_edits(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = 128, shingle: int = 5
) -> DataFrame:
    """Sketch every text and its edited text, whose last third the start of the next document replaces.

    Columns: id, n_chars, edited, sketch, edited_sketch, next_sketch. The next document is the
    one of the next smaller id, after the last the first; a single document is its own next.
    Null texts read as empty, and an empty text has an empty sketch.
    """
    text = F.coalesce(column(docs, text_column).cast("string"), F.lit(""))
    rows = docs.select(
        column(docs, id_column).cast("bigint").alias("id"), text_key(text).alias("key"), text.alias("text")
    ).withColumn("sketch", sketch(F.col("text"), k, shingle))
    chained = with_next(docs, rows, id_column, ("text", "sketch"))
    n_chars = F.length("text")
    cut = F.floor(n_chars / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - cut), F.substring("next_text", F.lit(1), cut))
    return chained.select("id", n_chars.cast("bigint").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch").withColumn(
        "edited_sketch", sketch(F.col("edited"), k, shingle)
    )
