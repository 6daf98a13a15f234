"""Vector arithmetic on array columns, for row-by-row use inside a plan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from suarakit.functions.binding import let


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalise(v: Column) -> Column:
    """Scale to unit length; a zero vector stays as it is."""
    return let(
        norm(v),
        lambda n: F.transform(v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x)),
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 if either vector is zero."""
    return let(
        norm(a) * norm(b), lambda n: F.when(n > 0, dot(a, b) / n).otherwise(F.lit(0.0))
    )


def verdict(
    similarity: Column, nearest_id: Column, own_id: Column | None, threshold: float
) -> Column:
    """Struct ``is_duplicate, similarity_score, duplicate_of`` for the nearest stored row.

    The threshold applies to the rounded score. A row whose nearest neighbour is itself is
    no duplicate but keeps its score; without a neighbour the score is 0.
    """
    score = F.coalesce(F.round(similarity, 4), F.lit(0.0))
    duplicate = similarity.isNotNull() & (score >= threshold)
    if own_id is not None:
        # Rows without an id are not the same row.
        duplicate = duplicate & F.coalesce(nearest_id != own_id, F.lit(True))
    return F.struct(
        duplicate.alias("is_duplicate"),
        score.alias("similarity_score"),
        F.when(duplicate, nearest_id).alias("duplicate_of"),
    )
