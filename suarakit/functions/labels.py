"""Validation of model labels and conversion between the two label schemas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from suarakit import constants as K
from suarakit.functions import jsonx as J
from suarakit.functions.binding import let
from suarakit.functions.chars import is_blank
from suarakit.functions.text import lookup
from suarakit.schemas import LABEL_COLUMNS


def urgency_word(c: Column) -> Column:
    """Urgency named anywhere in an answer; the most severe word wins."""
    low = F.lower(c)
    return (
        F.when(F.contains(low, F.lit("high")), "high")
        .when(F.contains(low, F.lit("medium")), "medium")
        .when(F.contains(low, F.lit("low")), "low")
        .otherwise("unknown")
    )


def urgency_label(raw: Column, status: Column) -> Column:
    """Label column as stored: the word found, or the name of the failed call."""
    return (
        F.when(status == "timeout", "error_timeout")
        .when(status == "error", "error")
        .otherwise(urgency_word(raw))
    )


def _one_of(value: Column, allowed: tuple[str, ...], default: Column | str) -> Column:
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.when(value.isin(*allowed), value).otherwise(fallback)


def clean_location(v: Column) -> Column:
    """Location as text; null-like words count as missing."""
    text = J.as_text(J.first_truthy(v))
    return F.when(~F.lower(text).isin(*K.MISSING_LOCATION_WORDS), text)


def validate(raw: Column, original_category: Column | None = None) -> Column:
    """Struct of the seven labels of schema 1, every value valid or defaulted."""
    return let(J.parse_tolerant(raw), lambda v: validate_variant(v, original_category))


def validate_variant(v: Column, original_category: Column | None = None) -> Column:
    """As :func:`validate` for an already parsed value, so a response is parsed once."""
    original = F.lit(None).cast("string") if original_category is None else original_category
    # '' is as good as no category.
    fallback = F.coalesce(F.nullif(original, F.lit("")), F.lit(K.OTHER_CATEGORY))

    def choice(key: str, allowed: tuple[str, ...], default: str) -> Column:
        return _one_of(F.lower(J.string_member(v, key)), allowed, default)

    def free_text(*keys: str) -> Column:
        return F.coalesce(J.as_text(J.first_truthy(*[J.member(v, k) for k in keys])), F.lit(""))

    return F.struct(
        choice("intent", K.INTENTS, "complaint").alias("intent"),
        _one_of(J.string_member(v, "kategori"), K.CATEGORIES, fallback).alias("kategori"),
        clean_location(J.member(v, "location")).alias("location"),
        free_text("object", "objek").alias("object"),
        choice("urgency", K.URGENCIES, "medium").alias("urgency"),
        choice("sentiment", K.SENTIMENTS, "netral").alias("sentiment"),
        free_text("summary", "ringkasan").alias("summary"),
    )


def output_json(*, source: str | None = None) -> Column:
    """The seven labels as one JSON object with nulls kept."""
    prefix = f"{source}." if source else ""
    fields = F.struct(*[F.col(prefix + c).alias(c) for c in LABEL_COLUMNS])
    return F.to_json(fields, {"ignoreNullFields": "false"})


def converted_labels(v: Column) -> Column:
    """Schema-1 labels (VARIANT object) as a schema-2 struct.

    Free-text members keep their JSON type. Conversion loses detail and is not meant to be
    applied twice: ``kebersihan`` is no schema-1 category.
    """
    null_variant = F.parse_json(F.lit("null"))
    empty_variant = F.parse_json(F.lit('""'))
    # Presence of the key decides, even when its value is null.
    category = F.coalesce(J.member(v, "kategori"), J.member(v, "category"))
    urgency = F.lower(J.string_member(v, "urgency"))
    return F.struct(
        lookup(K.INTENT_V2, F.lower(J.string_member(v, "intent")), F.lit("complaint")).alias("intent"),
        lookup(
            K.CATEGORY_V2,
            F.when(J.kind(category) == "string", J.as_text(category)),
            F.lit("lainnya"),
        ).alias("category"),
        F.coalesce(
            J.first_truthy(J.member(v, "location"), J.member(v, "lokasi")), null_variant
        ).alias("location"),
        F.coalesce(
            J.first_truthy(J.member(v, "object"), J.member(v, "objek")), empty_variant
        ).alias("object"),
        _one_of(urgency, K.URGENCIES, "medium").alias("urgency"),
        lookup(K.SENTIMENT_V2, F.lower(J.string_member(v, "sentiment")), F.lit("neutral")).alias(
            "sentiment"
        ),
        F.coalesce(
            J.first_truthy(J.member(v, "summary"), J.member(v, "ringkasan")), empty_variant
        ).alias("summary"),
    )


def convert_output(raw: Column) -> Column:
    """Schema-1 label JSON as schema-2 JSON.

    Text that is no JSON comes back unchanged; JSON that is no object gives NULL, which
    callers count as a failed record.
    """

    def convert(v: Column) -> Column:
        converted = F.to_json(converted_labels(v), {"ignoreNullFields": "false"})
        return F.when(v.isNull(), raw).when(J.kind(v) == "object", converted)

    return let(J.parse_tolerant(raw), convert)


def needs_urgency(c: Column) -> Column:
    """True unless the label is a valid urgency; NULL and error labels need work."""
    return ~F.coalesce(c.isin(*K.URGENCIES), F.lit(False))


def is_complete(nullable: tuple[str, ...] = ()) -> Column:
    """All seven labels present and not blank.

    By default a missing location makes a row incomplete; name it in ``nullable`` to allow it.
    """
    done = F.lit(True)
    for name in LABEL_COLUMNS:
        if name not in nullable:
            done = done & F.coalesce(~is_blank(F.col(name)), F.lit(False))
    return done
