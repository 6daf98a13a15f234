"""Tolerant reading of JSON produced by a model.

Needs ``spark.sql.variant.allowDuplicateKeys`` (see ``suarakit.session.prepare``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from suarakit.functions.binding import let


def parse_strict(c: Column) -> Column:
    """One JSON value and nothing else, as VARIANT; NULL if the text is not that.

    The built-in parsers stop after the first value and ignore what follows. Boxing the
    text in an array next to its own hash shows whether it was exactly one value.
    """

    def unbox(text: Column) -> Column:
        seal = F.xxhash64(text)
        boxed = F.concat(F.lit("["), text, F.lit(","), seal.cast("string"), F.lit("]"))

        def check(box: Column) -> Column:
            sealed = F.try_variant_get(box, F.lit("$[1]"), "bigint") == seal
            single = F.try_variant_get(box, F.lit("$[2]"), "variant").isNull()
            return F.when(sealed & single, F.try_variant_get(box, F.lit("$[0]"), "variant"))

        return let(F.try_parse_json(boxed), check)

    return let(c, unbox)


def parse_tolerant(c: Column) -> Column:
    """The whole text if it is JSON, else the span from the first ``{`` to the last ``}``."""
    braces = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    return F.coalesce(parse_strict(c), parse_strict(braces))


def kind(v: Column) -> Column:
    """``object``, ``array``, ``string``, ``null``, ``scalar``, or NULL for no value."""
    t = F.schema_of_variant(v)
    return (
        F.when(t.startswith("OBJECT"), "object")
        .when(t.startswith("ARRAY"), "array")
        .when(t == "STRING", "string")
        .when(t == "VOID", "null")
        .when(t.isNotNull(), "scalar")
    )


def status(v: Column) -> Column:
    """Status of a parsed value: ``ok``, ``not_object`` or ``unparsable``."""
    return F.when(v.isNull(), "unparsable").when(kind(v) == "object", "ok").otherwise("not_object")


def member(v: Column, key: str) -> Column:
    """Member of an object as VARIANT. An absent key is NULL, a JSON null is not."""
    return F.try_variant_get(v, F.lit(f"$.{key}"), "variant")


def as_text(v: Column) -> Column:
    """A string as it is, any other value as JSON text."""
    return F.when(F.schema_of_variant(v) == "STRING", F.variant_get(v, F.lit("$"), "string")).otherwise(
        F.to_json(v)
    )


def string_member(v: Column, key: str) -> Column:
    """Member of an object if it is a string, else NULL."""
    m = member(v, key)
    return F.when(F.schema_of_variant(m) == "STRING", F.try_variant_get(m, F.lit("$"), "string"))


def truthy(v: Column) -> Column:
    """False for absent, null, empty and zero values."""
    empty = r'null|""|false|\[\]|\{\}|-?0(\.0+)?(E-?\d+)?'
    return F.coalesce(~F.rlike(F.to_json(v), F.lit(rf"^(?:{empty})\z")), F.lit(False))


def first_truthy(*values: Column) -> Column:
    """First value that is neither absent, null, empty nor zero, as VARIANT."""
    return F.coalesce(*[let(v, lambda x: F.when(truthy(x), x)) for v in values])
