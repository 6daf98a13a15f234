"""Category normalisation by ordered keyword search."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from suarakit import constants as K
from suarakit.functions.binding import let
from suarakit.functions.chars import strip_space
from suarakit.functions.text import title_case


def first_keyword(c: Column, keywords: dict[str, str], default: Column) -> Column:
    """Value of the first keyword, in dictionary order, that occurs anywhere in the text."""
    hit = None
    for word, value in keywords.items():
        found = F.contains(c, F.lit(word))
        hit = F.when(found, F.lit(value)) if hit is None else hit.when(found, F.lit(value))
    return default if hit is None else hit.otherwise(default)


def normalise_category(c: Column, keywords: dict[str, str] | None = None) -> Column:
    """Known topic, else the title-cased original; NULL becomes the catch-all category.

    Keywords match inside longer words on purpose: that is the established behaviour.
    """
    keywords = K.CATEGORY_KEYWORDS if keywords is None else keywords
    unknown = F.lit(None).cast("string")
    topic = let(strip_space(F.lower(c)), lambda folded: first_keyword(folded, keywords, unknown))
    return F.coalesce(F.when(c.isNull(), F.lit(K.OTHER_CATEGORY)), topic, title_case(c))
