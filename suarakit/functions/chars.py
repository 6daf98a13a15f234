"""Character classes spelled out, so results do not depend on the regex engine's defaults.

``\\w``, ``\\s`` and ``\\b`` differ between engines and between Java versions. The classes
below follow the Unicode reading: letters, numbers and underscore form words, and every
Unicode separator counts as white space.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
SPACE = r"\p{Z}\x09-\x0d\x1c-\x1f\x85"
DIGIT = r"\p{Nd}"

WORD_END = rf"(?![{WORD}])"
WORD_EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"


def strip_space(c: Column) -> Column:
    """Remove white space of any kind from both ends (``trim`` knows only the blank)."""
    return F.regexp_replace(c, rf"^[{SPACE}]+|[{SPACE}]+\z", "")


def squeeze_space(c: Column) -> Column:
    """Turn every run of white space into one blank and strip both ends."""
    return F.trim(F.regexp_replace(c, rf"[{SPACE}]+", " "))


def is_blank(c: Column) -> Column:
    """True for text without any visible character; NULL stays NULL."""
    return ~F.rlike(c, F.lit(rf"[^{SPACE}]"))
