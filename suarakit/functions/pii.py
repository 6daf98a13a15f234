"""Masking of e-mail addresses, phone numbers, national ids and account numbers."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from suarakit import constants as K
from suarakit.functions.binding import let, replace_matches
from suarakit.functions.chars import DIGIT, SPACE, WORD, WORD_EDGE, WORD_END

# The shapes that count as personal data. Most of a text is skipped fastest by a
# pattern that starts with a character and looks at its surroundings afterwards.
_LOCAL = "A-Za-z0-9._%+-"
_DOMAIN = r"@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}"
# An address starts at the first word edge of the characters before its @; group 1 precedes it.
# Those characters begin after any other one, or right where the address before them ended.
EMAIL = (
    rf"(?:(?<![{_LOCAL}])|\G)(?=[{_LOCAL}]++@)([{_LOCAL}]*?){WORD_EDGE}[{_LOCAL}]++{_DOMAIN}{WORD_EDGE}"
)
MOBILE = rf"(\+62|08)([{SPACE}]?[{DIGIT}-]{{2,4}}){{2,4}}{WORD_EDGE}"
# All area codes start with 0.
LANDLINE = (
    rf"0(?<![{WORD}]0)(?:{'|'.join(code[1:] for code in K.AREA_CODES)})"
    rf"[{SPACE}-]?{DIGIT}{{3,4}}[{SPACE}-]?{DIGIT}{{3,4}}{WORD_END}"
)
LONG_NUMBER = (
    rf"{DIGIT}(?<![{WORD}]{DIGIT})[{SPACE}.-]?(?:{DIGIT}[{SPACE}.-]?){{9,15}}{WORD_EDGE}"
)


def mask_email(c: Column) -> Column:
    masked = F.regexp_replace(c, EMAIL, "$1[EMAIL]")
    return F.when(F.contains(c, F.lit("@")), masked).otherwise(c)


def mask_mobile(c: Column) -> Column:
    """Mask mobile numbers whose length, separators aside, is plausible."""

    def decide(hit: Column) -> Column:
        size = F.length(F.regexp_replace(hit, rf"[{SPACE}-]", ""))
        return F.when(size.between(9, 15), F.lit("[PHONE]")).otherwise(hit)

    return replace_matches(c, MOBILE, decide)


def mask_landline(c: Column) -> Column:
    return F.regexp_replace(c, LANDLINE, "[PHONE]")


# All decimal digits outside ASCII, and the ASCII digit of each.
_OTHER = [chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"]
_OTHER_DIGITS = ("".join(_OTHER), "".join(str(unicodedata.decimal(c)) for c in _OTHER))


def is_valid_nik(c: Column) -> Column:
    """16 digits, of any script, holding a plausible birth day (women: day + 40) and month; NULL is invalid."""

    def check(given: Column) -> Column:
        return let(F.when(F.rlike(given, F.lit(r"[^\x00-\x7F]")), F.translate(given, *_OTHER_DIGITS)).otherwise(given), plain)

    def plain(digits: Column) -> Column:
        day = F.substring(digits, 7, 2).try_cast("int")
        month = F.substring(digits, 9, 2).try_cast("int")
        plausible = (day.between(1, 31) | day.between(41, 71)) & month.between(1, 12)
        return F.rlike(digits, F.lit(rf"^{DIGIT}{{16}}\z")) & plausible

    return F.coalesce(let(F.regexp_replace(c, rf"[{SPACE}.-]", ""), check), F.lit(False))


def mask_numbers(c: Column) -> Column:
    """Mask numbers of 10 to 16 digits as national id or account number.

    A separator right after the number belongs to the match and goes with it.
    """
    return replace_matches(
        c, LONG_NUMBER, lambda hit: F.when(is_valid_nik(hit), "[NIK]").otherwise("[REKENING]")
    )


def mask_pii(c: Column) -> Column:
    """All four masks; the order decides which tag an ambiguous number gets."""
    return mask_numbers(mask_landline(mask_mobile(mask_email(c))))
