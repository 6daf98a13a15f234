"""Cleaning for training data and normalisation ahead of inference."""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from suarakit import constants as K
from suarakit.functions.binding import replace_matches
from suarakit.functions.chars import DIGIT, SPACE, WORD, WORD_END, squeeze_space

_CLEAN_KEEP = rf"{WORD}.,!?;:()\-'"
_NORMAL_KEEP = rf"{WORD}.,!?"


# --- cleaning ---------------------------------------------------------------------------

def strip_urls(c: Column) -> Column:
    """Delete web addresses."""
    return F.regexp_replace(c, rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+", "")


def strip_entities(c: Column) -> Column:
    """Replace lower-case named HTML entities by a blank."""
    return F.regexp_replace(c, r"&[a-z]+;", " ")


def strip_symbols(c: Column) -> Column:
    """Replace everything but words, white space and common punctuation by a blank."""
    return F.regexp_replace(c, rf"[^{_CLEAN_KEEP}{SPACE}]", " ")


def clean_text(c: Column) -> Column:
    """URLs out; entities, symbols and white space become single blanks; NULL becomes ''.

    Entities, symbols and white space all end as one blank per run, so a single pass over
    the text does the work of three. The possessive ``*+`` keeps the regex engine iterative
    on long runs.
    """
    no_urls = strip_urls(F.coalesce(c, F.lit("")))
    # A lone blank between words is already what it should be.
    start = rf"(?: (?=[^{_CLEAN_KEEP}])|[^{_CLEAN_KEEP}& ]|&(?:[a-z]+;)?)"
    rest = rf"(?:[^{_CLEAN_KEEP}&]+|&(?:[a-z]+;)?)*+"
    return F.trim(F.regexp_replace(no_urls, start + rest, " "))


# --- title case -------------------------------------------------------------------------

_CASED = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"


# A Unicode noncharacter: never part of proper text.
_BREAK = "\uffff"


def title_case(c: Column) -> Column:
    """Capitalise every run of cased letters; ``initcap`` only does so after blanks.

    One pass sets a mark and a blank before each run, and both go again afterwards. A text
    that has the mark itself is cut into runs instead.
    """
    marked = F.regexp_replace(c, rf"[{_CASED}]+", rf"{_BREAK} $0")
    runs = F.regexp_extract_all(c, F.lit(rf"[{_CASED}]+|[^{_CASED}]+"), F.lit(0))
    by_run = F.array_join(F.transform(runs, F.initcap), "")
    return F.when(F.contains(c, F.lit(_BREAK)), by_run).otherwise(
        F.replace(F.initcap(marked), F.lit(f"{_BREAK} "), F.lit(""))
    )


# --- slang ------------------------------------------------------------------------------

def _literal_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def lookup(mapping: dict[str, str], key: Column, default: Column | None = None) -> Column:
    """Exact dictionary lookup. The hashed ``isin`` spares most rows the linear map search."""
    value = F.try_element_at(_literal_map(mapping), key)
    return F.when(key.isin(*mapping), value).otherwise(default)


def _known_words(words: Iterable[str]) -> str:
    """Alternatives grouped by first letter, so that most words fail on one comparison each."""
    by_first: dict[str, list[str]] = {}
    for w in words:
        by_first.setdefault(w[0], []).append(re.escape(w[1:]))
    return "|".join(f"{re.escape(first)}(?:{'|'.join(rest)})" for first, rest in by_first.items())


def replace_slang(c: Column, slang: dict[str, str] | None = None, folded: bool = False) -> Column:
    """Replace known short forms, keeping white space and punctuation around them.

    ``folded`` promises lower-case text.
    """
    slang = K.SLANG if slang is None else slang
    edge = re.escape(K.SLANG_EDGE_PUNCTUATION)

    def expand(hit: Column) -> Column:
        word = F.substr(hit, F.lit(2))
        core = F.btrim(word, F.lit(K.SLANG_EDGE_PUNCTUATION))
        long = F.try_element_at(_literal_map(slang), F.lower(core))
        return F.coalesce(F.concat(F.left(hit, F.lit(1)), F.replace(word, core, long)), hit)

    # The flags cover the words only: they would slow down the classes around them.
    known = f"(?{'' if folded else 'iu'}:{_known_words(slang)})"
    pattern = rf"[{SPACE}][{edge}]*+{known}[{edge}]*+(?=[{SPACE}]|\z)"
    # With a blank in front, every word starts after white space.
    words = F.concat(F.lit(" "), c)
    return F.substr(replace_matches(words, pattern, expand), F.lit(2))


def expand_slang(c: Column, slang: dict[str, str] | None = None) -> Column:
    """Replace known short forms word by word; words end up one blank apart."""
    return replace_slang(squeeze_space(c), slang)


# --- normalisation ----------------------------------------------------------------------

# A letter without case that no ordinary text has; with one of these letters it stands for a tag.
_TAG_MARK = "\uaa60"
_TAG_CODES = {tag: _TAG_MARK + code for tag, code in zip(K.PII_TAGS, "abcdefgh")}
_MARK_ITSELF = _TAG_MARK + "z"


def protect_tags(c: Column) -> Column:
    """Swap personal-data tags for word-like codes that lower-casing and cleaning leave alone.

    The mark itself is escaped, so text that holds a code keeps it and never turns into a tag.
    """
    c = F.replace(c, F.lit(_TAG_MARK), F.lit(_MARK_ITSELF))
    for tag, code in _TAG_CODES.items():
        c = F.replace(c, F.lit(f"[{tag}]"), F.lit(code))
    return c


def restore_tags(c: Column) -> Column:
    for tag, code in _TAG_CODES.items():
        c = F.replace(c, F.lit(code), F.lit(f"[{tag}]"))
    return F.replace(c, F.lit(_MARK_ITSELF), F.lit(_TAG_MARK))


def collapse_marks(c: Column) -> Column:
    """Reduce repeated ``!`` or ``?`` to one."""
    return F.regexp_replace(c, r"([!?])\1+", "$1")


def drop_long_numbers(c: Column) -> Column:
    """Delete stand-alone numbers of five digits or more."""
    return F.regexp_replace(c, rf"{DIGIT}(?<![{WORD}]{DIGIT}){DIGIT}{{4,}}{WORD_END}", "")


def keep_plain(c: Column) -> Column:
    """Words and ``.,!?`` stay; every run of anything else becomes one blank."""
    return F.trim(F.regexp_replace(c, rf"[^{_NORMAL_KEEP}]+", " "))


def normalise(c: Column) -> Column:
    """Lower-case, expand slang and reduce to plain text while keeping personal-data tags."""
    # keep_plain squeezes the white space that expand_slang would.
    words = replace_slang(F.lower(protect_tags(c)), folded=True)
    return restore_tags(keep_plain(drop_long_numbers(collapse_marks(words))))
