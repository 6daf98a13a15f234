"""SQL expressions giving the expected value of the text functions, step by step."""

from __future__ import annotations

from dataclasses import dataclass
from string import Formatter

from suarakit import constants as K
from suarakit.catalog.tables import quoted

WORD = r"\p{L}\p{N}_"
SPACE = r"\p{Z}\x09-\x0d\x1c-\x1f\x{85}"


def sub(x: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({x}, {quoted(pattern)}, {quoted(replacement)}, 'g')"


def squeeze(x: str) -> str:
    return f"trim({sub(x, f'[{SPACE}]+', ' ')})"


def strip_space(x: str) -> str:
    return sub(x, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def strip_urls(x: str) -> str:
    return sub(x, rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+", "")


def strip_entities(x: str) -> str:
    return sub(x, r"&[a-z]+;", " ")


def strip_symbols(x: str) -> str:
    return sub(x, rf"[^{WORD}{SPACE}.,!?;:()\-']", " ")


def clean(x: str) -> str:
    return squeeze(strip_symbols(strip_entities(strip_urls(f"coalesce({x}, '')"))))


def title(x: str) -> str:
    # upper() maps letter to letter, but the sharp s titles to two letters.
    cased = r"\p{Lu}\p{Ll}\p{Lt}"
    first = "CASE w[1] WHEN 'ß' THEN 'Ss' ELSE upper(w[1]) END"
    runs = f"regexp_extract_all({x}, '[{cased}]+|[^{cased}]+')"
    return f"array_to_string(list_transform({runs}, lambda w: {first} || lower(w[2:])), '')"


def category(x: str) -> str:
    whens = " ".join(
        f"WHEN contains({strip_space(f'lower({x})')}, {quoted(k)}) THEN {quoted(v)}"
        for k, v in K.CATEGORY_KEYWORDS.items()
    )
    return f"CASE WHEN {x} IS NULL THEN 'Lainnya' {whens} ELSE {title(x)} END"


def slang(x: str) -> str:
    keys = ", ".join(quoted(k) for k in K.SLANG)
    values = ", ".join(quoted(v) for v in K.SLANG.values())
    core = f"trim(w, {quoted(K.SLANG_EDGE_PUNCTUATION)})"
    at = f"list_position([{keys}], lower({core}))"
    word = f"CASE WHEN coalesce({at}, 0) > 0 THEN replace(w, {core}, ([{values}])[{at}]) ELSE w END"
    return f"array_to_string(list_transform(string_split({squeeze(x)}, ' '), lambda w: {word}), ' ')"


def normalise(x: str) -> str:
    # One letter of a dead script for each tag; the fixture has none of them.
    stand_in = dict(zip(K.PII_TAGS, "𐤀𐤁𐤂𐤃"))
    marked = x
    for tag, letter in stand_in.items():
        marked = f"replace({marked}, '[{tag}]', '{letter}')"
    out = sub(slang(f"lower({marked})"), rf"[^{WORD}{SPACE}.,!?]", " ")
    out = sub(sub(out, "!{2,}", "!"), r"\?{2,}", "?")
    out = squeeze(sub(out, r"\b\p{Nd}{5,}\b", ""))
    for tag, letter in stand_in.items():
        out = f"replace({out}, '{letter}', '[{tag}]')"
    return out


@dataclass(frozen=True)
class Callback:
    """Step replacing matches of a pattern without letters; ``decide`` is an expression over
    ``hit``.

    This engine's word boundary knows ASCII only. Matching runs on a shadow of the text with
    every letter as ``x``; the text between matches is then cut from the original by position.
    """

    pattern: str
    decide: str

    def ctes(self, key: str, source: str, target: str) -> list[str]:
        shadow = sub("t", r"[\p{L}\p{No}\p{Nl}]", "x")
        size = "coalesce(list_sum(list_transform({}[:i - 1], lambda g: length(g))), 0)::BIGINT".format
        gap = f"substr(t, 1 + {size('gaps')} + {size('hits')}, length(gaps[i]))"
        piece = f"{gap} || CASE WHEN hits[i] IS NULL THEN '' ELSE {self.decide.replace('hit', 'hits[i]')} END"
        return [
            f"{target}a AS MATERIALIZED (SELECT {key}, t, string_split_regex({shadow}, {quoted(self.pattern)}) AS gaps, "
            f"regexp_extract_all({shadow}, {quoted(self.pattern)}) AS hits FROM {source})",
            f"{target} AS MATERIALIZED (SELECT {key}, array_to_string(list_transform(range(1, len(gaps) + 1), "
            f"lambda i: {piece}), '') AS t FROM {target}a)",
        ]


def email(x: str) -> str:
    return sub(x, r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "[EMAIL]")


def nik(x: str) -> str:
    digits = sub(x, f"[{SPACE}.-]", "")
    day, month = f"try_cast({digits}[7:8] AS INT)", f"try_cast({digits}[9:10] AS INT)"
    return (
        f"(regexp_full_match({digits}, '[0-9]{{16}}') AND ({day} BETWEEN 1 AND 31 OR {day} BETWEEN 41 AND 71) "
        f"AND {month} BETWEEN 1 AND 12)"
    )


mobile = Callback(
    rf"(\+62|08)([{SPACE}]?[\p{{Nd}}-]{{2,4}}){{2,4}}\b",
    f"CASE WHEN length({sub('hit', f'[{SPACE}-]', '')}) BETWEEN 9 AND 15 THEN '[PHONE]' ELSE hit END",
)
landline = Callback(
    rf"\b(?:{'|'.join(K.AREA_CODES)})[{SPACE}-]?\p{{Nd}}{{3,4}}[{SPACE}-]?\p{{Nd}}{{3,4}}\b", "'[PHONE]'"
)
numbers = Callback(
    rf"\b(?:\p{{Nd}}[{SPACE}.-]?){{10,16}}\b",
    f"CASE WHEN {nik('hit')} THEN '[NIK]' ELSE '[REKENING]' END",
)


def staged(source: str, key: str, column: str, *steps) -> str:
    """CTEs applying the steps one after another, so that no step is repeated in the text."""
    parts = [f"s0 AS (SELECT {key}, {column} AS t FROM {source})"]
    for i, step in enumerate(steps, 1):
        if isinstance(step, Callback):
            parts += step.ctes(key, f"s{i - 1}", f"s{i}")
        else:
            parts.append(f"s{i} AS MATERIALIZED (SELECT {key}, {step('t')} AS t FROM s{i - 1})")
    return "WITH " + ", ".join(parts) + f" SELECT {key}, t FROM s{len(steps)}"


def parsed(raw: str) -> str:
    """JSON text of a tolerant parse, or NULL."""
    braces = rf"regexp_extract({raw}, '(?s)\{{.*\}}')"
    return f"CASE WHEN json_valid({raw}) THEN {raw} WHEN json_valid({braces}) THEN {braces} END"


def string_of(j: str, key: str) -> str:
    return f"CASE WHEN json_type({j}, '$.{key}') = 'VARCHAR' THEN json_extract_string({j}, '$.{key}') END"


def truthy(j: str, *keys: str) -> str:
    """Text of the first member that is neither absent, null, empty nor zero."""
    parts = [
        f"CASE WHEN json_extract({j}, '$.{k}')::VARCHAR NOT IN ('null', '\"\"', 'false', '0', '[]', '{{}}') "
        f"THEN json_extract_string({j}, '$.{k}') END"
        for k in keys
    ]
    return f"coalesce({', '.join(parts)})"


def mapped(x: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in mapping.items())
    return f"CASE {x} {whens} ELSE {quoted(default)} END"


def one_of(x: str, allowed: tuple[str, ...], default: str) -> str:
    values = ", ".join(quoted(a) for a in allowed)
    return f"CASE WHEN {x} IN ({values}) THEN {x} ELSE {default} END"


def fill(template: str, limits: dict[str, int] | None = None, **columns: str) -> str:
    parts = []
    for literal, slot, _, _ in Formatter().parse(template):
        if literal:
            parts.append(quoted(literal))
        if slot is not None:
            value = f"coalesce({columns[slot]}, '')"
            parts.append(f"left({value}, {limits[slot]})" if limits and slot in limits else value)
    return " || ".join(parts)
