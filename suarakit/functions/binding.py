"""Evaluate an expression once and use it several times; replace matches by a rule."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A Column used n times in an expression is computed up to n times, and nesting such
    expressions multiplies the work. A one-element array binds it to a lambda variable.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns that several later steps use, each computed once per row.

    The optimizer copies a projected expression into every filter above it and evaluates it
    again there. It does not look into a generator, so the columns pass through one.
    """
    made = F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    kept = [F.col(c) for c in df.columns if c not in columns]
    names = df.columns + [n for n in columns if n not in df.columns]
    return df.select(*kept, made).select(*names)


# A Unicode noncharacter: never part of proper text.
_MARK = "\uffff"


def replace_matches(c: Column, pattern: str, decide: Callable[[Column], Column]) -> Column:
    """Replace every match of ``pattern`` by ``decide(match)``, without leaving the JVM.

    One pass sets each match between marks, so that the matches are every second piece when
    the text is split there. A text that contains the mark is cut by two more passes instead.
    """

    def by_mark(text: Column) -> Column:
        marked = F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}")
        return F.transform(
            F.split(marked, _MARK, -1),
            lambda piece, i: F.when(i % 2 == 1, decide(piece)).otherwise(piece),
        )

    def by_position(text: Column) -> Column:
        # One more gap than matches: the last gap pairs with NULL.
        return F.transform(
            F.arrays_zip(
                F.split(text, pattern, -1).alias("gap"),
                F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
            ),
            lambda z: F.concat(
                z["gap"], F.when(z["hit"].isNull(), F.lit("")).otherwise(decide(z["hit"]))
            ),
        )

    def rebuild(text: Column) -> Column:
        pieces = F.when(F.contains(text, F.lit(_MARK)), by_position(text)).otherwise(by_mark(text))
        return F.array_join(pieces, "")

    return let(c, rebuild)
