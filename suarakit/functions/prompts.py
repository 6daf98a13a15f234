"""Prompt and record texts filled from columns."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from suarakit import constants as K


def fill(template: str, limits: dict[str, int] | None = None, **columns: Column) -> Column:
    """Fill ``{name}`` slots from columns; NULL counts as ''. ``limits`` truncates by characters."""
    limits = limits or {}
    parts: list[Column] = []
    for literal, slot, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if slot is not None:
            value = F.coalesce(columns[slot].cast("string"), F.lit(""))
            parts.append(F.left(value, F.lit(limits[slot])) if slot in limits else value)
    return F.concat(*parts)


def inference_input(title: Column, body: Column) -> Column:
    return fill(K.INPUT_TEMPLATE, judul=title, isi=body)


def urgency_prompt(title: Column, body: Column) -> Column:
    return fill(K.URGENCY_PROMPT, K.URGENCY_PROMPT_LIMITS, judul=title, isi=body)


def full_label_prompt(title: Column, body: Column) -> Column:
    return fill(K.FULL_LABEL_PROMPT, K.FULL_LABEL_PROMPT_LIMITS, judul=title, isi=body)


def intake_prompt(text: Column) -> Column:
    """Prompt of the intake job; also the instruction of converted training records."""
    return fill(K.INTAKE_PROMPT, text=text)
