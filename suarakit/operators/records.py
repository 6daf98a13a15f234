"""Training records and schema conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from suarakit import constants as K
from suarakit.functions import jsonx as J
from suarakit.functions import labels as L
from suarakit.functions.binding import compute_once, let
from suarakit.functions.chars import strip_space
from suarakit.functions.prompts import inference_input, intake_prompt
from suarakit.operators.quality import drop_blank_lines
from suarakit.schemas import LABEL_COLUMNS


def finetune_records(clean: DataFrame, id_col: str = "id") -> DataFrame:
    """``record`` (id, system, user, label) per clean row; only the category is known yet.

    ``record`` is NULL where the id is no integer; see :func:`split_bad`.
    """
    number = F.col(id_col).cast("string").try_cast("bigint")
    names = ["kategori"] + [c for c in LABEL_COLUMNS if c != "kategori"]
    label = F.struct(
        *[(F.col(c) if c == "kategori" else F.lit(None).cast("string")).alias(c) for c in names]
    )
    record = F.struct(
        number.alias("id"),
        F.lit(K.FINETUNE_SYSTEM).alias("system"),
        F.col("input_text").alias("user"),
        label.alias("label"),
    )
    return clean.withColumn("record", F.when(number.isNotNull(), record))


def split_bad(df: DataFrame, col: str = "record") -> tuple[DataFrame, DataFrame]:
    """Rows with and without a value in ``col``: the good ones and the quarantine."""
    return df.filter(F.col(col).isNotNull()), df.filter(F.col(col).isNull())


def instruction_records(
    annotated: DataFrame, nullable: tuple[str, ...] = ()
) -> DataFrame:
    """``instruction, input, output`` for completely labelled rows."""
    return annotated.filter(L.is_complete(nullable)).select(
        F.lit(K.TRAINING_INSTRUCTION).alias("instruction"),
        inference_input(F.col("judul"), F.col("isi")).alias("input"),
        L.output_json().alias("output"),
    )


def export_counts(annotated: DataFrame, nullable: tuple[str, ...] = ()) -> DataFrame:
    """One row: how many rows an export writes and skips."""
    done = L.is_complete(nullable)
    return annotated.agg(
        F.count_if(done).alias("written"), F.count_if(~done).alias("skipped")
    )


def _input_text(v: Column) -> Column:
    """Text of an ``input`` member: absent is '', a JSON null prints as ``None``."""
    return (
        F.when(v.isNull(), "").when(J.kind(v) == "null", "None").otherwise(J.as_text(v))
    )


def convert_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Convert JSON lines of schema-1 records to schema 2.

    Adds ``record`` (instruction, input, output), NULL for lines that cannot be read or
    converted; blank lines vanish. Each line is parsed once, and a record that lacks an
    output converts as if it held an empty object.
    """

    def convert(v: Column) -> Column:
        output = J.member(v, "output")
        old = F.when(output.isNull(), F.lit("{}")).when(
            J.kind(output) == "string", J.as_text(output)
        )
        new = L.convert_output(old)
        record = F.struct(
            intake_prompt(_input_text(J.member(v, "input"))).alias("instruction"),
            F.lit("").alias("input"),
            new.alias("output"),
        )
        return F.when((J.kind(v) == "object") & new.isNotNull(), record)

    parsed = J.parse_strict(strip_space(F.col(col)))
    return compute_once(drop_blank_lines(lines, col), record=let(parsed, convert))


def conversation_records(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, instruction, input, output`` for each user turn answered next.

    Turns pair up by an equi-join on the turn number; no conversation is gathered in one task.
    """
    asked = turns.filter("role = 'user'").select(
        "conv_id", "turn", F.col("text").alias("question")
    )
    answered = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(answered, ["conv_id", "turn"]).select(
        "conv_id",
        "turn",
        F.lit(K.TRAINING_INSTRUCTION).alias("instruction"),
        F.col("question").alias("input"),
        F.col("answer").alias("output"),
    )
