"""Labelling through a user-supplied model, only where labels are missing."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator, Sequence
from inspect import signature

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suarakit import constants as K
from suarakit.functions import jsonx as J
from suarakit.functions import labels as L
from suarakit.functions.binding import compute_once
from suarakit.functions.prompts import full_label_prompt, urgency_prompt
from suarakit.schemas import LABEL_COLUMNS
from suarakit.session import exists, materialise, scratch_path

# Called once per task; returns the function that answers a batch of prompts. A factory with a
# parameter ``system`` gets the task's system instruction by that name.
ModelFactory = Callable[..., Callable[[list[str]], list[str]]]


def ensure_label_columns(df: DataFrame, cols: Sequence[str] = LABEL_COLUMNS) -> DataFrame:
    """Add missing label columns as NULL strings."""
    missing = {c: F.lit(None).cast("string") for c in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df


def ask_model(
    prompts: DataFrame,
    model: ModelFactory,
    id_col: str = "id",
    prompt_col: str = "prompt",
    retries: int = K.MODEL_RETRIES,
    pause: float = 2.0,
    batch_rows: int = 64,
    partitions: int | None = None,
    system: str | None = None,
) -> DataFrame:
    """``id, raw, status`` with the model's answer to each prompt.

    Tasks call the model in parallel, one client each. A failing batch is retried as a whole
    and then row by row, so one bad prompt cannot spoil its neighbours; ``status`` is ``ok``,
    ``timeout`` or ``error``. ``partitions`` deals unevenly left-over work out again, which
    is cheap next to a model call.
    """
    schema = T.StructType(
        [
            prompts.schema[id_col],
            T.StructField("raw", T.StringType()),
            T.StructField("status", T.StringType()),
        ]
    )

    takes_system = "system" in signature(model).parameters

    def attempt(answer, texts: list[str]) -> tuple[list[str] | None, str]:
        status = "error"
        for turn in range(retries + 1):
            try:
                answers = answer(texts)
                if len(answers) != len(texts):
                    raise ValueError("the model must answer every prompt")
                return list(answers), "ok"
            except TimeoutError:
                status = "timeout"
            except Exception:  # any failure of the user's model becomes a status
                status = "error"
            if turn < retries:
                time.sleep(pause)
        return None, status

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = model(system=system) if takes_system else model()
        for pdf in batches:
            for start in range(0, len(pdf), batch_rows):
                part = pdf.iloc[start : start + batch_rows]
                texts = part[prompt_col].tolist()
                raw, status = attempt(answer, texts)
                if raw is not None:
                    statuses = [status] * len(texts)
                else:
                    single = [attempt(answer, [t]) for t in texts] if len(texts) > 1 else [(None, status)]
                    raw = [r[0] if r else None for r, _ in single]
                    statuses = [s for _, s in single]
                yield pd.DataFrame({id_col: part[id_col], "raw": raw, "status": statuses})

    rows = prompts.select(id_col, prompt_col)
    return (rows.repartition(partitions) if partitions else rows).mapInPandas(run, schema)


def ask_model_once(prompts: DataFrame, model: ModelFactory, path: str | None = None, **kw) -> DataFrame:
    """As :func:`ask_model`, with the answers written first and read back.

    A model is slow and need not repeat itself: recomputing a lost partition or running a
    second action must not call it again.
    """
    spark = prompts.sparkSession
    path = path or scratch_path(spark, "responses")
    answers = ask_model(prompts, model, **kw)
    answers.write.mode("errorifexists").parquet(path)
    return spark.read.schema(answers.schema).parquet(path)


LEDGER = T.StructType([T.StructField(n, T.StringType()) for n in ("prompt_key", "raw", "status")])


def ask_with_ledger(
    prompts: DataFrame,
    model: ModelFactory,
    ledger: str,
    id_col: str = "id",
    prompt_col: str = "prompt",
    rows_per_slice: int = 50_000,
    **kw,
) -> DataFrame:
    """As :func:`ask_model`, through a table of answers that outlives the job.

    Answers are known by the content of the prompt and of the system instruction, and are appended
    slice by slice. A job that dies loses the answers of one slice; the next one asks only what
    the table has no good answer to. Equal prompts are asked once, whatever their ids; failed calls are
    noted and asked again by the next job. ``id, raw, status`` for every row.
    """
    spark = prompts.sparkSession
    key = F.sha2(F.to_json(F.array(F.lit(kw.get("system")), F.col(prompt_col))), 256)
    keyed = materialise(prompts.select(id_col, prompt_col, key.alias("prompt_key")))

    def answered() -> DataFrame:
        """One row for each prompt asked so far, good answers first."""
        if not exists(spark, ledger):
            return spark.createDataFrame([], LEDGER)
        rows = spark.read.schema(LEDGER).parquet(ledger)
        best = rows.groupBy("prompt_key").agg(F.min(F.struct(F.col("status") != "ok", "status", "raw")).alias("_best"))
        return best.select("prompt_key", F.col("_best.raw").alias("raw"), F.col("_best.status").alias("status"))

    good = answered().where("status = 'ok'").select("prompt_key")
    todo = keyed.select("prompt_key", prompt_col).dropDuplicates(["prompt_key"]).join(good, "prompt_key", "left_anti")
    todo = materialise(todo)
    slices = math.ceil(todo.count() / rows_per_slice)
    for i in range(slices):
        part = todo.where(F.pmod(F.xxhash64("prompt_key"), F.lit(slices)) == i)
        answers = ask_model(part, model, "prompt_key", prompt_col, **kw)
        answers.select(*LEDGER.fieldNames()).write.mode("append").parquet(ledger)
    return keyed.join(answered(), "prompt_key", "left").select(id_col, "raw", "status")


# Names a row by its whole content, so rows without an id or with a repeated one stay apart;
# rows equal in everything get the same labels.
ROW = "_row"


def with_row_key(df: DataFrame) -> DataFrame:
    return df.withColumn(ROW, F.sha2(F.to_json(F.struct(*df.columns)), 256))


def one_per_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    """One row for each id that is not null; of several the first in the order of their content."""
    rest = [c for c in df.columns if c != id_col]
    one = df.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(F.struct(*rest)).alias("_one"))
    return one.select(id_col, *[F.col("_one")[c].alias(c) for c in rest])


def write_back(df: DataFrame, labels: DataFrame, cols: Sequence[str], id_col: str = "id") -> DataFrame:
    """Replace ``cols`` where ``labels`` has a row for the id; keep the rest.

    ``labels`` has at most one row for each id, so rows neither multiply nor get lost.
    """
    marked = labels.select(
        id_col, F.lit(True).alias("_new"), *[F.col(c).alias(f"_n_{c}") for c in cols]
    )
    joined = df.join(marked, id_col, "left")
    fresh = {c: F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(c)) for c in cols}
    return joined.withColumns(fresh).select(*df.columns)


def resume(base: DataFrame, previous: DataFrame | None, cols: Sequence[str], id_col: str = "id") -> DataFrame:
    """Rows of ``base`` with the labels an earlier run produced, if there was one.

    Rows are found again by their id and all other columns that both tables have besides the
    labels, null by null, so a repeated or missing id does no harm: what the earlier run wrote
    for a row goes to that row. Where the id is all they share, rows without one start without
    labels. Of earlier rows that are equal in all this the first by its labels counts.
    """
    base = ensure_label_columns(base, cols)
    if previous is None:
        return base
    shared = [c for c in base.columns if c in previous.columns and c not in cols and c != id_col]
    # Ids are compared by how they print: a table read back from CSV may have another type.
    texts = F.to_json(F.array(*[F.col(c).cast("string") for c in [id_col, *shared]]))
    key = F.sha2(texts, 256) if shared else F.when(F.col(id_col).isNotNull(), F.sha2(texts, 256))
    earlier = one_per_id(previous.withColumn(ROW, key).select(ROW, *cols), ROW)
    return write_back(base.withColumn(ROW, key), earlier, cols, ROW).drop(ROW)


def stored_answers(answers: DataFrame, id_col: str = "id") -> Callable[[DataFrame], DataFrame]:
    """Answers ``id, raw, status`` kept from earlier, as ``responses`` of :func:`annotate`."""
    one = one_per_id(answers.select(id_col, "raw", "status"), id_col)
    return lambda work: work.select(ROW, id_col).join(one, id_col).select(ROW, "raw", "status")


def annotate(
    df: DataFrame,
    todo: Column,
    responses: Callable[[DataFrame], DataFrame],
    parse: Callable[[DataFrame], DataFrame],
    cols: Sequence[str],
    needs: Sequence[str] = (),
    restart: bool = False,
    inspect: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Label the rows where ``todo`` holds and write the labels back, row by row.

    ``responses`` turns those rows into ``_row, raw, status``: a model call or a join with
    stored answers. ``parse`` turns the answers, with the columns ``needs`` of their rows, into
    label columns. ``restart`` ignores existing labels; ``inspect`` gets the answers. There are as many rows out as in,
    whatever their ids: rows are known by their content, and equal ones are asked about once.
    """
    df = with_row_key(ensure_label_columns(df, cols))
    work = df if restart else df.filter(todo)
    answers = responses(work)
    if inspect is not None:
        inspect(answers)
    answered = work.select(ROW, *needs).distinct().join(answers.dropDuplicates([ROW]), ROW)
    return write_back(df, parse(answered).select(ROW, *cols), cols, ROW).drop(ROW)


def parse_urgency(answered: DataFrame) -> DataFrame:
    return answered.withColumn("urgency", L.urgency_label(F.col("raw"), F.col("status")))


def parse_full_labels(answered: DataFrame) -> DataFrame:
    """Validated labels from raw answers; failed calls yield the defaults."""
    raw = F.coalesce(F.col("raw"), F.lit(""))
    parsed = compute_once(answered, _labels=L.validate(raw, F.col("kategori")))
    return parsed.withColumns({c: F.col(f"_labels.{c}") for c in LABEL_COLUMNS}).drop("_labels")


def annotate_urgency(
    df: DataFrame,
    model: ModelFactory,
    restart: bool = False,
    inspect: Callable[[DataFrame], None] | None = None,
    ledger: str | None = None,
    **kw,
) -> DataFrame:
    """Fill ``urgency`` where it is not yet a valid label.

    ``ledger`` names a table that keeps answers for later runs.
    """

    def call(work: DataFrame) -> DataFrame:
        prompts = work.select(ROW, urgency_prompt(F.col("judul"), F.col("isi")).alias("prompt")).dropDuplicates([ROW])
        if ledger:
            return ask_with_ledger(prompts, model, ledger, id_col=ROW, **kw)
        return ask_model_once(prompts, model, id_col=ROW, **kw)

    todo = L.needs_urgency(F.col("urgency"))
    return annotate(df, todo, call, parse_urgency, ("urgency",), restart=restart, inspect=inspect)


def annotate_full(
    df: DataFrame,
    model: ModelFactory,
    restart: bool = False,
    nullable: tuple[str, ...] = (),
    inspect: Callable[[DataFrame], None] | None = None,
    ledger: str | None = None,
    **kw,
) -> DataFrame:
    """Fill all seven labels of incompletely labelled rows.

    The model gets the system instruction of this task if its factory takes ``system``.
    ``ledger`` names a table that keeps answers for later runs.
    """

    def call(work: DataFrame) -> DataFrame:
        prompts = work.select(ROW, full_label_prompt(F.col("judul"), F.col("isi")).alias("prompt"))
        prompts = prompts.dropDuplicates([ROW])
        options = {"pause": 3.0, "system": K.FULL_LABEL_SYSTEM, **kw}
        if ledger:
            return ask_with_ledger(prompts, model, ledger, id_col=ROW, **options)
        return ask_model_once(prompts, model, id_col=ROW, **options)

    todo = ~L.is_complete(nullable)
    return annotate(df, todo, call, parse_full_labels, LABEL_COLUMNS, ("kategori",), restart, inspect)


def intake_labels(masked: DataFrame, responses: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows with ``status`` and parsed ``result`` (VARIANT, NULL if unusable) per answer."""
    joined = masked.join(responses.select(id_col, "raw"), id_col, "left")
    parsed = compute_once(joined, result=J.parse_tolerant(F.col("raw")))
    return parsed.withColumn("parsed", J.truthy(F.col("result")))
