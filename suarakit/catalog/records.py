"""Queries on training records and files."""

from __future__ import annotations

from pyspark.sql import functions as F

from suarakit import constants as K
from suarakit.catalog import sql as S
from suarakit.catalog.labelling import _CONVERTED, _V2
from suarakit.catalog.tables import (
    ANNOTATED, MODEL_ANSWER, annotated, documents, model_answer, quoted, table,
)
from suarakit.functions.prompts import inference_input
from suarakit.operators import records
from suarakit.plans import jobs
from suarakit.schemas import LABEL_COLUMNS, RAW_COMPLAINT
from suarakit.session import scratch_path
from suarakit.sources import readers, writers
from suarakit.sources.csv_records import read_csv_split

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def _finetune(spark, sf):
    """Documents of one language carry ids that are no numbers."""
    docs = documents(spark, sf, "doc_id", "text", "source", "lang")
    clean = docs.select(
        F.when(F.col("lang") == "es", F.concat(F.lit("x"), F.col("doc_id").cast("string")))
        .otherwise(F.col("doc_id").cast("string")).alias("id"),
        F.col("source").alias("kategori"),
        inference_input(F.col("source"), F.col("text")).alias("input_text"),
    )
    return records.finetune_records(clean)


_FINETUNE_SQL = f"""SELECT doc_id AS id, {quoted(K.FINETUNE_SYSTEM)} AS system,
  {S.fill(K.INPUT_TEMPLATE, judul='source', isi='text')} AS user, source AS kategori,
  {', '.join(f'NULL::VARCHAR AS {c}' for c in LABEL_COLUMNS if c != 'kategori')} FROM documents WHERE lang <> 'es'"""


@query(_FINETUNE_SQL)
def finetune_records(spark, sf):
    good, _ = records.split_bad(_finetune(spark, sf))
    return good.select(
        "record.id", "record.system", "record.user", *[f"record.label.{c}" for c in LABEL_COLUMNS]
    )


@query("SELECT 'x' || doc_id AS id FROM documents WHERE lang = 'es'")
def finetune_quarantine(spark, sf):
    return records.split_bad(_finetune(spark, sf))[1].select("id")


@query(_FINETUNE_SQL)
def finetune_jsonl_file(spark, sf):
    """Records written as JSON lines and read back."""
    path = scratch_path(spark, "finetune")
    writers.write_records(_finetune(spark, sf), path)
    back = spark.read.schema(
        f"id long, system string, user string, label struct<{', '.join(f'{c}: string' for c in LABEL_COLUMNS)}>"
    ).json(path)
    return back.select("id", "system", "user", *[f"label.{c}" for c in LABEL_COLUMNS])


_COMPLETE = " AND ".join(f"regexp_matches(coalesce({c}, ''), '[^{S.SPACE}]')" for c in LABEL_COLUMNS)


@query(f"""WITH {ANNOTATED} SELECT {quoted(K.TRAINING_INSTRUCTION)} AS instruction,
  {S.fill(K.INPUT_TEMPLATE, judul='judul', isi='isi')} AS input, {', '.join(LABEL_COLUMNS)}
FROM annotated WHERE {_COMPLETE}""")
def instruction_records(spark, sf):
    made = records.instruction_records(annotated(spark, sf))
    schema = "struct<" + ", ".join(f"{c}: string" for c in LABEL_COLUMNS) + ">"
    return made.select("instruction", "input", F.from_json("output", schema).alias("o")).select(
        "instruction", "input", "o.*"
    )


@query(f"""WITH {ANNOTATED} SELECT count(*) FILTER (WHERE {_COMPLETE}) AS written,
  count(*) FILTER (WHERE NOT ({_COMPLETE})) AS skipped FROM annotated""")
def skipped_count(spark, sf):
    return records.export_counts(annotated(spark, sf))


@query(f"""SELECT u.conv_id, u.turn, {quoted(K.TRAINING_INSTRUCTION)} AS instruction, u.text AS input, a.text AS output
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'""")
def conversation_records(spark, sf):
    return records.conversation_records(table(spark, sf, "conversations"))


def _jsonl_lines(spark, sf):
    """Instruction records whose output is a model answer, as JSON lines.

    Lines of three languages are damaged in three ways, and some records have no output.
    """
    docs = documents(spark, sf, "doc_id", "text", "source", "lang")
    record = F.to_json(
        F.struct(F.lit("i").alias("instruction"), F.col("source").alias("input"), model_answer().alias("output"))
    )
    lang = F.col("lang")
    line = (
        F.when(lang == "fr", F.concat(record, F.lit(" x")))
        .when(lang == "es", F.lit(" \t"))
        .when(lang == "de", F.concat(F.lit('["'), "source", F.lit('"]')))
        .when(F.col("source").isin("src1", "src7"), F.concat(F.lit('{"input":"'), "source", F.lit('"}')))
        .otherwise(F.concat(F.lit("  "), record))
    )
    return docs.select("doc_id", line.alias("value"))


_LINES = f"""r AS (SELECT doc_id, source, CASE WHEN source IN ('src1', 'src7') THEN '{{}}' ELSE {MODEL_ANSWER} END AS raw
  FROM documents WHERE lang NOT IN ('fr', 'es', 'de')),
j AS MATERIALIZED (SELECT *, {S.parsed('raw')} AS j FROM r),
c AS (SELECT doc_id, {_CONVERTED} FROM j WHERE json_type(j) = 'OBJECT'),
kept AS (SELECT j.doc_id, j.source, j.j IS NULL AS unchanged, {', '.join(f'c.{n}' for n in _V2)}
  FROM j LEFT JOIN c USING (doc_id) WHERE j.j IS NULL OR c.doc_id IS NOT NULL)"""


@query(f"""WITH {_LINES}
SELECT doc_id, {S.fill(K.INTAKE_PROMPT, text='source')} AS instruction, '' AS input,
  unchanged, {', '.join(_V2)}
FROM kept""")
def convert_jsonl(spark, sf):
    """Line by line conversion; damaged lines and records without an object are left out."""
    good, _ = records.split_bad(records.convert_lines(_jsonl_lines(spark, sf)))
    schema = "struct<" + ", ".join(f"{n}: string" for n in _V2) + ">"
    looks_json = F.startswith("record.output", F.lit('{"intent":')) & F.contains(
        "record.output", F.lit('"category":')
    ) & F.endswith("record.output", F.lit("}"))
    return good.select(
        "doc_id", "record.instruction", "record.input", (~looks_json).alias("unchanged"),
        F.when(looks_json, F.from_json("record.output", schema)).alias("o"),
    ).select("doc_id", "instruction", "input", "unchanged", "o.*")


@query(f"""WITH {_LINES}
SELECT {S.fill(K.INTAKE_PROMPT, text='source')} AS instruction, '' AS input, unchanged, {', '.join(_V2)} FROM kept""")
def converted_jsonl_file(spark, sf):
    """Converted records written as JSON lines and read back."""
    path = scratch_path(spark, "converted")
    writers.write_records(records.convert_lines(_jsonl_lines(spark, sf)), path)
    back = spark.read.schema("instruction string, input string, output string").json(path)
    looks_json = F.startswith("output", F.lit('{"intent":')) & F.contains("output", F.lit('"category":')) & F.endswith(
        "output", F.lit("}")
    )
    schema = "struct<" + ", ".join(f"{n}: string" for n in _V2) + ">"
    return back.select(
        "instruction", "input", (~looks_json).alias("unchanged"), F.when(looks_json, F.from_json("output", schema)).alias("o")
    ).select("instruction", "input", "unchanged", "o.*")


@query(f"""WITH {_LINES} SELECT doc_id FROM documents WHERE lang <> 'es' AND doc_id NOT IN (SELECT doc_id FROM kept)""")
def convert_jsonl_quarantine(spark, sf):
    return records.split_bad(records.convert_lines(_jsonl_lines(spark, sf)))[1].select("doc_id")


@query(f"WITH {_LINES} " + " UNION ALL ".join(
    f"SELECT '{c}' AS field, {c} AS value, count(*) AS count FROM kept GROUP BY {c}"
    for c in ("intent", "category", "urgency", "sentiment")
))
def converted_distributions(spark, sf):
    """Lines written to a file, read, converted and counted."""
    path = scratch_path(spark, "lines")
    _jsonl_lines(spark, sf).select("value").write.text(path)
    return jobs.converted_distributions(readers.read_converted_jsonl(spark, path))


_CSV = """SELECT doc_id::VARCHAR AS id, '  ' || source || ' ' AS judul, text || chr(10) || ' ' AS isi,
  CASE WHEN lang <> 'fr' THEN lang END AS kategori, 'https://example.org/' || doc_id AS url FROM documents"""


def _written_csv(spark, sf):
    path = scratch_path(spark, "csv")
    docs = documents(spark, sf, "doc_id", "text", "source", "lang")
    complaints = docs.select(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("  "), F.col("source"), F.lit(" ")).alias("judul"),
        F.concat(F.col("text"), F.lit("\n ")).alias("isi"),
        F.when(F.col("lang") != "fr", F.col("lang")).alias("kategori"),
        F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string")).alias("url"),
    ).select(*RAW_COMPLAINT.fieldNames())
    writers.write_csv(complaints, path)
    return path


@query(_CSV)
def csv_file(spark, sf):
    """Complaints with quotes, line breaks and outer blanks written as CSV and read back."""
    return readers.read_csv(spark, _written_csv(spark, sf))


@query(_CSV)
def csv_split_file(spark, sf):
    """The same files, read by as many tasks as they have splits."""
    return read_csv_split(spark, _written_csv(spark, sf))


@query("""SELECT doc_id, source, CASE WHEN lang <> 'fr' THEN lang END AS lang, text FROM documents""")
def json_file(spark, sf):
    path = scratch_path(spark, "json")
    docs = documents(spark, sf, "doc_id", "source", "lang", "text")
    writers.write_json(docs.withColumn("lang", F.when(F.col("lang") != "fr", F.col("lang"))), path)
    return spark.read.schema("doc_id long, source string, lang string, text string").json(path)
