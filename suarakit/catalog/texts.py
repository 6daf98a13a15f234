"""Queries on cleaning, normalisation, masking and prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from suarakit import constants as K
from suarakit.catalog import sql as S
from suarakit.catalog.tables import (
    CONTACT_TEXT, RAW_CATEGORY, SLANG_TEXT, contact_text, documents, number, quoted, raw_category,
    slang_text, table,
)
from suarakit.functions import category, labels, pii, prompts, text
from suarakit.operators import dictionaries
from suarakit.plans import jobs
from suarakit.session import spread

QUERIES, SQL = {}, {}

_PAGE_TEXT = "url || ' ' || html"


def _pages(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", F.concat("url", F.lit(" "), "html").alias("t"))


def _on_pages(name, fn, sql):
    QUERIES[name] = lambda spark, sf: _pages(spark, sf).select("page_id", fn(F.col("t")).alias("t"))
    SQL[name] = S.staged("pages", "page_id", _PAGE_TEXT, *sql)


def _on_documents(name, fn, *sql, column=None, column_sql="text"):
    def query(spark, sf):
        docs = documents(spark, sf, "doc_id", "text", "source", "lang")
        return docs.select("doc_id", fn(F.col("text") if column is None else column()).alias("t"))

    QUERIES[name] = query
    SQL[name] = S.staged("documents", "doc_id", column_sql, *sql)


_on_pages("strip_urls", text.strip_urls, [S.strip_urls])
_on_pages("strip_entities", text.strip_entities, [S.strip_entities])
_on_pages("clean_text_pages", text.clean_text, [S.clean])
_on_documents("strip_symbols", text.strip_symbols, S.strip_symbols)
_on_documents("clean_text", text.clean_text, S.clean)
_on_documents("title_case", text.title_case, S.title)
_on_documents(
    "category_normalise", category.normalise_category, S.category,
    column=raw_category, column_sql=RAW_CATEGORY,
)
_on_documents("slang_expand", text.expand_slang, S.slang, column=slang_text, column_sql=SLANG_TEXT)
_on_documents("normalise_text", text.normalise, S.normalise, column=slang_text, column_sql=SLANG_TEXT)
for _name, _fn, _steps in (
    ("mask_email", pii.mask_email, (S.email,)),
    ("mask_mobile", pii.mask_mobile, (S.mobile,)),
    ("mask_landline", pii.mask_landline, (S.landline,)),
    ("mask_numbers", pii.mask_numbers, (S.numbers,)),
    ("mask_pii", pii.mask_pii, (S.email, S.mobile, S.landline, S.numbers)),
):
    _on_documents(_name, _fn, *_steps, column=contact_text, column_sql=CONTACT_TEXT)


def _nik():
    d = F.col("doc_id")
    return F.concat(
        F.lit("3578"), F.when(d % 3 == 0, "-").otherwise(""), F.lit("01"), number(d * 7 % 90, 2),
        F.when(d % 5 == 0, ".").otherwise(""), number(d % 14, 2), F.lit("90"),
        F.when(d % 11 == 0, "12").otherwise("1234"),
    )


def nik_validity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    return docs.withColumn("nik", _nik()).withColumn("valid", pii.is_valid_nik(F.col("nik")))


QUERIES["nik_validity"] = nik_validity
SQL["nik_validity"] = f"""WITH n AS (SELECT doc_id, '3578' || CASE WHEN doc_id % 3 = 0 THEN '-' ELSE '' END || '01'
  || lpad((doc_id * 7 % 90)::VARCHAR, 2, '0') || CASE WHEN doc_id % 5 = 0 THEN '.' ELSE '' END
  || lpad((doc_id % 14)::VARCHAR, 2, '0') || '90' || CASE WHEN doc_id % 11 = 0 THEN '12' ELSE '1234' END AS nik
  FROM documents) SELECT doc_id, nik, {S.nik('nik')} AS valid FROM n"""


def niks_in_texts(spark, sf):
    """Every long number of every text, and whether it can be a national id."""
    docs = documents(spark, sf, "doc_id", "text")
    numbers = docs.select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit("[0-9]{12,}"), F.lit(0))).alias("place", "nik"))
    return numbers.withColumn("valid", pii.is_valid_nik(F.col("nik")))


QUERIES["niks_in_texts"] = niks_in_texts
SQL["niks_in_texts"] = f"""WITH n AS (SELECT doc_id, (i - 1)::INT AS place, l[i] AS nik FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '[0-9]{{12,}}') AS l FROM documents)))
SELECT doc_id, place, nik, {S.nik('nik')} AS valid FROM n"""


_WORDS = ("jawaban: HIGH.", "medium-high", "", "below", "tinggi")


def _urgency_answer():
    word = F.element_at(
        F.array(*[F.lit(w) for w in _WORDS]), (F.col("doc_id") % len(_WORDS) + 1).cast("int")
    )
    return F.concat(word, F.lit(" "), F.col("text"))


def _status():
    d = F.col("doc_id")
    return F.when(d % 13 == 0, "timeout").when(d % 17 == 0, "error").otherwise("ok")


def urgency_from_text(spark, sf):
    docs = documents(spark, sf, "doc_id", "text")
    return docs.select("doc_id", labels.urgency_label(_urgency_answer(), _status()).alias("urgency"))


QUERIES["urgency_from_text"] = urgency_from_text
SQL["urgency_from_text"] = f"""WITH a AS (
  SELECT doc_id, lower(([{', '.join(map(quoted, _WORDS))}])[doc_id % {len(_WORDS)} + 1] || ' ' || text) AS t FROM documents)
SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN 'error_timeout' WHEN doc_id % 17 = 0 THEN 'error'
  WHEN contains(t, 'high') THEN 'high' WHEN contains(t, 'medium') THEN 'medium'
  WHEN contains(t, 'low') THEN 'low' ELSE 'unknown' END AS urgency FROM a"""


def prompt_texts(spark, sf):
    docs = documents(spark, sf, "doc_id", "text", "source")
    title, body = F.col("source"), F.col("text")
    return docs.select(
        "doc_id",
        prompts.inference_input(title, body).alias("input_text"),
        prompts.urgency_prompt(title, body).alias("urgency_prompt"),
        prompts.full_label_prompt(title, body).alias("full_prompt"),
    )


QUERIES["prompt_texts"] = prompt_texts
SQL["prompt_texts"] = f"""SELECT doc_id,
  {S.fill(K.INPUT_TEMPLATE, judul='source', isi='text')} AS input_text,
  {S.fill(K.URGENCY_PROMPT, K.URGENCY_PROMPT_LIMITS, judul='source', isi='text')} AS urgency_prompt,
  {S.fill(K.FULL_LABEL_PROMPT, K.FULL_LABEL_PROMPT_LIMITS, judul='source', isi='text')} AS full_prompt
FROM documents"""


def intake_prompts(spark, sf):
    docs = documents(spark, sf, "doc_id", "text").withColumn("isi", contact_text())
    return jobs.masked_prompts(docs).select("doc_id", "masked", "prompt")


QUERIES["intake_prompts"] = intake_prompts
SQL["intake_prompts"] = (
    f"WITH m AS ({S.staged('documents', 'doc_id', CONTACT_TEXT, S.email, S.mobile, S.landline, S.numbers)}) "
    f"SELECT doc_id, t AS masked, {S.fill(K.INTAKE_PROMPT, text='t')} AS prompt FROM m"
)


_LONG_WORDS = "SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{10,}')) AS word FROM benchmark"


def keywords_from_table(spark, sf):
    """The longest word of the benchmark that occurs anywhere in a document, by an automaton over all of them."""
    words = table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{10,}"), F.lit(0))).alias("word"))
    ranked = words.distinct().select(F.struct(-F.length("word"), "word").alias("rank"), "word", F.col("word").alias("value"))
    docs = documents(spark, sf, "doc_id", "text").select("doc_id", F.lower("text").alias("text"))
    return dictionaries.first_keyword(docs, "text", ranked).select("doc_id", "value")


QUERIES["keywords_from_table"] = keywords_from_table
SQL["keywords_from_table"] = f"""WITH words AS (SELECT word, row_number() OVER (ORDER BY length(word) DESC, word) AS rank FROM ({_LONG_WORDS})),
hits AS (SELECT doc_id, min(rank) AS rank FROM documents JOIN words ON contains(lower(text), word) GROUP BY doc_id)
SELECT doc_id, word AS value FROM documents LEFT JOIN hits USING (doc_id) LEFT JOIN words USING (rank)"""


def slang_from_table(spark, sf):
    """Short forms expanded from a dictionary of a million entries, as from the inlined one."""
    docs = documents(spark, sf, "doc_id", "text", "source").select("doc_id", slang_text().alias("t"))
    known = spark.createDataFrame(list(K.SLANG.items()), "word string, long string")
    others = spark.range(1_000_000).select(F.concat(F.lit("entri"), "id").alias("word"), F.lit("lain").alias("long"))
    return dictionaries.expand_words(docs, "t", known.unionByName(others))


QUERIES["slang_from_table"] = slang_from_table
SQL["slang_from_table"] = SQL["slang_expand"]
