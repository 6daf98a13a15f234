"""The fixture tables read as complaints.

``documents`` plays the complaint table: ``text`` is the body, ``source`` the title and
``doc_id`` the order of arrival. The fixture has none of the words and numbers some operators
look for, so a few are woven in by rules that exist here once in Spark and once in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suarakit import constants as K
from suarakit.session import prepare, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The requested columns, dealt out to all cores for text work."""
    return spread(table(spark, sf_dir, "documents").select(*columns))


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def number(c: Column, digits: int) -> Column:
    return F.lpad(c.cast("string"), digits, "0")


# --- category ---------------------------------------------------------------------------

_KEYWORDS = list(K.CATEGORY_KEYWORDS)


def raw_category() -> Column:
    """Missing, a known keyword in capitals, an unknown name, or the whole body."""
    key = F.element_at(
        F.array(*[F.lit(k) for k in _KEYWORDS]), (F.col("doc_id") % len(_KEYWORDS) + 1).cast("int")
    )
    kind = F.col("doc_id") % 4
    return (
        F.when(kind == 0, F.lit(None).cast("string"))
        .when(kind == 1, F.concat(F.upper(key), F.lit(" "), F.col("source")))
        .when(kind == 2, F.concat(F.lit("  "), F.col("source"), F.lit(" o'brien-"), F.col("lang")))
        .otherwise(F.col("text"))
    )


RAW_CATEGORY = f"""CASE doc_id % 4 WHEN 0 THEN NULL
  WHEN 1 THEN upper(([{', '.join(quoted(k) for k in _KEYWORDS)}])[doc_id % {len(_KEYWORDS)} + 1]) || ' ' || source
  WHEN 2 THEN '  ' || source || ' o''brien-' || lang ELSE text END"""


# --- personal data ----------------------------------------------------------------------

def contact_text() -> Column:
    """The body followed by made-up contact details."""
    d = F.col("doc_id")
    return F.concat(
        F.col("text"),
        F.lit(" Telp 021-"), number(d * 7919 % 10000000, 7),
        F.lit(" HP 08"), number(d * 104729 % 10000000000, 10),
        F.lit(" atau +62 812 "), number(d % 10000, 4), F.lit("-"), number(d * 31 % 10000, 4),
        F.lit(", NIK 357812"), number(d * 37 % 80, 2), number(d % 15, 2), F.lit("98"), number(d % 10000, 4),
        F.lit(" email u"), d.cast("string"), F.lit("@mail.example.com rek "), number(d * 65537 % 100000000000, 11),
        F.lit(". Kantor 0341 555"), number(d % 1000, 3),
        F.lit(" surel a@x.co-b"), d.cast("string"), F.lit("@y.id.c@z.org%d@w.net+e@v.com _f@u.com, -g@t.co_h@s.info"),
    )


CONTACT_TEXT = """text || ' Telp 021-' || lpad((doc_id * 7919 % 10000000)::VARCHAR, 7, '0')
  || ' HP 08' || lpad((doc_id * 104729 % 10000000000)::VARCHAR, 10, '0')
  || ' atau +62 812 ' || lpad((doc_id % 10000)::VARCHAR, 4, '0') || '-' || lpad((doc_id * 31 % 10000)::VARCHAR, 4, '0')
  || ', NIK 357812' || lpad((doc_id * 37 % 80)::VARCHAR, 2, '0') || lpad((doc_id % 15)::VARCHAR, 2, '0')
  || '98' || lpad((doc_id % 10000)::VARCHAR, 4, '0')
  || ' email u' || doc_id::VARCHAR || '@mail.example.com rek ' || lpad((doc_id * 65537 % 100000000000)::VARCHAR, 11, '0')
  || '. Kantor 0341 555' || lpad((doc_id % 1000)::VARCHAR, 3, '0')
  || ' surel a@x.co-b' || doc_id::VARCHAR || '@y.id.c@z.org%d@w.net+e@v.com _f@u.com, -g@t.co_h@s.info'"""


# --- slang ------------------------------------------------------------------------------

_SLANG = list(K.SLANG)


def slang_text() -> Column:
    """The body among short forms, tags and marks."""
    word = F.element_at(
        F.array(*[F.lit(k) for k in _SLANG]), (F.col("doc_id") % len(_SLANG) + 1).cast("int")
    )
    return F.concat(
        F.lit("Jln "), F.col("source"), F.lit(" bgt, [NIK] "), F.col("text"),
        F.lit(" (YG) tdk; "), word, F.lit("!! [PHONE]"), F.col("doc_id").cast("string"),
        F.lit(" no 1234567 - 12345? ?? __pii_nik__ __PII_phone__ \uaa60a"),
    )


SLANG_TEXT = f"""'Jln ' || source || ' bgt, [NIK] ' || text || ' (YG) tdk; '
  || ([{', '.join(quoted(k) for k in _SLANG)}])[doc_id % {len(_SLANG)} + 1]
  || '!! [PHONE]' || doc_id::VARCHAR || ' no 1234567 - 12345? ?? __pii_nik__ __PII_phone__ \uaa60a'"""


# --- model answers ----------------------------------------------------------------------

def _json_text() -> Column:
    plain = F.regexp_replace("text", r"[\x00-\x1f\x7f]", " ")
    return F.replace(
        F.replace(plain, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')
    )


_JSON_TEXT = r"""replace(replace(regexp_replace(text, '[\x00-\x1f\x7f]', ' ', 'g'), '\', '\\'), '"', '\"')"""

# doc_id % 8 -> pieces of the answer; #body, #source and #lang stand for columns.
_ANSWERS = (
    ('{"intent":"Report","kategori":"Lingkungan","location":"None","objek":"', "#lang",
     '","urgency":"HIGH","sentiment":"Negatif","ringkasan":"', "#body", '"}'),
    ('Berikut hasilnya: {"intent":"question","kategori":"Sosial","location":"', "#source",
     '","object":"', "#lang", '","urgency":"low","sentiment":"netral","summary":"', "#body", '"} selesai'),
    ("#text",),
    ('{"intent":"spam","kategori":"lingkungan","urgency":"tinggi","object":["a",1],"summary":"', "#body", '"}'),
    ("[1,2]",),
    ("",),
    ('{"kategori":null,"category":"Lingkungan","location":"","lokasi":"', "#source",
     '","sentiment":"positif","summary":0,"ringkasan":"', "#body", '"}'),
    ('{"a":1} {"b":"', "#body", '"}'),
)


def model_answer() -> Column:
    """A model answer in one of eight shapes, from clean JSON to plain text."""
    columns = {
        "#body": _json_text(), "#text": F.col("text"), "#source": F.col("source"), "#lang": F.col("lang")
    }
    answer = None
    for i, pieces in enumerate(_ANSWERS):
        value = F.concat(*[columns.get(p, F.lit(p)) for p in pieces])
        cond = F.col("doc_id") % 8 == i
        answer = F.when(cond, value) if answer is None else answer.when(cond, value)
    return answer


_PIECES = {"#body": _JSON_TEXT, "#text": "text", "#source": "source", "#lang": "lang"}
MODEL_ANSWER = "CASE doc_id % 8 " + " ".join(
    f"WHEN {i} THEN " + " || ".join(_PIECES.get(p, quoted(p)) for p in pieces)
    for i, pieces in enumerate(_ANSWERS)
) + " END"


# --- annotated complaints ---------------------------------------------------------------

def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complaints with the labels the ``labels`` table can supply; the rest is missing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    joined = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    toxic, good, bad = F.col("toxic") == 1, F.col("quality") == 1, F.col("quality") == 0
    return joined.select(
        F.col("doc_id").cast("string").alias("id"),
        "doc_id",
        F.col("source").alias("judul"),
        F.col("text").alias("isi"),
        F.when(good, "Sosial").when(bad, "Lingkungan").alias("kategori"),
        F.when(good, "report").when(bad, "question").alias("intent"),
        F.when(F.col("lang") != "fr", F.col("source")).alias("location"),
        F.col("lang").alias("object"),
        F.when(toxic, "high").when(good, "medium").when(bad, "low").alias("urgency"),
        F.when(toxic, "negatif").when(good, "positif").when(bad, "netral").alias("sentiment"),
        F.when(bad & ~toxic, F.lit(" \t ")).when(good | bad, F.col("source")).alias("summary"),
    )


ANNOTATED = """annotated AS (
  SELECT doc_id::VARCHAR AS id, doc_id, source AS judul, text AS isi,
    CASE quality WHEN 1 THEN 'Sosial' WHEN 0 THEN 'Lingkungan' END AS kategori,
    CASE quality WHEN 1 THEN 'report' WHEN 0 THEN 'question' END AS intent,
    CASE WHEN lang <> 'fr' THEN source END AS location,
    lang AS object,
    CASE WHEN toxic = 1 THEN 'high' WHEN quality = 1 THEN 'medium' WHEN quality = 0 THEN 'low' END AS urgency,
    CASE WHEN toxic = 1 THEN 'negatif' WHEN quality = 1 THEN 'positif' WHEN quality = 0 THEN 'netral' END AS sentiment,
    CASE WHEN quality = 0 AND toxic = 0 THEN chr(32) || chr(9) || chr(32) WHEN quality IS NOT NULL THEN source END AS summary
  FROM documents LEFT JOIN labels USING (doc_id))"""
