"""Queries on model answers, label validation, conversion and re-annotation."""

from __future__ import annotations

from pyspark.sql import functions as F

from suarakit import constants as K
from suarakit.catalog import sql as S
from suarakit.catalog.tables import (
    ANNOTATED, CONTACT_TEXT, MODEL_ANSWER, annotated, contact_text, documents, model_answer, table,
)
from suarakit.functions import jsonx, labels
from suarakit.functions.binding import compute_once
from suarakit.operators import annotate as A
from suarakit.plans import jobs
from suarakit.schemas import LABEL_COLUMNS
from suarakit.session import scratch_path, spread

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def _answers(spark, sf):
    docs = documents(spark, sf, "doc_id", "text", "source", "lang")
    return compute_once(docs, raw=model_answer())


_PARSED = f"""raw AS (SELECT *, {MODEL_ANSWER} AS raw FROM documents),
j AS MATERIALIZED (SELECT doc_id, source, lang, raw, {S.parsed('raw')} AS j FROM raw)"""


@query(f"""WITH {_PARSED}
SELECT doc_id, CASE WHEN j IS NULL THEN 'unparsable' WHEN json_type(j) = 'OBJECT' THEN 'ok' ELSE 'not_object' END AS status,
  json_extract_string(j, '$.intent') AS intent, json_extract_string(j, '$.ringkasan') AS ringkasan FROM j""")
def parse_json_tolerant(spark, sf):
    parsed = compute_once(_answers(spark, sf), v=jsonx.parse_tolerant(F.col("raw")))
    return parsed.select(
        "doc_id",
        jsonx.status(F.col("v")).alias("status"),
        jsonx.as_text(jsonx.member(F.col("v"), "intent")).alias("intent"),
        jsonx.as_text(jsonx.member(F.col("v"), "ringkasan")).alias("ringkasan"),
    )


@query("""SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k,
  NOT json_valid('note: ' || props || ' end') AS noisy_is_bad FROM events""")
def parse_event_props(spark, sf):
    """Strict parsing accepts the properties as they are and rejects them inside other text."""
    events = spread(table(spark, sf, "events").select("event_id", "props"))
    noisy = F.concat(F.lit("note: "), "props", F.lit(" end"))
    return events.select(
        "event_id",
        F.try_variant_get(jsonx.parse_tolerant(noisy), F.lit("$.k"), "bigint").alias("k"),
        jsonx.parse_strict(noisy).isNull().alias("noisy_is_bad"),
    )


def _validated(j: str, original: str) -> str:
    location = S.truthy(j, "location")
    lower = lambda key: f"lower({S.string_of(j, key)})"
    return f"""{S.one_of(lower('intent'), K.INTENTS, "'complaint'")} AS intent,
  {S.one_of(S.string_of(j, 'kategori'), K.CATEGORIES, f"coalesce(nullif({original}, ''), 'Lainnya')")} AS kategori,
  CASE WHEN lower({location}) NOT IN ('null', 'none', '-', '') THEN {location} END AS location,
  coalesce({S.truthy(j, 'object', 'objek')}, '') AS object,
  {S.one_of(lower('urgency'), K.URGENCIES, "'medium'")} AS urgency,
  {S.one_of(lower('sentiment'), K.SENTIMENTS, "'netral'")} AS sentiment,
  coalesce({S.truthy(j, 'summary', 'ringkasan')}, '') AS summary"""


@query(f"""WITH {_PARSED} SELECT doc_id, {_validated('j', "CASE WHEN lang = 'de' THEN 'Kesehatan' END")} FROM j""")
def validate_labels(spark, sf):
    original = F.when(F.col("lang") == "de", "Kesehatan")
    checked = compute_once(_answers(spark, sf), l=labels.validate(F.col("raw"), original))
    return checked.select("doc_id", "l.*")


_CONVERTED = f"""{S.mapped(f"lower({S.string_of('j', 'intent')})", K.INTENT_V2, 'complaint')} AS intent,
  {S.mapped("CASE WHEN json_exists(j, '$.kategori') THEN " + S.string_of('j', 'kategori') + " ELSE " + S.string_of('j', 'category') + " END", K.CATEGORY_V2, 'lainnya')} AS category,
  {S.truthy('j', 'location', 'lokasi')} AS location,
  coalesce({S.truthy('j', 'object', 'objek')}, '') AS object,
  {S.one_of(f"lower({S.string_of('j', 'urgency')})", K.URGENCIES, "'medium'")} AS urgency,
  {S.mapped(f"lower({S.string_of('j', 'sentiment')})", K.SENTIMENT_V2, 'neutral')} AS sentiment,
  coalesce({S.truthy('j', 'summary', 'ringkasan')}, '') AS summary"""
_V2 = ("intent", "category", "location", "object", "urgency", "sentiment", "summary")


@query(f"""WITH {_PARSED}, c AS (SELECT doc_id, {_CONVERTED} FROM j WHERE json_type(j) = 'OBJECT')
SELECT doc_id, CASE WHEN j.j IS NULL THEN 'unchanged' WHEN c.doc_id IS NULL THEN 'failed' ELSE 'converted' END AS outcome,
  {', '.join(_V2)} FROM j LEFT JOIN c USING (doc_id)""")
def convert_labels(spark, sf):
    done = compute_once(_answers(spark, sf), out=labels.convert_output(F.col("raw")))
    v = jsonx.parse_strict(F.col("out"))
    outcome = (
        F.when(F.col("out").isNull(), "failed").when(F.col("out") == F.col("raw"), "unchanged").otherwise("converted")
    )
    parsed = compute_once(done, outcome=outcome, v=v)
    text = lambda k: jsonx.as_text(jsonx.first_truthy(jsonx.member(F.col("v"), k)))
    default = {"object": "", "summary": ""}
    return parsed.select(
        "doc_id",
        "outcome",
        *[
            F.when(
                F.col("outcome") == "converted",
                F.coalesce(text(k), F.lit(default[k])) if k in default else text(k),
            ).alias(k)
            for k in _V2
        ],
    )


@query(f"""WITH {ANNOTATED} SELECT id, urgency IS NULL OR urgency NOT IN ('high', 'medium', 'low') AS needs_urgency,
  {' AND '.join(f"regexp_matches(coalesce({c}, ''), '[^{S.SPACE}]')" for c in LABEL_COLUMNS)} AS complete,
  {' AND '.join(f"regexp_matches(coalesce({c}, ''), '[^{S.SPACE}]')" for c in LABEL_COLUMNS if c != 'location')} AS complete_but_location
FROM annotated""")
def complete_rows(spark, sf):
    return annotated(spark, sf).select(
        "id",
        labels.needs_urgency(F.col("urgency")).alias("needs_urgency"),
        labels.is_complete().alias("complete"),
        labels.is_complete(("location",)).alias("complete_but_location"),
    )


@query(f"""WITH {ANNOTATED}, {_PARSED},
v AS (SELECT a.id, {_validated('j.j', 'a.kategori')} FROM j JOIN annotated a USING (doc_id)),
a AS (SELECT *, {' AND '.join(f"regexp_matches(coalesce({c}, ''), '[^{S.SPACE}]')" for c in LABEL_COLUMNS)} AS done FROM annotated),
u AS (SELECT * FROM a UNION ALL SELECT * FROM a WHERE doc_id % 5 = 0)
SELECT CASE WHEN a.doc_id % 11 <> 0 THEN a.id END AS id, a.doc_id,
  {', '.join(f'CASE WHEN done OR a.doc_id % 11 = 0 THEN a.{c} ELSE v.{c} END AS {c}' for c in LABEL_COLUMNS)}
FROM u a JOIN v USING (id)""")
def annotate_resume_merge(spark, sf):
    """Rows with missing labels get them from stored model answers; complete rows keep theirs.

    Some rows come twice, and some without an id, for which no answer is stored.
    """
    answers = _answers(spark, sf).select(
        F.col("doc_id").cast("string").alias("id"), "raw", F.lit("ok").alias("status")
    )
    rows = annotated(spark, sf).withColumn("id", F.when(F.col("doc_id") % 11 != 0, F.col("id")))
    done = jobs.annotated_with(rows.unionByName(rows.filter("doc_id % 5 = 0")), answers)
    return done.select("id", "doc_id", *LABEL_COLUMNS)


def _length_model():
    """Stand-in for a model: urgency by prompt length."""
    return lambda texts: [("so high!", "Medium.", "hmm")[len(t) % 3] for t in texts]


_BY_LENGTH = f"""WITH {ANNOTATED}, p AS (SELECT *, length({S.fill(K.URGENCY_PROMPT, K.URGENCY_PROMPT_LIMITS, judul='judul', isi='isi')}) AS n
  FROM annotated)
SELECT CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 'same' ELSE id END AS id, doc_id,
  CASE WHEN urgency IS NOT NULL THEN urgency ELSE (['high', 'medium', 'unknown'])[n % 3 + 1] END AS urgency FROM p"""


@query(_BY_LENGTH)
def annotate_urgency_with_model(spark, sf):
    """Rows with missing and repeated ids are labelled like all others."""
    d = F.col("doc_id")
    rows = annotated(spark, sf).withColumn("id", F.when(d % 11 == 0, None).when(d % 7 == 0, "same").otherwise(F.col("id")))
    return A.annotate_urgency(rows, _length_model).select("id", "doc_id", "urgency")


@query(_BY_LENGTH)
def annotate_with_ledger(spark, sf):
    """A first run over some sources, a second one over all: it asks only what the ledger does not know."""
    d = F.col("doc_id")
    rows = annotated(spark, sf).withColumn("id", F.when(d % 11 == 0, None).when(d % 7 == 0, "same").otherwise(F.col("id")))
    ledger = scratch_path(spark, "ledger")
    A.annotate_urgency(rows.filter("judul < 'src2'"), _length_model, ledger=ledger)
    return A.annotate_urgency(rows, _length_model, ledger=ledger).select("id", "doc_id", "urgency")


@query(f"""WITH {ANNOTATED}, n AS (SELECT doc_id::VARCHAR AS id, source AS judul, text AS isi FROM documents)
SELECT n.id, a.urgency, a.summary FROM n JOIN annotated a USING (id)""")
def resume_previous_labels(spark, sf):
    """A fresh input without label columns takes up what an earlier run produced."""
    done = annotated(spark, sf).filter(F.col("urgency").isNotNull()).select("id", "urgency", "summary")
    base = documents(spark, sf, "doc_id", "text", "source").select(
        F.col("doc_id").cast("string").alias("id"), F.col("source").alias("judul"), F.col("text").alias("isi")
    )
    return A.resume(base, done, ("urgency", "summary")).select("id", "urgency", "summary")


_TWICE = "(SELECT * FROM documents UNION ALL SELECT doc_id, text || ' (2)', lang, source, n_chars FROM documents WHERE doc_id % 5 = 0)"


@query(f"""WITH d AS (SELECT *, CASE WHEN doc_id % 11 <> 0 THEN doc_id % 50 END AS id FROM {_TWICE})
SELECT id, sha256(coalesce(text, '')) AS body, CASE WHEN bool_or(doc_id % 3 <> 0) OVER (PARTITION BY id, source, text)
  THEN CASE WHEN length(text) % 2 = 0 THEN 'high' ELSE 'low' END END AS urgency FROM d""")
def resume_row_by_row(spark, sf):
    """An earlier run's labels find their rows although ids repeat, are missing, and are numbers here, text there."""
    docs = documents(spark, sf, "doc_id", "text", "source")
    docs = docs.unionByName(docs.filter("doc_id % 5 = 0").withColumn("text", F.concat("text", F.lit(" (2)"))))
    base = docs.select(
        F.expr("CASE WHEN doc_id % 11 <> 0 THEN doc_id % 50 END").alias("id"), F.col("source").alias("judul"), F.col("text").alias("isi"),
        (F.col("doc_id") % 3).alias("rest"),
    )
    done = base.filter("rest <> 0").select(
        F.col("id").cast("string").alias("id"), "judul", "isi", F.when(F.length("isi") % 2 == 0, "high").otherwise("low").alias("urgency")
    )
    found = A.resume(base.drop("rest"), done, ("urgency",))
    return found.select("id", F.sha2(F.coalesce("isi", F.lit("")), 256).alias("body"), "urgency")


_MASKED = S.staged("documents", "doc_id", CONTACT_TEXT, S.email, S.mobile, S.landline, S.numbers)


@query(f"""WITH {_PARSED}, m AS ({_MASKED})
SELECT doc_id, coalesce(j NOT IN ('[]', '{{}}', 'null', '""', '0', 'false'), false) AS parsed,
  CASE WHEN json_type(j) = 'OBJECT' THEN json_extract_string(j, '$.urgency') END AS urgency,
  len(regexp_extract_all(t, '\\[(?:EMAIL|PHONE|NIK|REKENING)\\]'))::INT AS tags
FROM j JOIN m USING (doc_id)""")
def intake_results(spark, sf):
    """Mask, prompt, stored answer, parse."""
    docs = documents(spark, sf, "doc_id", "text").withColumn("isi", contact_text())
    # The stored answer, and the signs of the raw text, computed before anything is joined.
    known = _answers(spark, sf).select("doc_id", "raw", F.regexp_count("text", F.lit("@")).alias("signs"))

    def answered(prompts):
        """The stored answer, with what the model could see of the personal data."""
        seen = F.size(F.split("prompt", r"\[(?:EMAIL|PHONE|NIK|REKENING)\]", -1)) - 1
        at = F.regexp_count("prompt", F.lit("@"))
        narrow = prompts.select("doc_id", seen.alias("seen"), at.alias("at")).join(known, "doc_id")
        # One sign stays by the rule: no address ends before an underscore.
        leak = F.concat(F.lit("leak "), F.col("seen").cast("string"))
        return narrow.select("doc_id", F.when(F.col("at") > F.col("signs") + 1, leak).otherwise(F.col("raw")).alias("raw"))

    result = jobs.intake(docs, answered, id_col="doc_id", text_col="isi")
    return result.select(
        "doc_id", "parsed", F.try_variant_get("result", F.lit("$.urgency"), "string").alias("urgency"),
        F.regexp_count("masked", F.lit(r"\[(?:EMAIL|PHONE|NIK|REKENING)\]")).alias("tags"),
    )
