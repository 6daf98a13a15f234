"""Queries on filtering, exact duplicates, incremental intake and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from suarakit import constants as K
from suarakit.catalog import sql as S
from suarakit.catalog.tables import (
    ANNOTATED, CONTACT_TEXT, RAW_CATEGORY, annotated, contact_text, documents, raw_category, table,
)
from suarakit.functions import labels
from suarakit.functions.binding import compute_once
from suarakit.functions.pii import mask_pii
from suarakit.functions.text import clean_text
from suarakit.operators import ingest, quality, report
from suarakit.plans import jobs

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


@query(f"""WITH m AS ({S.staged('documents', 'doc_id, source', 'text', S.email, S.mobile, S.landline, S.numbers, S.clean)}),
k AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id) AS rn FROM m WHERE length(t) >= 20)
SELECT source, count(*) AS complaints FROM k WHERE rn = 1 GROUP BY source""")
def clean_complaints_per_source(spark, sf):
    """Mask, clean, filter, keep first copies, count."""
    docs = documents(spark, sf, "doc_id", "text", "source")
    clean = compute_once(docs, text=clean_text(mask_pii(F.col("text"))))
    kept = quality.filter_quality(clean, "doc_id", body="text", title=None)
    return kept.groupBy("source").agg(F.count("*").alias("complaints"))


@query("""WITH k AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents
  WHERE text IS NOT NULL AND source IS NOT NULL AND length(text) >= 20)
SELECT doc_id, text, source, lang FROM k WHERE rn = 1""")
def quality_filter_keep_first(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "source", "lang")
    return quality.filter_quality(docs, "doc_id", body="text", title="source")


@query(f"""WITH c AS MATERIALIZED (SELECT doc_id::VARCHAR AS id, doc_id AS seq, source, {S.clean('text')} AS isi,
    {RAW_CATEGORY} AS rawcat FROM documents),
k AS (SELECT *, row_number() OVER (PARTITION BY isi ORDER BY seq) AS rn FROM c WHERE length(isi) >= 20)
SELECT id, {S.clean('source')} AS judul, isi, {S.category('rawcat')} AS kategori, seq,
  'Judul: ' || {S.clean('source')} || chr(10) || 'Laporan: ' || isi AS input_text
FROM k WHERE rn = 1""")
def preprocess_complaints(spark, sf):
    """The whole preprocessing job short of its files."""
    raw = documents(spark, sf, "doc_id", "text", "source", "lang").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("judul"),
        F.col("text").alias("isi"),
        raw_category().alias("kategori"),
        F.lit("https://example.org/").alias("url"),
        F.col("doc_id").alias("seq"),
    )
    return jobs.clean_complaints(raw, "seq")


@query(f"""WITH c AS (SELECT {S.category('k')} AS value FROM (SELECT {RAW_CATEGORY} AS k FROM documents))
SELECT value, count(*) AS count FROM c GROUP BY value""")
def category_distribution(spark, sf):
    docs = documents(spark, sf, "doc_id", "text", "source", "lang")
    normal = quality.normalise_categories(docs.withColumn("kategori", raw_category()))
    return report.value_counts(normal, "kategori")


@query(f"""WITH {ANNOTATED}, c AS (SELECT urgency AS value, count(*) AS count FROM annotated
  WHERE urgency IS NOT NULL GROUP BY 1)
SELECT value, count, round_even(count / (SELECT sum(count) FROM c) * 100, 1) AS pct FROM c""")
def label_distribution_pct(spark, sf):
    return report.value_percentages(annotated(spark, sf), "urgency")


_FIELDS = ("intent", "kategori", "urgency", "sentiment")


@query(f"""WITH {ANNOTATED} """ + " UNION ALL ".join(
    f"SELECT '{c}' AS field, {c} AS value, count(*) AS count FROM annotated WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in _FIELDS
))
def label_distributions_one_pass(spark, sf):
    return report.label_distributions(annotated(spark, sf), _FIELDS)


@query(f"""WITH {ANNOTATED}, r AS (SELECT *, row_number() OVER (PARTITION BY urgency ORDER BY doc_id) AS rn
  FROM annotated WHERE urgency IN ('high', 'medium', 'low'))
SELECT id, urgency, left(judul, 80) AS judul, left(isi, 100) AS isi FROM r WHERE rn <= 2""")
def label_samples(spark, sf):
    rows = annotated(spark, sf).select("doc_id", "id", "urgency", "judul", "isi")
    return report.samples_per_label(
        rows, "urgency", "doc_id", values=K.URGENCIES, limits={"judul": 80, "isi": 100}
    ).drop("doc_id")


@query(f"""WITH {ANNOTATED} SELECT id, left(judul, 60) AS judul, intent, urgency, sentiment, summary
FROM annotated WHERE summary IS NOT NULL ORDER BY doc_id LIMIT 3""")
def preview(spark, sf):
    rows = annotated(spark, sf).na.drop(subset=["summary"])
    top = report.preview(rows, "doc_id", limits={"judul": 60})
    return top.select("id", "judul", "intent", "urgency", "sentiment", "summary")


@query(f"""WITH {ANNOTATED} SELECT count(*) AS total,
  count(*) FILTER (WHERE urgency IS NULL OR urgency NOT IN ('high', 'medium', 'low')) AS todo,
  count(*) FILTER (WHERE length(isi) < 20) AS too_short,
  count(*) FILTER (WHERE coalesce(summary, '') = '') AS empty_summary FROM annotated""")
def run_counters(spark, sf):
    return report.counters(
        annotated(spark, sf),
        todo=labels.needs_urgency(F.col("urgency")),
        too_short=F.length("isi") < K.MIN_BODY_LENGTH,
        empty_summary=F.coalesce(F.col("summary"), F.lit("")) == "",
    )


@query(f"""WITH {ANNOTATED} SELECT id, coalesce(id, '') = '' OR coalesce(location, '') = '' OR coalesce(isi, '') = ''
  AS is_incomplete FROM annotated""")
def incomplete_flags(spark, sf):
    rows = quality.flag_incomplete(annotated(spark, sf), ("id", "location", "isi"))
    return rows.select("id", "is_incomplete")


@query(rf"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS value FROM documents)
SELECT doc_id, count(*) AS lines FROM l WHERE regexp_matches(value, '[^{S.SPACE}]') GROUP BY doc_id""")
def non_blank_lines(spark, sf):
    docs = documents(spark, sf, "doc_id", "text")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("value"))
    return quality.drop_blank_lines(lines).groupBy("doc_id").agg(F.count("*").alias("lines"))


def _tracked(spark, sf):
    """French complaints come without an id; equal bodies share one."""
    docs = documents(spark, sf, "doc_id", "text", "lang")
    return docs.withColumn("id", F.when(F.col("lang") != "fr", F.md5("text"))).drop("text")


@query("""WITH d AS (SELECT doc_id, lang, CASE WHEN lang <> 'fr' THEN md5(text) END AS id FROM documents),
store AS (SELECT d.* FROM d JOIN labels USING (doc_id)),
fresh AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY doc_id) AS rn FROM d
  WHERE NOT EXISTS (SELECT 1 FROM store s WHERE s.id IS NOT DISTINCT FROM d.id))
SELECT doc_id, lang, id FROM store UNION ALL SELECT doc_id, lang, id FROM fresh WHERE rn = 1""")
def ingest_new_only(spark, sf):
    """Labelled documents are stored already; all documents arrive again."""
    docs = _tracked(spark, sf)
    stored = docs.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    return ingest.ingest(docs, stored, "doc_id")


@query("""WITH d AS (SELECT doc_id, lang, CASE WHEN lang <> 'fr' THEN doc_id % 700 END AS id FROM documents),
store AS (SELECT d.* FROM d JOIN labels USING (doc_id)),
fresh AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY doc_id) AS rn FROM d
  WHERE NOT EXISTS (SELECT 1 FROM store s WHERE s.id IS NOT DISTINCT FROM d.id))
SELECT doc_id, lang, id FROM store UNION ALL SELECT doc_id, lang, id FROM fresh WHERE rn = 1""")
def ingest_numeric_ids(spark, sf):
    """As :func:`ingest_new_only`, where ids are numbers, repeated and missing ones among them."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", F.expr("CASE WHEN lang <> 'fr' THEN doc_id % 700 END").alias("id"))
    stored = docs.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    return ingest.ingest(docs, stored, "doc_id")


@query("""WITH d AS (SELECT doc_id, lang, CASE WHEN lang <> 'fr' THEN md5(text) END AS id FROM documents)
SELECT doc_id, lang, id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY doc_id) AS rn FROM d) WHERE rn = 1""")
def keep_first_by_id(spark, sf):
    return quality.keep_first(_tracked(spark, sf), ["id"], "doc_id")


@query("""WITH log AS (SELECT l_partkey::VARCHAR AS source, l_linenumber::BIGINT AS page,
    count(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'F') AS n_links FROM lineitem GROUP BY ALL),
w AS (SELECT *, CASE WHEN n_links = 0
    AND lag(n_links, 1) OVER p = 0 AND lag(page, 1) OVER p = page - 1
    AND lag(n_links, 2) OVER p = 0 AND lag(page, 2) OVER p = page - 2 THEN page END AS stop
  FROM log WINDOW p AS (PARTITION BY source ORDER BY page)),
c AS (SELECT source, min(stop) AS cut_page FROM w GROUP BY source)
SELECT source, page, n_links, cut_page FROM log JOIN c USING (source) WHERE cut_page IS NULL OR page <= cut_page""")
def empty_streak_cut(spark, sf):
    """Parts play crawl sources and line numbers play pages."""
    items = table(spark, sf, "lineitem")
    hit = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    log = items.groupBy(
        F.col("l_partkey").cast("string").alias("source"), F.col("l_linenumber").cast("long").alias("page")
    ).agg(F.count_if(hit).alias("n_links"))
    return ingest.empty_streak_cut(log)


@query(f"""WITH m AS ({S.staged('documents', 'doc_id', CONTACT_TEXT, S.email, S.mobile, S.landline, S.numbers)})
SELECT tag, count(*) AS complaints, sum(hits)::BIGINT AS hits FROM (
  SELECT doc_id, unnest(['[EMAIL]', '[NIK]', '[PHONE]', '[REKENING]']) AS tag, t,
    (length(t) - length(replace(t, tag, ''))) // length(tag) AS hits FROM m) WHERE hits > 0 GROUP BY tag""")
def masked_tag_counts(spark, sf):
    """How many complaints hold each kind of personal data."""
    masked = compute_once(documents(spark, sf, "doc_id", "text"), t=mask_pii(contact_text()))
    tags = F.explode(F.array(*[F.lit(f"[{t}]") for t in sorted(K.PII_TAGS)]))
    found = masked.select("t", tags.alias("tag"))
    hits = (F.length("t") - F.length(F.replace("t", "tag", F.lit("")))) / F.length("tag")
    counted = found.select("tag", hits.cast("long").alias("hits")).filter("hits > 0")
    return counted.groupBy("tag").agg(F.count("*").alias("complaints"), F.sum("hits").alias("hits"))
