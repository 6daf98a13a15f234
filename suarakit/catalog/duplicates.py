"""Queries on vectors and near duplicates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from suarakit import constants as K
from suarakit.catalog import sql as S
from suarakit.catalog.tables import SLANG_TEXT, documents, slang_text, table
from suarakit.functions import vectors
from suarakit.operators.embed import embed
from suarakit.operators.near_duplicates import check_duplicates, deduplicate_arrivals
from suarakit.operators.neighbours import nearest
from suarakit.plans import jobs
from suarakit.session import materialise, scratch_path
from suarakit.sources import vector_table, writers

QUERIES, SQL = {}, {}

# The fixture's vectors are far apart; at the default threshold there is nothing to find.
THRESHOLD = 0.35


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


_SIMS = """v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
sims AS MATERIALIZED (SELECT a.vec_id, b.vec_id AS other, list_cosine_similarity(a.e, b.e) AS sim
  FROM v a JOIN v b ON b.vec_id < a.vec_id)"""


@query("""SELECT vec_id, round(list_cosine_similarity(e, f), 9) AS cosine, round(e[1] / sqrt(list_dot_product(e, e)), 9) AS first_unit
FROM (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings)
JOIN (SELECT label, arg_min(embedding::DOUBLE[], vec_id) AS f FROM embeddings GROUP BY label) USING (label)""")
def vector_arithmetic(spark, sf):
    """Cosine of each vector with the first one of its label, and its normalised first entry."""
    e = table(spark, sf, "embeddings")
    first = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("first"))
    return e.join(first, "label").select(
        "vec_id",
        F.round(vectors.cosine(F.col("embedding"), F.col("first")), 9).alias("cosine"),
        F.round(vectors.l2_normalise(F.col("embedding"))[0], 9).alias("first_unit"),
    )


@query(f"""WITH {_SIMS}, best AS (SELECT vec_id, max(sim) AS sim, arg_max(other, sim) AS other FROM sims GROUP BY vec_id)
SELECT vec_id, coalesce(round(sim, 4) >= {THRESHOLD}, false) AS is_duplicate, coalesce(round(sim, 4), 0.0) AS similarity_score,
  CASE WHEN round(sim, 4) >= {THRESHOLD} THEN other END AS duplicate_of FROM v LEFT JOIN best USING (vec_id)""")
def dup_top1(spark, sf):
    """Every vector against all that arrived before it."""
    e = table(spark, sf, "embeddings")
    return check_duplicates(e, e, order_col="vec_id", threshold=THRESHOLD)


@query(f"""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
b AS (SELECT v.vec_id, CASE WHEN o.e IS NULL THEN v.e WHEN v.vec_id % 2 = 0
  THEN list_transform(list_zip(v.e, o.e), lambda z: z[1] + 0.5::DOUBLE * z[2])
  ELSE list_transform(list_zip(v.e, o.e), lambda z: 0.5::DOUBLE * z[1] + z[2]) END AS e
  FROM v LEFT JOIN v o ON o.vec_id = v.vec_id + 1),
s AS (SELECT b.vec_id, v.vec_id AS other, round(list_cosine_similarity(b.e, v.e), 9) AS sim FROM b JOIN v ON true),
t AS (SELECT vec_id, max(sim) AS sim, arg_max(other, sim) AS other FROM s GROUP BY vec_id)
SELECT vec_id, round(sim, 4) >= {THRESHOLD} AND other <> vec_id AS is_duplicate, round(sim, 4) AS similarity_score,
  CASE WHEN round(sim, 4) >= {THRESHOLD} AND other <> vec_id THEN other END AS duplicate_of FROM t""")
def dup_recheck_stored(spark, sf):
    """Changed rows checked under their old ids: nearest to themselves, or to their neighbour."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    even, half = F.col("vec_id") % 2 == 0, F.lit(0.5)
    changed = F.when(even, F.zip_with("embedding", "other", lambda x, y: x + half * y)).otherwise(
        F.zip_with("embedding", "other", lambda x, y: half * x + y)
    )
    batch = e.join(after, "vec_id", "left").select(
        "vec_id", F.coalesce(changed, F.col("embedding").cast("array<double>")).alias("embedding")
    )
    return check_duplicates(batch, e, threshold=THRESHOLD)


_GREEDY = f"""WITH RECURSIVE {_SIMS},
edges AS MATERIALIZED (SELECT vec_id, list(other) AS earlier FROM sims WHERE round(sim, 4) >= {THRESHOLD} GROUP BY vec_id),
o AS MATERIALIZED (SELECT vec_id, coalesce(earlier, []) AS earlier, row_number() OVER (ORDER BY vec_id) AS i
  FROM v LEFT JOIN edges USING (vec_id)),
walk AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS kept UNION ALL
  SELECT o.i, CASE WHEN list_has_any(walk.kept, o.earlier) THEN walk.kept ELSE list_append(walk.kept, o.vec_id) END
  FROM walk JOIN o ON o.i = walk.i + 1),
stored AS MATERIALIZED (SELECT unnest(kept) AS vec_id FROM (SELECT kept FROM walk ORDER BY i DESC LIMIT 1)),
best AS (SELECT s.vec_id, max(sim) AS sim, arg_max(other, sim) AS other FROM sims s JOIN stored k ON k.vec_id = s.other GROUP BY s.vec_id)
SELECT vec_id, coalesce(round(sim, 4) >= {THRESHOLD}, false) AS is_duplicate, coalesce(round(sim, 4), 0.0) AS similarity_score,
  CASE WHEN round(sim, 4) >= {THRESHOLD} THEN other END AS duplicate_of, vec_id IN (SELECT vec_id FROM stored) AS is_stored
FROM v LEFT JOIN best USING (vec_id)"""


@query(_GREEDY)
def dup_greedy(spark, sf):
    """Check-then-store in arrival order."""
    return deduplicate_arrivals(table(spark, sf, "embeddings"), threshold=THRESHOLD)


_MIXED = """v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
b AS (SELECT v.vec_id, CASE WHEN o.e IS NULL THEN v.e ELSE list_transform(list_zip(v.e, o.e), lambda z: z[1] + 0.75::DOUBLE * z[2]) END AS e
  FROM v LEFT JOIN v o ON o.vec_id = v.vec_id + 1),
s AS (SELECT b.vec_id, v.vec_id AS other, round(list_cosine_similarity(b.e, v.e), 9) AS sim FROM b JOIN v ON true),
t AS (SELECT vec_id, max(sim) AS sim, arg_max(other, sim) AS other FROM s GROUP BY vec_id)"""


@query(f"""WITH {_MIXED} SELECT vec_id, round(sim, 4) AS similarity, other AS nearest_id FROM t""")
def dup_lsh(spark, sf):
    """Approximate search for mixtures of neighbouring vectors, which resemble both.

    The store has few enough lists for a query to probe them all, so the result is exact here;
    recall on stores that have many is measured in the tests.
    """
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    mixed = F.zip_with("embedding", "other", lambda x, y: x + F.lit(0.75) * y)
    both = e.join(after, "vec_id", "left").select(
        "vec_id", F.coalesce(mixed, F.col("embedding").cast("array<double>")).alias("embedding")
    )
    found = nearest(both, e, method="index")
    return found.select(F.col("id").alias("vec_id"), F.round("similarity", 4).alias("similarity"), "nearest_id")


_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _letter_encoder():
    """Stand-in for an embedding model: how often each letter occurs."""
    return lambda texts: np.array([[t.count(c) for c in _LETTERS] for t in texts])


_LETTER_SQL = (
    f"list_transform(string_split('{' '.join(_LETTERS)}', ' '), lambda c: (length(t) - length(replace(t, c, '')))::FLOAT)"
)
# The vectors are stored in single precision, hence the cast after normalising.
_UNIT_SQL = """list_transform(n, lambda x: CASE WHEN list_sum(list_transform(n, lambda y: y * y)) > 0
  THEN (x / sqrt(list_sum(list_transform(n, lambda y: y * y))))::FLOAT ELSE 0 END)::DOUBLE[]"""


@query(f"""WITH d AS ({S.staged('documents', 'doc_id', SLANG_TEXT, S.normalise)}),
n AS (SELECT doc_id, ({_LETTER_SQL})::DOUBLE[] AS n FROM d)
SELECT doc_id, list_transform({_UNIT_SQL}, lambda x: round(x, 5)) AS embedding FROM n""")
def text_vectors(spark, sf):
    """Normalise complaints and embed them."""
    docs = documents(spark, sf, "doc_id", "text", "source").withColumn("isi", slang_text())
    made = jobs.normalised_vectors(docs, _letter_encoder)
    rounded = F.transform("embedding", lambda x: F.round(x.cast("double"), 5))
    return made.select("doc_id", rounded.alias("embedding"))


_INTAKE = 0.99


@query(
    _GREEDY.replace(
        "v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)",
        f"""d AS ({S.staged('benchmark', 'item_id', "text || ' yg [NIK]'", S.normalise)}),
n AS (SELECT item_id, ({_LETTER_SQL})::DOUBLE[] AS n FROM d), v AS (SELECT item_id AS vec_id, {_UNIT_SQL} AS e FROM n)""",
    ).replace(f">= {THRESHOLD}", f">= {_INTAKE}").replace("SELECT vec_id, coalesce(round(sim, 4)", "SELECT vec_id::VARCHAR AS complaint_id, coalesce(round(sim, 4)")
    .replace("THEN other END AS duplicate_of", "THEN other::VARCHAR END AS duplicate_of")
)
def near_duplicate_intake(spark, sf):
    """The whole job: normalise, embed, check in arrival order, store."""
    rows = table(spark, sf, "benchmark").select(
        F.col("item_id").cast("string").alias("complaint_id"),
        F.concat("text", F.lit(" yg [NIK]")).alias("isi"),
        F.lit("x").alias("category"),
        F.struct("item_id").alias("seq"),
    )
    out = scratch_path(spark, "intake-job")
    return jobs.run_near_duplicate_intake(spark, rows, _letter_encoder, f"{out}/store", f"{out}/run", threshold=_INTAKE)


_CLOSE = 0.9995


@query(
    _GREEDY.replace(
        "v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)",
        f"""d AS (SELECT doc_id, lower(text) AS t FROM documents), n AS (SELECT doc_id, ({_LETTER_SQL})::DOUBLE[] AS n FROM d),
v AS MATERIALIZED (SELECT doc_id AS vec_id, {_UNIT_SQL} AS e FROM n WHERE list_sum(n) > 0)""",
    ).replace(f">= {THRESHOLD}", f">= {_CLOSE}")
)
def documents_first_come(spark, sf):
    """Every document with letters, embedded once and checked against those kept before it."""
    docs = documents(spark, sf, "doc_id", "text").select("doc_id", F.lower("text").alias("text")).filter(F.col("text").rlike("[a-z]"))
    made = materialise(embed(docs, _letter_encoder).select(F.col("doc_id").alias("vec_id"), "embedding"))
    return deduplicate_arrivals(made, threshold=_CLOSE)


@query(f"""WITH b AS (SELECT item_id, ({_LETTER_SQL.replace('(t', '(lower(text)')})::DOUBLE[] AS n FROM benchmark),
d AS (SELECT doc_id, ({_LETTER_SQL.replace('(t', '(lower(text)')})::DOUBLE[] AS n FROM documents),
bu AS MATERIALIZED (SELECT item_id, {_UNIT_SQL} AS e FROM b),
du AS MATERIALIZED (SELECT doc_id, {_UNIT_SQL} AS e FROM d WHERE list_sum(n) > 0),
s AS MATERIALIZED (SELECT doc_id, max(round(list_cosine_similarity(du.e, bu.e), 9)) AS sim FROM du, bu GROUP BY doc_id)
SELECT d.doc_id, coalesce(round(sim, 4) >= 0.99, false) AS is_duplicate, coalesce(round(sim, 4), 0.0) AS similarity_score
FROM d LEFT JOIN s USING (doc_id)""")
def documents_against_benchmark(spark, sf):
    """Texts embedded once each and checked against a stored collection of other texts."""
    low = F.lower("text").alias("text")
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), low)
    # The search reads its store more than once; the encoder should not run again.
    store = materialise(embed(items, _letter_encoder))
    docs = embed(documents(spark, sf, "doc_id", "text").select("doc_id", low), _letter_encoder)
    found = nearest(docs, store, id_col="doc_id")
    score = F.coalesce(F.round("similarity", 4), F.lit(0.0))
    return found.select(
        F.col("id").alias("doc_id"), (score >= 0.99).alias("is_duplicate"), score.alias("similarity_score")
    )


@query("""SELECT vec_id::VARCHAR AS complaint_id, 'text ' || label AS text, label::VARCHAR AS category,
  list_transform(embedding, lambda x: round(x::DOUBLE, 6)) AS embedding FROM embeddings""")
def vector_store(spark, sf):
    """Two appends to a vector table, read back."""
    path = scratch_path(spark, "vectors")
    rows = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("complaint_id"),
        F.concat(F.lit("text "), F.col("label").cast("string")).alias("text"),
        F.col("label").cast("string").alias("category"),
        "embedding",
    )
    low = F.col("category").cast("int") < 5
    writers.add_to_vector_store(rows.filter(low), path)
    writers.add_to_vector_store(rows.filter(~low), path)
    return writers.read_vector_store(spark, path).select(
        "complaint_id", "text", "category", F.transform("embedding", lambda x: F.round(x.cast("double"), 6)).alias("embedding")
    )


@query(f"""WITH {_MIXED} SELECT vec_id, round(sim, 4) AS similarity, other AS nearest_id FROM t WHERE vec_id % 5 = 0
UNION ALL SELECT -1, count(*)::DOUBLE, max(vec_id) FROM embeddings""")
def vector_table_batches(spark, sf):
    """A table by cell filled in four batches, one of them twice, compacted, and asked through the cells that matter.

    Row -1 has the number of stored rows and the largest id.
    """
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    path = f"{scratch_path(spark, 'vector-table')}/table"
    for batch in (0, 1, 2, 2):
        vector_table.append(e.filter(F.col("vec_id") % 4 == batch), path, batch)
    vector_table.compact(spark, path, 1)
    vector_table.append(e.filter(F.col("vec_id") % 4 == 3), path, 3)
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    mixed = F.zip_with("embedding", "other", lambda x, y: x + F.lit(0.75) * y)
    asked = e.join(after, "vec_id", "left").filter("vec_id % 5 = 0").select(
        "vec_id", F.coalesce(mixed, F.col("embedding").cast("array<double>")).alias("embedding")
    )
    asked = materialise(asked)
    found = nearest(asked, vector_table.probe(asked, path))
    rows = found.select(F.col("id").alias("vec_id"), F.round("similarity", 4).alias("similarity"), "nearest_id")
    total = vector_table.read(spark, path).agg(
        F.lit(-1).cast("bigint").alias("vec_id"), F.count("*").cast("double").alias("similarity"), F.max("vec_id").alias("nearest_id")
    )
    return rows.unionByName(total)
