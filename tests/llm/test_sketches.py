import hashlib
import re

from pyspark.sql import functions as F

from suarakit.llm import sketches
from tests.llm import fixtures


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def true_resemblance(a, b):
    a, b = shingles(a), shingles(b)
    return 1.0 if not a | b else len(a & b) / len(a | b)


def edits(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, r in enumerate(order):
        text, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        out[r[0]] = (text, text[: len(text) - cut] + after[:cut], after)
    return out


def test_edits_and_likeness(spark):
    given = fixtures.texts(9, 120)
    rows = [r for r in fixtures.rows(given) if r[0] is not None][: len(given)]
    docs = spark.createDataFrame(rows, fixtures.SCHEMA).repartition(4)
    wanted = edits(rows)
    made = sketches.fingerprint_edits(docs).select(
        "id",
        "n_chars",
        F.sha2("edited", 256).alias("sha"),
        sketches.printed(F.col("sketch")).alias("print"),
        sketches.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        sketches.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        sketches.distinct_shingles(F.col("sketch")).alias("n"),
        sketches.containment(F.col("sketch"), F.col("edited_sketch")).alias("inside"),
    ).collect()
    assert sorted(r.id for r in made) == sorted(wanted)
    prints = {}
    for r in made:
        text, edited, after = wanted[r.id]
        assert r.n_chars == len(text) and r.sha == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - true_resemblance(text, edited)) < 0.2
        assert abs(r.near_next - true_resemblance(text, after)) < 0.2
        n = len(shingles(text))
        assert abs(r.n - n) <= max(0.35 * n, 0) if n >= 128 else r.n == n
        inside = len(shingles(text) & shingles(edited)) / n if n else 1.0
        assert abs(r.inside - inside) < 0.25
        assert prints.setdefault(text, r.print) == r.print
    small = [r for r in made if len(shingles(wanted[r.id][0]) | shingles(wanted[r.id][1])) <= 128]
    assert small and all(abs(r.near_edited - true_resemblance(*wanted[r.id][:2])) < 1e-9 for r in small)


def test_buckets_of_the_order_do_not_show(spark):
    ids = [((i * 7919) % 100_003) - 50_000 for i in range(700)]
    docs = spark.createDataFrame([(i, f"text {i} " * 3) for i in ids], "doc_id bigint, text string").repartition(5)
    rows = docs.select(F.col("doc_id").alias("id"), F.lit(1).alias("key"), "text")
    wanted = {i: t[1] for i, t in edits_next(ids).items()}
    for size in (1, 3, 10, 150, 5000):
        got = sketches.with_next(docs, rows, "doc_id", ("text",), size)
        assert {r.id: r.next_text for r in got.collect()} == wanted


def edits_next(ids):
    order = sorted(ids, reverse=True)
    return {i: (i, f"text {order[(n + 1) % len(order)]} " * 3) for n, i in enumerate(order)}


def test_awkward_ids(spark):
    docs = fixtures.documents(spark)
    out = sketches.fingerprint_edits(docs)
    assert out.count() == docs.count()
    assert sketches.fingerprint_edits(fixtures.nothing(spark)).count() == 0
    alone = spark.createDataFrame([(None, "a b c d e f"), (None, "z")], "doc_id bigint, text string")
    assert sketches.fingerprint_edits(alone).where("next_sketch is not null").count() == 2
    one = spark.createDataFrame([(5, "abcdef")], "doc_id bigint, text string")
    assert sketches.fingerprint_edits(one).first().edited == "abcdab"


def test_parts_merge_to_the_whole(spark):
    words = [f"w{i}" for i in range(900)]
    whole = " ".join(words)
    parts = [(1, " ".join(words[i : i + 104])) for i in range(0, 900, 100)] + [(2, ""), (None, "a b c d e")]
    df = spark.createDataFrame(parts, "doc int, text string").select("doc", sketches.sketch(F.col("text")).alias("s"))
    merged = {r.doc: r.s for r in sketches.merge_parts(df, "doc", "s").collect()}
    direct = spark.range(1).select(sketches.sketch(F.lit(whole)).alias("s")).first().s
    assert merged[1] == direct and merged[2] == [] and set(merged) == {1, 2, None}


def test_plan_has_no_python(spark):
    plan = sketches.fingerprint_edits(fixtures.documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
