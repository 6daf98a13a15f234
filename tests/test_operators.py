import pytest
from pyspark.sql import functions as F

from suarakit.operators import ingest, quality, records, report
from suarakit.operators import pages as P
from suarakit.operators.embed import embed


def test_keep_first_by_id_treats_null_as_one_id(spark):
    df = spark.createDataFrame([(1, None), (2, "7"), (3, None), (4, "7")], "seq int, id string")
    assert sorted(r["seq"] for r in quality.keep_first(df, ["id"], "seq").collect()) == [1, 2]


def test_new_records_respects_a_stored_null(spark):
    batch = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (4, "b"), (5, "b")], "seq int, id string")
    store = spark.createDataFrame([(None,), ("a",), ("a",)], "id string")
    assert sorted(r["seq"] for r in ingest.new_records(batch, store, "seq").collect()) == [2, 4]


@pytest.mark.parametrize("partitions", [1, 7])
def test_keep_first_does_not_depend_on_partitioning(spark, partitions):
    rows = [(i, "same body of text" if i % 3 == 0 else f"body {i // 2}") for i in range(300)]
    df = spark.createDataFrame(rows, "seq int, isi string").repartition(partitions, F.rand(1))
    seen, first = set(), []
    for seq, body in rows:
        if body not in seen:
            seen.add(body)
            first.append(seq)
    got = quality.keep_first(df, ["isi"], "seq", long_keys=True)
    assert sorted(r["seq"] for r in got.collect()) == first


def test_filter_quality_keeps_empty_titles(spark):
    df = spark.createDataFrame(
        [(1, "", "x" * 20), (2, None, "y" * 20), (3, "t", "z" * 19), (4, "t", None), (5, "t", "x" * 20)],
        "seq int, judul string, isi string",
    )
    assert [r["seq"] for r in quality.filter_quality(df, "seq").collect()] == [1]


def test_crawl_stops_at_third_empty_page_in_a_row(spark):
    counts = [5, 0, 0, 4, 0, 0, 0, 9]
    log = [("s", i, n) for i, n in enumerate(counts, 1)] + [("t", 1, 0), ("t", 2, 0), ("t", 3, 1)]
    df = spark.createDataFrame(log, "source string, page long, n_links long")
    got = ingest.empty_streak_cut(df).collect()
    assert sorted((r["source"], r["page"]) for r in got) == [("s", p) for p in range(1, 8)] + [("t", p) for p in (1, 2, 3)]
    assert {r["cut_page"] for r in got} == {7, None}


def test_percentages_round_half_to_even(spark):
    df = spark.createDataFrame([("a",)] * 49 + [("b",)] * 351 + [(None,)] * 9, "u string")
    got = {r["value"]: (r["count"], r["pct"]) for r in report.value_percentages(df, "u").collect()}
    assert got == {"a": (49, 12.2), "b": (351, 87.8)}


def test_converted_records(spark):
    lines = [
        '{"input":"Jl \\"A\\"","output":"{\\"intent\\":\\"question\\"}"}', " \t", "", "garbage",
        '{"output":"no json"}', '{"input":null}', '{"input":"x","output":{"a":1}}', '["a"]', '{"input":"x","output":"[1]"}',
        ' {"input":5} ',
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    out = {r["i"]: r["record"] for r in records.convert_lines(df).collect()}
    assert sorted(out) == [0, 3, 4, 5, 6, 7, 8, 9]
    assert [i for i, r in sorted(out.items()) if r is None] == [3, 6, 7, 8]
    assert '"""Jl "A""""' in out[0]["instruction"] and '"intent":"non-complaint"' in out[0]["output"]
    assert out[4]["output"] == "no json" and '""""""' in out[4]["instruction"]
    assert '"""None"""' in out[5]["instruction"] and '"""5"""' in out[9]["instruction"]
    assert {r["input"] for r in out.values() if r} == {""}


def test_finetune_records_quarantine_bad_ids(spark):
    df = spark.createDataFrame([("1", "k", "t"), ("x", "k", "t"), (None, "k", "t")], "id string, kategori string, input_text string")
    good, bad = records.split_bad(records.finetune_records(df))
    assert [r["record"]["id"] for r in good.collect()] == [1] and bad.count() == 2


DETAIL = """<html><body><p class=x>Intro</p><p>Tracking ID : <b>#AB12</b> x</p>
<h1 class="big complaint-title"> Jalan <i>rusak</i> &amp; gelap</h1>
<div class="complaint-excerpt"><p>Isi <b>tebal</b> sini<br>lagi</p><p>dua</p></div>
<a href="/x">n</a><a href="https://z/laporan/kategori/3"> Infra </a><script>var t="<b>"</script></body></html>"""


def test_page_fields(spark):
    rows = [
        ("u1", DETAIL),
        ("u2", None),
        ("u3", "<div class='complaint-excerpt'>no p<!-- c --> tail<script>x</script></div><p>Tracking ID none"),
        ("u4", ""),
        ("u5", "<p>a<p>Tracking ID <b>#1</b></div><h1 class=complaint-title>t</h1>"),
    ]
    got = {r["url"]: tuple(r)[:4] for r in P.page_fields(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert got == {
        "u1": ("AB12", "Jalanrusak& gelap", "Isitebalsinilagi", "Infra"),
        "u3": (None, None, "no ptail", None),
        "u4": (None, None, None, None),
        "u5": ("1", "t", None, None),
    }


def test_page_links(spark):
    html = """<div class="post-title h4 mg-0"><a name=q>n</a><a href="/a/1">x</a><a href="/b">y</a></div>
    <div class="post-title h4">no<a href="/no">n</a></div><div class="h4 mg-0 post-title"><span><a href="http://k/2">z</a></span></div>
    <div class="post-title h4 mg-0">none</div><div class="post-title h4 mg-0"><a href="">e</a></div>"""
    got = P.page_links(spark.createDataFrame([("l", html), ("m", "")], "url string, html string"), "https://base")
    assert sorted((r["position"], r["link"]) for r in got.collect()) == [(0, "https://base/a/1"), (1, "http://k/2"), (2, "https://base")]


def test_deeply_unclosed_page_does_not_recurse(spark):
    html = "<p>" * 5000 + "Tracking ID <b>#Z</b>"
    row = P.page_fields(spark.createDataFrame([("u", html)], "url string, html string")).first()
    assert row["id"] == "Z"


def test_a_page_logged_twice_counts_once(spark):
    def cut(pages):
        log = spark.createDataFrame([("s", p, n) for p, n in pages], "source string, page int, n_links int")
        return {r["cut_page"] for r in ingest.empty_streak_cut(log).collect()}

    assert cut([(1, 3), (2, 0), (2, 0), (3, 0), (4, 5)]) == {None}
    assert cut([(1, 0), (2, 0), (3, 0), (3, 0), (4, 1)]) == {3}
    assert cut([(1, 0), (2, 0), (2, 4), (3, 0), (4, 0)]) == {None}


def test_numeric_ids_are_taken_in(spark):
    from suarakit.operators.ingest import new_records

    batch = spark.createDataFrame([(5, 1), (5, 2), (None, 3), (None, 4), (7, 5)], "id long, seq int")
    store = spark.createDataFrame([("7",)], "id string")
    assert sorted((r.id or 0, r.seq) for r in new_records(batch, store, "seq").collect()) == [(0, 3), (5, 1)]


def test_scratch_without_a_shared_folder(tmp_path, sf_dir):
    """A plain local session, whose settings name no checkpoint folder, gets one of its own."""
    import os
    import subprocess
    import sys

    script = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert not spark.conf.get("spark.checkpoint.dir", None)
from suarakit.session import delete_scratch, materialise, scratch_path, shared_dir
path = scratch_path(spark, "x")
assert path.startswith(shared_dir(spark))
materialise(spark.range(3)).write.parquet(path)
print("rows", spark.read.parquet(path).count())
delete_scratch(spark, path)
try:
    delete_scratch(spark, "/tmp/other")
except ValueError:
    print("refused")
"""
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 3" in done.stdout and "refused" in done.stdout, done.stderr[-2000:]


def test_pages_are_parsed_one_at_a_time(monkeypatch):
    """Before, the parsed pages of a whole batch were held at once."""
    alive, most = [0], [0]

    class Counted(P._Page):
        def __init__(self, html):
            alive[0] += 1
            most[0] = max(most[0], alive[0])
            super().__init__(html)

        def __del__(self):
            alive[0] -= 1

    monkeypatch.setattr(P, "_Page", Counted)
    rules = {"id": {"tag": "a"}, "judul": {"tag": "h1"}}
    got = [P._fields_of(f"<a href='/{i}'>#{i}</a><h1>t{i}", rules, ["id", "judul", "isi", "url"]) for i in range(20)]
    assert got == [[f"#{i}", f"t{i}", None, None] for i in range(20)]
    assert most == [1]


def test_python_workers_get_bounded_batches(spark):
    """Before, an encoder got up to 10,000 texts at once, however long they were."""
    sizes = lambda: lambda texts: [[len(texts), 1.0]] * len(texts)
    texts = spark.range(0, 6000, 1, 1).select(F.lit("a text").alias("text"))
    first = embed(texts, sizes).select((F.col("embedding")[0] / F.col("embedding")[1]).alias("n")).agg(F.max("n")).first()[0]
    assert 1 < first < 2049
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20
