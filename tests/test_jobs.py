"""Whole jobs on small files."""

import csv
import json
from glob import glob

import numpy as np

from suarakit.plans import jobs
from suarakit.schemas import LABEL_COLUMNS
from suarakit.sources import readers, writers


def lines(path):
    return [json.loads(x) for f in sorted(glob(f"{path}/part-*")) for x in open(f, encoding="utf-8")]


def write_csv(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(["id", "judul", "isi", "kategori", "url"])
        w.writerows(rows)


RAW = [
    ["1", 'Jalan "rusak"', "Jalan di depan rumah\nberlubang besar &amp; dalam", "jalan", "u"],
    ["2", "Sama", "Jalan di depan rumah berlubang besar dalam", "", "u"],
    ["x3", "", "Lampu jalan mati sejak minggu lalu, tolong", "Persampahan kota", "u"],
    ["4", "Pendek", "terlalu pendek", "Sosial", "u"],
    ["5", "Pajak", "Pajak daerah naik terlalu tinggi, mohon info", "pajak daerah", "u"],
]


def test_preprocessing(spark, tmp_path):
    write_csv(tmp_path / "raw.csv", RAW)
    out = str(tmp_path / "out")
    top = jobs.run_preprocessing(spark, str(tmp_path / "raw.csv"), out).collect()
    assert [r["id"] for r in top] == ["1", "x3", "5"]
    clean = {r["id"]: r for r in readers.read_csv(spark, f"{out}/clean", readers.T.StructType.fromDDL(
        "id string, judul string, isi string, kategori string, input_text string")).collect()}
    assert sorted(clean) == ["1", "5", "x3"]
    assert clean["1"]["judul"] == "Jalan rusak" and clean["1"]["isi"] == "Jalan di depan rumah berlubang besar dalam"
    assert {i: r["kategori"] for i, r in clean.items()} == {"1": "Infrastruktur", "x3": "Kesehatan", "5": "Pajak Daerah"}
    assert clean["1"]["input_text"] == "Judul: Jalan rusak\nLaporan: Jalan di depan rumah berlubang besar dalam"
    records = lines(f"{out}/finetuning")
    assert sorted(r["id"] for r in records) == [1, 5]
    assert list(records[0]) == ["id", "system", "user", "label"]
    assert list(records[0]["label"]) == ["kategori"] + [c for c in LABEL_COLUMNS if c != "kategori"]
    assert records[0]["label"]["summary"] is None
    assert [r["id"] for r in lines(f"{out}/quarantine")] == ["x3"]
    assert lines(f"{out}/counters") == [{"read": 5, "kept": 3, "removed": 2}]


def answering(text):
    return lambda: lambda prompts: [text for _ in prompts]


def test_full_annotation_resumes(spark, tmp_path):
    write_csv(tmp_path / "raw.csv", RAW)
    jobs.run_preprocessing(spark, str(tmp_path / "raw.csv"), str(tmp_path / "a"))
    clean = str(tmp_path / "a" / "clean")
    partial = '{"intent":"question","kategori":"Sosial","object":"o","urgency":"low","sentiment":"netral","summary":"s"}'
    counts = jobs.run_full_annotation(spark, clean, str(tmp_path / "b"), answering(partial))
    assert {(r["field"], r["value"]): r["count"] for r in counts.collect()}[("intent", "question")] == 3
    # Without a location no row is complete, so nothing is exported and all is asked again.
    assert lines(f"{tmp_path}/b/training") == []
    whole = partial.replace('"object"', '"location":"Jl","object"')
    jobs.run_full_annotation(spark, clean, str(tmp_path / "c"), answering(whole), previous_path=f"{tmp_path}/b/annotated")
    made = lines(f"{tmp_path}/c/training")
    assert len(made) == 3 and json.loads(made[0]["output"])["location"] == "Jl"
    assert list(json.loads(made[0]["output"])) == list(LABEL_COLUMNS)
    # Complete rows keep their labels.
    counts = jobs.run_full_annotation(
        spark, clean, str(tmp_path / "d"), answering("{}"), previous_path=f"{tmp_path}/c/annotated")
    assert {r["value"] for r in counts.filter("field = 'intent'").collect()} == {"question"}
    # The first schema converts to the second.
    counts = jobs.run_conversion(spark, f"{tmp_path}/c/training", str(tmp_path / "e"))
    assert {(r["field"], r["value"]): r["count"] for r in counts.collect()} == {
        ("intent", "non-complaint"): 3, ("category", "lainnya"): 3, ("urgency", "low"): 3, ("sentiment", "neutral"): 3}
    assert len(lines(f"{tmp_path}/e/training")) == 3
    assert lines(f"{tmp_path}/e/counters") == [{"lines": 3, "converted": 3, "errors": 0}]
    assert lines(f"{tmp_path}/d/counters") == [{"written": 3, "skipped": 0, "empty_summaries": 0}]
    assert lines(f"{tmp_path}/b/counters") == [{"answers_ok": 3, "written": 0, "skipped": 3, "empty_summaries": 0}]


def test_urgency_annotation(spark, tmp_path):
    write_csv(tmp_path / "raw.csv", RAW)
    jobs.run_preprocessing(spark, str(tmp_path / "raw.csv"), str(tmp_path / "a"))
    pct, samples = jobs.run_urgency_annotation(spark, f"{tmp_path}/a/clean", str(tmp_path / "b"), answering("High"))
    assert [tuple(r) for r in pct.collect()] == [("high", 3, 100.0)]
    assert samples.count() == 2


def test_intake_masks_before_the_prompt(spark):
    df = spark.createDataFrame([("1", "NIK 3578121504980001 hilang"), ("2", "b")], "id string, isi string")
    seen = []

    def responses(prompts):
        seen.extend(r["prompt"] for r in prompts.collect())
        return spark.createDataFrame([("1", 'ok {"urgency":"low"}'), ("2", "nothing")], "id string, raw string")

    got = {r["id"]: r["parsed"] for r in jobs.intake(df, responses).collect()}
    assert got == {"1": True, "2": False}
    assert not any("3578121504980001" in p for p in seen) and any("[NIK]hilang" in p for p in seen)


def encoder():
    return lambda texts: np.array([[t.count("a"), t.count("i"), t.count("u")] for t in texts], dtype=float)


def test_near_duplicate_intake_grows_the_store(spark, tmp_path):
    store = str(tmp_path / "store")

    def run(rows, name):
        df = spark.createDataFrame(rows, "complaint_id string, isi string, category string, seq long")
        done = jobs.run_near_duplicate_intake(spark, df, encoder, store, str(tmp_path / name), threshold=0.95)
        return {r["complaint_id"]: (r["is_duplicate"], r["duplicate_of"], r["is_stored"]) for r in done.collect()}

    assert run([("a", "aaa yg", "x", 1), ("b", "aaaa", "x", 2), ("c", "iii", "x", 3)], "one") == {
        "a": (False, None, True), "b": (True, "a", False), "c": (False, None, True)}
    assert run([("d", "ii", "x", 1), ("e", "uu", "x", 2), ("a", "aaa yg", "x", 3)], "two") == {
        "d": (True, "c", False), "e": (False, None, True), "a": (False, None, False)}
    rows = writers.read_vector_store(spark, store).collect()
    assert sorted(r["complaint_id"] for r in rows) == ["a", "c", "e"]
    assert {r["text"] for r in rows} == {"aaa yang", "iii", "uu"}


def test_csv_order_follows_the_file(spark, tmp_path):
    write_csv(tmp_path / "raw.csv", [[str(i), "j", f"b\n{i}", "k", "u"] for i in range(50)])
    df = readers.with_order(readers.read_csv(spark, str(tmp_path / "raw.csv")))
    assert [r["id"] for r in df.orderBy("seq").collect()] == [str(i) for i in range(50)]


def test_pages_are_saved_in_crawl_order(spark, tmp_path):
    rules = {"id": {"tag": "b"}, "judul": {"tag": "h1"}, "isi": {"tag": "p"}}
    page = "<b>#7</b><h1>{}</h1><p>body</p>".format
    rows = [("z", page("first"), 1), ("a", page("second"), 2), ("m", None, 0)]
    df = spark.createDataFrame(rows, "url string, html string, fetched int")
    counts = jobs.run_complaints_from_pages(spark, df, str(tmp_path / "o"), rules=rules, order="fetched").first()
    assert counts.asDict() == {"complaints": 1, "incomplete": 0}
    assert [(r["id"], r["judul"]) for r in lines(f"{tmp_path}/o/json")] == [("7", "first")]
