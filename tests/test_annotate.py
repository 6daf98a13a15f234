import os

from pyspark.sql import functions as F

from suarakit.operators import annotate as A
from suarakit.schemas import LABEL_COLUMNS


def prompts(spark, n=10):
    return spark.range(n).select(
        F.col("id").cast("string").alias("id"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt")
    )


def test_failures_become_statuses_and_spare_their_neighbours(spark):
    def model():
        def answer(texts):
            if "p3" in texts:
                raise TimeoutError
            if "p4" in texts:
                raise RuntimeError("broken")
            return [t.upper() for t in texts]

        return answer

    got = {r["id"]: (r["raw"], r["status"]) for r in A.ask_model(prompts(spark), model, pause=0, partitions=2).collect()}
    assert got["3"] == (None, "timeout") and got["4"] == (None, "error")
    assert all(got[str(i)] == (f"P{i}", "ok") for i in range(10) if i not in (3, 4))


def test_retries_are_bounded(spark, tmp_path):
    def model():
        calls = [0]

        def answer(texts):
            calls[0] += 1
            if calls[0] < 3:
                raise ConnectionError
            return texts

        return answer

    one = prompts(spark, 1)
    assert A.ask_model(one, model, pause=0, retries=2).first()["status"] == "ok"
    assert A.ask_model(one, model, pause=0, retries=1).first()["status"] == "error"


def test_answers_are_asked_for_once(spark, tmp_path):
    folder = str(tmp_path / "calls")
    os.makedirs(folder)

    def model():
        def answer(texts):
            for t in texts:
                with open(f"{folder}/{t}", "a") as f:
                    f.write("x")
            return texts

        return answer

    stored = A.ask_model_once(prompts(spark), model, path=str(tmp_path / "raw"))
    assert stored.count() == 10 and stored.filter("status = 'ok'").count() == 10
    assert {open(f"{folder}/{n}").read() for n in os.listdir(folder)} == {"x"}


def rows(spark):
    return spark.createDataFrame(
        [("1", "j", "i", "Sosial", "high"), ("2", None, "i", "Sosial", "error"), ("3", "j", None, None, None)],
        "id string, judul string, isi string, kategori string, urgency string",
    )


def test_urgency_only_where_missing_and_restart(spark):
    model = lambda: lambda texts: ["LOW" for _ in texts]
    got = {r["id"]: r["urgency"] for r in A.annotate_urgency(rows(spark), model).collect()}
    assert got == {"1": "high", "2": "low", "3": "low"}
    got = {r["id"]: r["urgency"] for r in A.annotate_urgency(rows(spark), model, restart=True).collect()}
    assert set(got.values()) == {"low"}


def test_urgency_failure_labels(spark):
    def model():
        def answer(texts):
            raise TimeoutError

        return answer

    got = A.annotate_urgency(rows(spark), model, pause=0).filter("id <> '1'").collect()
    assert {r["urgency"] for r in got} == {"error_timeout"}


def test_full_labels_default_when_the_model_fails(spark):
    def model():
        def answer(texts):
            raise RuntimeError

        return answer

    done = A.annotate_full(rows(spark), model, pause=0)
    got = {r["id"]: tuple(r[c] for c in LABEL_COLUMNS) for r in done.collect()}
    assert got["2"] == ("complaint", "Sosial", None, "", "medium", "netral", "")
    assert got["3"][1] == "Lainnya"


def test_resume_takes_labels_by_id(spark):
    base = rows(spark).drop("urgency", "kategori")
    old = spark.createDataFrame([("3", "low", "x"), ("9", "high", "y")], "id string, urgency string, summary string")
    got = {r["id"]: (r["urgency"], r["summary"]) for r in A.resume(base, old, ("urgency", "summary")).collect()}
    assert got == {"1": (None, None), "2": (None, None), "3": ("low", "x")}
    assert A.resume(base, None, ("urgency",)).columns[-1] == "urgency"


def test_rows_without_or_with_repeated_ids(spark):
    df = spark.createDataFrame(
        [(None, "j", "a"), ("1", "j", "b"), ("1", "j", "c"), ("2", "j", "d"), ("2", "j", "d"), (None, "j", "e")],
        "id string, judul string, isi string",
    )
    got = A.annotate_urgency(df, lambda: lambda texts: ["HIGH" for _ in texts]).collect()
    assert sorted((r["isi"], r["urgency"]) for r in got) == [(x, "high") for x in "abcdde"]
    old = spark.createDataFrame([("1", "low"), ("1", "high"), (None, "low")], "id string, urgency string")
    got = A.resume(df, old, ("urgency",)).collect()
    assert sorted((r["isi"], r["urgency"] or "") for r in got) == [
        ("a", ""), ("b", "high"), ("c", "high"), ("d", ""), ("d", ""), ("e", "")
    ]


def test_the_system_instruction_reaches_the_model(spark):
    def model(system):
        return lambda texts: ['{"summary": "%s"}' % system[:10] for _ in texts]

    got = A.annotate_full(rows(spark), model, pause=0).filter("id = '2'").first()
    from suarakit.constants import FULL_LABEL_SYSTEM

    assert got["summary"] == FULL_LABEL_SYSTEM[:10]


def test_resume_goes_row_by_row(spark):
    base = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, None), (2, "e")], "id long, isi string")
    done = spark.createDataFrame([("1", "a", "high"), ("1", "b", "low"), (None, "d", "medium"), ("2", None, "low")], "id string, isi string, urgency string")
    got = {(r.id, r.isi): r.urgency for r in A.resume(base, done, ("urgency",)).collect()}
    assert got == {(1, "a"): "high", (1, "b"): "low", (None, "c"): None, (None, "d"): "medium", (2, None): "low", (2, "e"): None}


def test_a_killed_run_asks_only_the_rest(spark, tmp_path):
    """A run that dies after some slices leaves their answers; rows without an id are no exception."""
    import pytest

    calls, ledger = tmp_path / "calls", str(tmp_path / "ledger")
    calls.mkdir()

    def model(dies=False):
        folder = str(calls)

        def make():
            def answer(texts):
                import os
                import uuid

                if dies and len(os.listdir(folder)) > 4:
                    raise SystemExit(3)
                with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                    f.write("\n".join(texts))
                return [t.upper() for t in texts]

            return answer

        return make

    rows = [(None if i % 3 == 0 else i, f"text {i % 30}") for i in range(60)]
    prompts = spark.createDataFrame(rows, "id int, prompt string").repartition(2)
    with pytest.raises(Exception):
        A.ask_with_ledger(prompts, model(True), ledger, rows_per_slice=4, retries=0, pause=0.0)
    first = [line for f in calls.iterdir() for line in f.read_text().split("\n")]
    kept = {r.raw.lower() for r in spark.read.parquet(ledger).collect()}
    assert 0 < len(kept) < 30
    for f in calls.iterdir():
        f.unlink()
    out = A.ask_with_ledger(prompts, model(), ledger, rows_per_slice=4, retries=0, pause=0.0)
    assert sorted((r.id or -1, r.raw, r.status) for r in out.collect()) == sorted((i or -1, p.upper(), "ok") for i, p in rows)
    again = [line for f in calls.iterdir() for line in f.read_text().split("\n")]
    assert set(again) == {p for _, p in rows} - kept and len(again) == len(set(again)) and kept <= set(first)
    for f in calls.iterdir():
        f.unlink()
    A.ask_with_ledger(prompts, model(), ledger).collect()
    assert not list(calls.iterdir())


def test_failed_calls_are_asked_again(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    prompts = spark.createDataFrame([(1, "good"), (2, "bad")], "id int, prompt string")

    def shaky():
        def answer(texts):
            if "bad" in texts:
                raise TimeoutError
            return texts

        return answer

    def sound():
        return lambda texts: [t + "!" for t in texts]

    out = A.ask_with_ledger(prompts, shaky, ledger, retries=0, pause=0.0)
    assert {r.id: (r.raw, r.status) for r in out.collect()} == {1: ("good", "ok"), 2: (None, "timeout")}
    out = A.ask_with_ledger(prompts, sound, ledger, retries=0, pause=0.0)
    assert {r.id: (r.raw, r.status) for r in out.collect()} == {1: ("good", "ok"), 2: ("bad!", "ok")}
    other = A.ask_with_ledger(prompts, sound, ledger, retries=0, pause=0.0, system="another task")
    assert {r.id: r.raw for r in other.collect()} == {1: "good!", 2: "bad!"}
