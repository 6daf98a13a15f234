import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from suarakit.functions import jsonx, labels

ONE = ('{"intent":"Report","kategori":"Lingkungan","location":"None","objek":"sampah",'
       '"urgency":"HIGH","sentiment":"Negatif","ringkasan":"x"}')


def _python_parse(raw):
    """What a strict reader with a brace fallback makes of a text; None if nothing."""
    for t in (raw, raw[raw.find("{"): raw.rfind("}") + 1] if "{" in raw else ""):
        try:
            return True, json.loads(t, parse_constant=lambda c: (_ for _ in ()).throw(ValueError()))
        except ValueError:
            pass
    return False, None


def test_parse_examples(apply):
    rows = ['{"a":1} tail', '{"a":1} {"b":2}', "x", '{"a":1}] {"b":2}', '{"a":1,"a":2}', "[1]", "", None, " 3 "]
    got = apply(rows, lambda c: F.to_json(jsonx.parse_tolerant(c)))
    assert got == ['{"a":1}', None, None, None, '{"a":2}', "[1]", None, None, "3"]


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(st.text(alphabet=list('{}[]",:a1 \n'), max_size=14), min_size=120, max_size=120))
def test_parse_agrees_with_python(apply, rows):
    rows = rows + ["x" + r for r in rows] + [json.dumps({"k": r}) + r for r in rows]
    got = apply(rows, lambda c: F.to_json(jsonx.parse_tolerant(c)))
    for raw, value in zip(rows, got):
        found, expected = _python_parse(raw)
        assert (value is not None) == found, raw
        if found:
            assert json.loads(value) == expected


def test_validate_examples(apply):
    got = apply([ONE], labels.validate)
    assert tuple(got[0]) == ("report", "Lingkungan", None, "sampah", "high", "negatif", "x")
    got = apply([""], lambda c: labels.validate(c, F.lit("Sosial")))
    assert tuple(got[0]) == ("complaint", "Sosial", None, "", "medium", "netral", "")
    got = apply(['Berikut: {"intent":"spam","kategori":"lingkungan"} selesai'], labels.validate)
    assert tuple(got[0]) == ("complaint", "Lainnya", None, "", "medium", "netral", "")
    # Members of the wrong type fall back instead of failing the job.
    got = apply(['{"intent":1,"urgency":["high"],"sentiment":null,"kategori":{},"location":"-"}', "[1]"],
                labels.validate)
    assert {tuple(g) for g in got} == {("complaint", "Lainnya", None, "", "medium", "netral", "")}


def test_convert_examples(apply):
    rows = [ONE, '{"category":"kebersihan"}', '{"kategori":null,"category":"Lingkungan"}', "not json", "[1]",
            '{"object":["a"],"summary":0,"lokasi":"Jl é"}']
    got = apply(rows, labels.convert_output)
    assert json.loads(got[0]) == {
        "intent": "complaint", "category": "kebersihan", "location": "None", "object": "sampah",
        "urgency": "high", "sentiment": "negative", "summary": "x"}
    blank = {"intent": "complaint", "category": "lainnya", "location": None, "object": "",
             "urgency": "medium", "sentiment": "neutral", "summary": ""}
    assert json.loads(got[1]) == blank and json.loads(got[2]) == blank
    assert got[3] == "not json" and got[4] is None
    assert json.loads(got[5]) == {**blank, "object": ["a"], "location": "Jl é"} and "é" in got[5]
    # Lossy: a converted category is no input category.
    assert json.loads(apply([got[0]], labels.convert_output)[0])["category"] == "lainnya"


def test_urgency_words(apply):
    rows = ["is HIGH.", "medium-high", "below", "tinggi", None]
    assert apply(rows, labels.urgency_word) == ["high", "high", "low", "unknown", "unknown"]


def test_needs_urgency_counts_null_and_errors(apply):
    rows = ["high", "low", None, "unknown", "error_timeout"]
    assert apply(rows, labels.needs_urgency) == [False, False, True, True, True]


def test_truthiness(apply):
    rows = ["null", '""', "0", "0.0", "-0", "false", "[]", "{}", '"0"', '"false"', "[0]", '{"a":0}', "true", "0.10", "0e3"]
    got = apply(rows, lambda c: jsonx.truthy(jsonx.parse_strict(c)))
    assert got == [bool(json.loads(r)) for r in rows]
