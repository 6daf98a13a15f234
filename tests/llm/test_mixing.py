import re

import pytest
from pyspark.sql import functions as F

from suarakit.llm import mixing
from tests.llm import fixtures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(3, 1, 2), budget=1.5, cap=2.0):
    """Share in rounds: whoever exceeds the cap gets the cap, the rest share what is left."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = budget * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: cap * sizes[s] for s in over})


def test_targets_and_taken_words(spark):
    given = fixtures.texts(3, 150)
    rows = fixtures.rows(given)
    found = mixing.mix(fixtures.documents(spark, given)).collect()
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(WORD.findall(r[1] or ""))
    wanted, taken = targets(sizes), dict.fromkeys(sizes, 0)
    assert len(found) == len(rows)
    assert sorted((repr(r.id), r.size) for r in found) == sorted((repr(r[0]), len(WORD.findall(r[1] or ""))) for r in rows)
    for r in found:
        assert r.target == pytest.approx(wanted[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= max(20, 0.01 * target), (source, taken[source], target)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 10}, {"a": 0, None: 5}, {"x": 7}, {"a": 0, "b": 0}])
def test_capped_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = {r.source: r.target for r in mixing.share_targets(table).collect()}
    assert found == pytest.approx(targets(sizes))


def test_newton_meets_targets_with_uneven_base_rates(spark):
    cells = [("a", 0.1, 100.0), ("a", 1.0, 50.0), ("a", 1.9, 10.0), ("b", 0.5, 1000.0), (None, 1.0, 30.0)]
    goals = [("a", 200.0), ("b", 1.0), (None, 60.0)]
    tilts = mixing.newton_tilts(
        spark.createDataFrame(cells, "source string, base double, tokens double"),
        spark.createDataFrame([(s, 1, t) for s, t in goals], "source string, source_size bigint, target double"),
    )
    tilt = {r.source: r.tilt for r in tilts.collect()}
    import math

    for source, goal in goals:
        got = sum(n * min(2.0, base * math.exp(tilt[source])) for s, base, n in cells if s == source)
        assert got == pytest.approx(goal, rel=1e-6)


def test_reruns_and_partitions_agree(spark):
    docs = fixtures.documents(spark)
    a = sorted(map(repr, mixing.mix(docs.repartition(1)).collect()))
    b = sorted(map(repr, mixing.mix(docs.repartition(7), group_rows=2048).collect()))
    assert a == b
    assert mixing.mix(fixtures.nothing(spark)).count() == 0


def test_small_groups_still_meet_the_target(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(pmod(xxhash64(id), 50) + 1 as int))").alias("text"), F.lit("s").alias("source"))
    sums = mixing.mix(docs, group_rows=100).agg(F.sum("taken"), F.max("target")).first()
    assert abs(sums[0] - sums[1]) < 0.01 * sums[1]


def test_equal_rows_are_dealt_to_several_groups(spark):
    rows = [(None, "one two three", "hot")] * 900 + [(i, "w " * (i % 7 + 1), "hot") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    made = mixing.mix(df, group_rows=100).collect()
    assert len(made) == 960 and sum(r.id is None for r in made) == 900
    taken, target = sum(r.taken for r in made), made[0].target
    assert abs(taken - target) <= 40 and all(r.taken <= 2 * r.size for r in made)


def raked(cells, margins, rounds=4000):
    """Iterative proportional fitting, without a cap."""
    rate = [c["base"] for c in cells]
    for _ in range(rounds):
        for name, wanted in margins.items():
            for value, target in wanted.items():
                own = [i for i, c in enumerate(cells) if c[name] == value]
                now = sum(rate[i] * cells[i]["tokens"] for i in own)
                for i in own:
                    rate[i] *= target / now
    return rate


def test_targets_that_cross(spark):
    """Sources, languages and length bands at once: the rates of iterative proportional fitting, and every target met."""
    import random

    rng = random.Random(3)
    cells = [
        {"source": s, "lang": g, "band": b, "base": rng.choice([0.5, 1.0, 1.5]), "tokens": float(rng.randrange(10, 500))}
        for s in ("a", "b", None) for g in ("x", "y", "z") for b in (0, 1) for _ in range(2)
    ]
    rate = [rng.uniform(0.3, 1.2) for _ in cells]
    total = lambda name, value: sum(r * c["tokens"] for r, c in zip(rate, cells) if c[name] == value)
    margins = {"source": {s: total("source", s) for s in ("a", "b", None)}, "lang": {g: total("lang", g) for g in "xyz"}, "band": {0: total("band", 0)}}
    df = spark.createDataFrame(cells, "source string, lang string, band int, base double, tokens double").repartition(3)
    out = mixing.cross_balance(df, margins, cap=1e6).collect()
    for name, wanted in margins.items():
        for value, target in wanted.items():
            assert abs(sum(r.rate * r.tokens for r in out if r[name] == value) - target) < 1e-4 * target
    key = lambda s, g, b, base, tokens: (s or "", g, b, base, tokens)
    fitted = {key(*c.values()): r for c, r in zip(cells, raked(cells, margins))}
    assert all(abs(fitted[key(r.source, r.lang, r.band, r.base, r.tokens)] - r.rate) < 1e-3 * r.rate for r in out)


def test_crossing_targets_with_a_cap_meet_the_conditions(spark):
    """With a cap: targets met, and uncapped rates are the base times one factor for each value."""
    import math

    cells = [("a", "x", 1.0, 100.0), ("a", "y", 1.0, 300.0), ("b", "x", 0.5, 200.0), ("b", "y", 1.0, 50.0), ("c", "x", 1.0, 80.0)]
    df = spark.createDataFrame(cells, "source string, lang string, base double, tokens double")
    margins = {"source": {"a": 420.0, "b": 250.0}, "lang": {"x": 450.0}}
    out = {(r.source, r.lang): r for r in mixing.cross_balance(df, margins, cap=2.0).collect()}
    assert all(r.rate <= 2.0 + 1e-12 for r in out.values())
    assert abs(out["a", "x"].rate * 100 + out["a", "y"].rate * 300 - 420) < 1e-3
    assert abs(out["b", "x"].rate * 200 + out["b", "y"].rate * 50 - 250) < 1e-3
    assert abs(out["a", "x"].rate * 100 + out["b", "x"].rate * 200 + out["c", "x"].rate * 80 - 450) < 1e-3
    assert abs(math.log(out["a", "x"].rate / out["a", "y"].rate) - math.log(out["c", "x"].rate)) < 1e-4
    assert mixing.cross_balance(df.limit(0), margins).count() == 0
