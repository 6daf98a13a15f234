"""The vector table by cell: what a batch reads, what a repeated batch changes, and compaction."""

import os

import numpy as np
from pyspark.sql import functions as F

from suarakit.operators.neighbours import nearest
from suarakit.sources import vector_table as V
from suarakit.streaming import ingest
from tests.test_vectors import frame


def groups(n, seed=3):
    """Vectors around 12 directions, far apart."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, 24)) * 4
    return centres[np.arange(n) % 12] + 0.2 * rng.standard_normal((n, 24))


def files(path):
    return sorted(f"{d}/{f}" for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def content(spark, path):
    return sorted((r.vec_id, r.batch) for r in V.read(spark, path).select("vec_id", "batch").collect())


def test_a_batch_reads_only_probed_cells(spark, tmp_path):
    path, m = str(tmp_path / "t"), groups(2000)
    rows = list(enumerate(m.astype(np.float32)))
    V.append(frame(spark, rows[:1500]), path, 0)
    V.append(frame(spark, rows[1500:]), path, 1)
    near = frame(spark, [(-1, m[0] + 0.01), (-2, m[12] - 0.01)])
    found = V.probe(near, path)
    cells = {r.cell for r in found.select("cell").distinct().collect()}
    every = {r.cell for r in V.read(spark, path).select("cell").distinct().collect()}
    assert len(every) > 8 and len(cells) < len(every) / 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan
    read = {r[0].split("cell=")[1].split("/")[0] for r in found.select(F.input_file_name()).distinct().collect()}
    assert read == {str(c) for c in cells}
    # What is left out could not have been the nearest.
    wanted = {r.id: (r.nearest_id, r.similarity) for r in nearest(near, V.read(spark, path)).collect()}
    assert {r.id: (r.nearest_id, r.similarity) for r in nearest(near, found).collect()} == wanted
    earlier = V.probe(near, path, before=1)
    assert earlier.agg(F.max("batch")).first()[0] == 0


def test_repeated_batches_and_compaction(spark, tmp_path):
    path, m = str(tmp_path / "t"), groups(900)
    rows = list(enumerate(m.astype(np.float32)))
    for batch in range(9):
        V.append(frame(spark, rows[100 * batch : 100 * batch + 100]), path, batch)
    before = content(spark, path)
    assert before == sorted((i, i // 100) for i in range(900))
    V.append(frame(spark, rows[300:400]), path, 3)
    assert content(spark, path) == before
    # Another result of a batch replaces the first one, in cells it no longer touches, too.
    V.append(frame(spark, [(9000, m[800])]), path, 8)
    assert [x for x in content(spark, path) if x[1] == 8] == [(9000, 8)]
    V.append(frame(spark, rows[800:900]), path, 8)
    V.compact(spark, path, 7)
    assert content(spark, path) == sorted((i, 7 if i < 800 else 8) for i in range(900))
    cells = V.read(spark, path).select("cell").distinct().count()
    assert len(files(f"{path}/version=1/rows")) <= 2 * cells
    for batch in range(20, 24):
        V.append(frame(spark, [(10_000 + 100 * batch + i, v) for i, v in enumerate(m[:60])]), path, batch)
    assert len(files(f"{path}/version=1/rows")) > 3 * cells
    V.compact(spark, path, 23)
    assert len(files(f"{path}/version=2/rows")) == V.read(spark, path).select("cell").distinct().count()
    for batch in range(20, 24):  # merged by now: nothing changes
        V.append(frame(spark, rows[:1]), path, batch)
    assert len(content(spark, path)) == 900 + 240
    V.append(frame(spark, [(7777, m[5])]), path, 24)
    assert (7777, 24) in content(spark, path)
    # A compaction that died leaves the table as it was.
    (tmp_path / "t" / "version=3" / "rows").mkdir(parents=True)
    assert len(content(spark, path)) == 1141
    V.compact(spark, path, 24)
    assert len(content(spark, path)) == 1141 and not (tmp_path / "t" / "version=0").exists()


def test_nothing_and_zero_vectors(spark, tmp_path):
    path = str(tmp_path / "t")
    assert V.read(spark, path) is None and V.probe(frame(spark, [(1, [1.0, 0.0])]), path) is None
    V.append(frame(spark, [(1, [0.0, 0.0])]), path, 0)
    assert V.read(spark, path) is None
    V.append(frame(spark, [(1, [0.0, 0.0]), (2, [1.0, 0.0])]), path, 1)
    V.append(frame(spark, []), path, 2)
    assert content(spark, path) == [(2, 1)]
    assert V.probe(frame(spark, []), path).count() == 0


def test_stream_with_compaction_equals_one_without(spark, tmp_path):
    m = groups(240)
    m = np.concatenate([m, m[:40] + 0.02 * np.random.default_rng(1).standard_normal((40, 24))])
    rows = list(enumerate(m.astype(np.float32)))
    results = []
    for name, every in (("a", None), ("b", 2)):
        sink = ingest.near_duplicate_sink(str(tmp_path / name), threshold=0.98, compact_every=every)
        for batch in range(7):
            sink(frame(spark, rows[40 * batch : 40 * batch + 40]), batch)
            if batch == 4:
                sink(frame(spark, rows[160:200]), 4)
        found = spark.read.parquet(str(tmp_path / name / "verdicts")).drop("batch")
        results.append(sorted(map(tuple, found.collect())))
    assert len(results[0]) == 280 and results[0] == results[1]
