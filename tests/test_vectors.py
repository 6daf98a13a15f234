import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from suarakit.operators import neighbours
from suarakit.operators.embed import embed
from suarakit.operators.near_duplicates import check_duplicates, deduplicate_arrivals, first_come
from suarakit.operators.neighbours import Lsh, nearest

SCHEMA = "vec_id long, embedding array<float>"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], schema).repartition(4)


def clustered(n=600, dim=12, seed=3):
    """A third of the rows are one vector, a third nearly so, the rest spread out."""
    rng = np.random.default_rng(seed)
    hub = rng.standard_normal(dim)
    rows = [hub] * (n // 3)
    rows += [hub + 0.05 * rng.standard_normal(dim) for _ in range(n // 3)]
    rows += list(rng.standard_normal((n - len(rows), dim)))
    rng.shuffle(rows)
    m = np.array(rows, dtype=np.float32).astype(float)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def brute_top1(m, ordered):
    s = np.round(m @ m.T, 9)
    if ordered:
        s[np.triu_indices(len(m))] = -np.inf
    best = s.argmax(axis=1)
    return [(None if s[i, b] == -np.inf else int(b)) for i, b in enumerate(best)], s.max(axis=1)


@pytest.mark.parametrize("block_rows,broadcast_bytes", [(None, 1 << 20), (16, 1 << 20), (16, 0), (400, 0)])
@pytest.mark.parametrize("ordered", [False, True])
def test_exact_search_equals_brute_force(spark, block_rows, broadcast_bytes, ordered):
    m = clustered()
    df = frame(spark, enumerate(m.astype(np.float32)))
    found = nearest(
        df, df, order_col="vec_id" if ordered else None, block_rows=block_rows, broadcast_bytes=broadcast_bytes
    ).collect()
    ids, sims = brute_top1(m, ordered)
    got = {r["id"]: r for r in found}
    assert len(found) == len(m) == len(got)
    for i, expected in enumerate(ids):
        if expected is None:
            assert got[i]["nearest_id"] is None
        else:
            # Single-precision input: compare by similarity, and by id for exact copies.
            assert got[i]["similarity"] == pytest.approx(sims[i], abs=1e-6)
            assert got[i]["nearest_id"] <= i if ordered else got[i]["nearest_id"] is not None


def test_threshold_prunes_only_what_cannot_matter(spark):
    m = clustered(300)
    df = frame(spark, enumerate(m.astype(np.float32)))
    got = {r["id"]: r["nearest_id"] for r in nearest(df, df, order_col="vec_id", min_similarity=0.9, block_rows=8, broadcast_bytes=0).collect()}
    s = np.round(m @ m.T, 4)
    for i in range(len(m)):
        assert (got[i] is not None) == bool((s[i, :i] >= 0.9).any())


def test_zero_vectors_and_empty_store(spark):
    df = frame(spark, [(0, [0, 0]), (1, [1, 0]), (2, [0, 0])])
    got = {r[0]: tuple(r)[1:] for r in check_duplicates(df, df.filter("false")).collect()}
    assert set(got.values()) == {(False, 0.0, None)}
    got = {r[0]: tuple(r)[1:] for r in check_duplicates(df, df, order_col="vec_id").collect()}
    assert got == {i: (False, 0.0, None) for i in range(3)}
    assert sorted(r[0] for r in first_come(df).collect()) == [0, 1, 2]


def test_ties_go_to_the_smallest_id(spark):
    store = frame(spark, [(7, [2, 0]), (3, [1, 0]), (5, [1, 0]), (1, [0, 1])])
    batch = frame(spark, [(9, [3, 0])])
    assert nearest(batch, store).first()["nearest_id"] == 3


def test_own_id_is_no_duplicate_but_keeps_its_score(spark):
    store = frame(spark, [(1, [1, 0]), (2, [0.9, 0.1])])
    got = {r[0]: tuple(r)[1:] for r in check_duplicates(frame(spark, [(1, [1, 0]), (4, [1, 0])]), store).collect()}
    assert got == {1: (False, 1.0, None), 4: (True, 1.0, 1)}


def test_first_come_example(spark):
    df = spark.createDataFrame(
        [("a", 1, [1.0, 0.0]), ("b", 2, [0.8, 0.6]), ("c", 3, [0.0, 1.0]), ("d", 4, [0.6, 0.8])],
        "id string, seq long, embedding array<float>",
    )
    for options in ({"block_rows": 4096}, {"block_rows": 1}, {"method": "lsh", "lsh": Lsh(40, 3)}):
        got = sorted(map(tuple, deduplicate_arrivals(
            df, id_col="id", order_col="seq", threshold=0.6, **options).collect()))
        assert got == [("a", False, 0.0, None, True), ("b", True, 0.8, "a", False),
                       ("c", False, 0.0, None, True), ("d", True, 0.8, "c", False)]


def greedy(m, threshold):
    s, kept = np.round(m @ m.T, 4), []
    for i in range(len(m)):
        if not kept or s[i, kept].max() < threshold:
            kept.append(i)
    return kept


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.95])
@pytest.mark.parametrize("block_rows", [4096, 20])
def test_first_come_equals_sequential_pass(spark, threshold, block_rows):
    m = clustered(300)
    df = frame(spark, enumerate(m.astype(np.float32)))
    got = sorted(r[0] for r in first_come(df, threshold=threshold, block_rows=block_rows).collect())
    assert got == greedy(m, threshold)


@pytest.mark.parametrize("sf,kept", [("0.001", 346), ("0.01", 332), ("0.1", 799)])
def test_first_come_on_the_fixture(spark, sf, kept):
    e = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet")
    assert first_come(e, threshold=0.35).count() == kept


def test_store_seeds_and_resubmitted_ids(spark):
    m = clustered(200)
    rows = list(enumerate(m.astype(np.float32)))
    whole = deduplicate_arrivals(frame(spark, rows), threshold=0.6)
    expected = {r["vec_id"]: tuple(r)[1:] for r in whole.collect()}
    first = deduplicate_arrivals(frame(spark, rows[:90]), threshold=0.6)
    kept = {r["vec_id"] for r in first.filter("is_stored").collect()}
    store = frame(spark, [r for r in rows[:90] if r[0] in kept])
    again = sorted(kept)[0]
    second = deduplicate_arrivals(frame(spark, rows[90:] + [rows[again]]), store, threshold=0.6, block_rows=16)
    got = {r["vec_id"]: tuple(r)[1:] for r in second.collect()}
    assert got.pop(again) == (False, 1.0, None, False)
    assert got == {i: expected[i] for i, _ in rows[90:]}


@pytest.mark.parametrize("order", ["seq", "struct(seq)"])
def test_repeated_and_missing_ids(spark, order):
    rows = [("1", 0, [1.0, 0.0]), ("1", 1, [0.0, 1.0]), ("1", 2, [1.0, 0.01]), ("2", 3, [0.0, 1.0]),
            (None, 4, [-1.0, 0.0]), (None, 5, [0.0, -1.0]), ("3", 6, [0.0, -1.0]), ("2", 7, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "id string, seq long, embedding array<double>").repartition(3)
    df = df.withColumn("place", F.expr(order))
    got = deduplicate_arrivals(df, id_col="id", order_col="place", threshold=0.6).collect()
    # The second row has a stored id, so its vector is not stored and the fourth row is new.
    wanted = [("1", False, 0.0, None, True), ("1", False, 0.0, None, False), ("1", False, 1.0, None, False),
              ("2", False, 0.01, None, True), (None, False, 0.0, None, True), (None, False, 0.0, None, True),
              ("3", True, 1.0, None, False), ("2", False, 0.0, None, False)]
    assert sorted((str(r[0]), r[1], r[3], r[4]) for r in got) == sorted((str(w[0]), w[1], w[3], w[4]) for w in wanted)


def test_result_does_not_depend_on_blocks(spark):
    store = frame(spark, [(1, [0.49999999945, 0.8660254040961]), (2, [0.5000000004, 0.8660254035534])], "vec_id long, embedding array<double>")
    one = frame(spark, [(9, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert {nearest(one, store, block_rows=b).first()["nearest_id"] for b in (64, 1)} == {2} or {
        nearest(one, store, block_rows=b).first()["nearest_id"] for b in (64, 1)} == {1}


def test_lsh_compares_fewer_pairs_the_larger_the_store():
    shares = []
    for n in (500, 2000, 100_000, 10_000_000):
        lsh = Lsh.sized(n)
        shares.append(lsh.bands / 2**lsh.bits)  # of all pairs, if vectors are spread out
    assert shares == sorted(shares, reverse=True) and shares[0] < 0.1


def test_lsh_recall(spark):
    rng = np.random.default_rng(4)
    m = rng.standard_normal((600, 32))
    near = m + 0.9 * rng.standard_normal(m.shape)
    store, batch = frame(spark, enumerate(m)), frame(spark, enumerate(near))
    exact = {r["id"]: r["nearest_id"] for r in nearest(batch, store, min_similarity=0.6).collect() if r["nearest_id"] is not None}
    found = {r["id"]: r["nearest_id"] for r in nearest(batch, store, method="lsh").collect()}
    assert len(exact) > 300 and sum(found[i] == j for i, j in exact.items()) >= 0.9 * len(exact)


def test_encoder_runs_once_per_task_and_gives_unit_vectors(spark):
    def encoder():
        return lambda texts: np.array([[len(t), 1.0, 0.0] for t in texts])

    df = spark.createDataFrame([("ab",), (None,), ("abcd",)], "text string").repartition(2)
    got = {r["text"]: r["embedding"] for r in embed(df, encoder).collect()}
    assert got[None] == pytest.approx([0, 1, 0])
    assert got["ab"] == pytest.approx([2 / 5 ** 0.5, 1 / 5 ** 0.5, 0])
    assert embed(df.filter("false"), encoder).count() == 0


def test_a_crowded_cell_is_split(spark):
    """No block holds more vectors than about the block size, whatever the skew."""
    from suarakit.operators import neighbours as N

    m = np.repeat(clustered(20), 40, axis=0) + np.random.default_rng(0).normal(0, 1e-4, (800, 12))
    s = frame(spark, enumerate(m)).select(F.col("vec_id").alias("id"), F.lit(0).cast("long").alias("ord"), F.col("embedding").alias("vec"))
    routed, _, parts = N._pivot_cells(s, 800, 25, False, None)
    sizes = F.array(*[F.lit(p) for p in parts])
    blocks = N._pack_store(routed.withColumn("parts", F.get(sizes, F.col("cell").cast("int"))))
    assert blocks.agg(F.max(F.size("s_rows"))).first()[0] < 100


@pytest.mark.parametrize("options", [{"finish_at": 0}, {"edges_per_row": 1, "finish_at": 0}, {"edges_per_row": 0}, {}])
def test_rounds_on_edges_equal_sequential_pass(spark, options):
    """The same rows are kept by rounds on edges, by vector rounds first, and by one pass."""
    m = clustered(300)
    df = frame(spark, enumerate(m.astype(np.float32)))
    for threshold in (0.3, 0.6):
        got = sorted(r[0] for r in first_come(df, threshold=threshold, **options).collect())
        assert got == greedy(m, threshold)


@pytest.mark.parametrize("options", [{"finish_at": 0}, {"edges_per_row": 0, "finish_at": 0}, {}])
def test_repeated_ids_in_rounds(spark, options):
    rng = np.random.default_rng(11)
    m = rng.standard_normal((240, 6))
    ids = [None if i % 13 == 0 else str(i % 40) for i in range(240)]
    s = np.round(m @ m.T / np.linalg.norm(m, axis=1) / np.linalg.norm(m, axis=1)[:, None], 4)
    kept, taken = [], set()
    for i in range(240):
        if ids[i] in taken or any(s[i, j] >= 0.8 for j in kept):
            continue
        kept.append(i)
        taken |= {ids[i]} - {None}
    df = spark.createDataFrame([(ids[i], i, m[i].tolist()) for i in range(240)], "id string, seq long, embedding array<double>").repartition(3)
    got = first_come(df, id_col="id", order_col="seq", threshold=0.8, **options)
    assert sorted(r.seq for r in got.collect()) == kept


def test_single_precision_never_decides(spark):
    """Pairs that only double precision tells apart, and ties, as by a plain comparison."""
    from suarakit.operators import neighbours as N
    import pyarrow as pa

    rng = np.random.default_rng(8)
    m = rng.standard_normal((3000, 26))
    m[1000:2000] = m[0] + 1e-6 * rng.standard_normal((1000, 26))
    m[2000:2100] = m[7]
    units = N._unit(m)
    sims = np.round(units @ units.T, 9)
    rows = pa.StructArray.from_arrays([pa.array(np.arange(3000)), pa.array(np.arange(3000)), pa.array(m.tolist())], ["id", "ord", "vec"])
    stored, best, pairs = N._Stored(rows.take(pa.array(rng.permutation(3000)))), {}, set()
    least = 0.62
    for ids, part, before in stored.chunks(rows, True):
        ids = ids.to_numpy()
        found, at, sim = N._first_best(stored, part, before)
        best |= {int(ids[i]): (int(j), s) for i, j, s in zip(found, at, sim)}
        for i, j in N._similar(stored, part, before, least):
            pairs |= set(zip(ids[i].tolist(), j.tolist()))
    low = np.tril(np.ones_like(sims, bool), -1)
    assert pairs == set(zip(*(x.tolist() for x in np.nonzero(low & (np.round(sims, 4) >= least)))))
    expected = np.where(low, sims, -np.inf)
    assert best.keys() == set(range(1, 3000))
    assert all(abs(best[i][1] - expected[i].max()) < 2e-9 and expected[i, best[i][0]] > expected[i].max() - 2e-9 for i in best)


def test_query_rows_meet_few_blocks(spark):
    """Before, a row was copied to a block for every 4,096 stored rows, in batches as they came."""
    from suarakit.operators import neighbours as N

    vec = F.array(*[F.sin(F.col("id") * (i + 1)) for i in range(8)]).alias("vec")
    rows = spark.range(0, 30_000, 1, 4).select("id", F.col("id").alias("ord"), vec)
    size = N._size(rows)
    met = N._met(rows, rows, size, True, 0.99, None, N._block_rows(size), 0)
    n, copies = met.agg(F.count("*"), F.sum(F.size("q_rows"))).first()
    assert copies == 30_000 and n <= 8


def test_a_stored_block_takes_little_more_than_its_vectors():
    rng = np.random.default_rng(9)
    n, dim = 20_000, 64
    vectors = rng.standard_normal((n, dim)).astype(np.float32)
    order = rng.permutation(n)
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * dim)
    rows = pa.StructArray.from_arrays(
        [pa.array(order), pa.array(order), pa.ListArray.from_arrays(offsets, pa.array(vectors.ravel()))], ["id", "ord", "vec"]
    )
    arrow = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        stored = neighbours._Stored(rows)
        taken = tracemalloc.get_traced_memory()[1] + pa.total_allocated_bytes() - arrow
    finally:
        tracemalloc.stop()
    assert taken < 2 * vectors.nbytes
    # The same unit vectors in the same order as made at once.
    units = neighbours._unit(vectors)[np.argsort(order)]
    assert (stored.units(slice(None)) == units).all() and (stored.single.T == units.astype(np.float32)).all()
    at = rng.integers(0, n, 5000)
    assert (stored.exact(units[:10], at % 10, at) == np.round(np.einsum("ij,ij->i", units[at % 10], units[at]), 9)).all()
