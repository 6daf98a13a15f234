import random

import numpy as np
import pytest
import xxhash

from suarakit.llm import simhash
from suarakit.llm.components import components
from tests.llm import fixtures


def fingerprint(text):
    words = fixtures.lower(text).translate({c: 32 for c in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints, most=4):
    """Smallest index linked to each fingerprint, by comparing all pairs."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= most:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(prints))]


def test_matches_brute_force(spark):
    rng = random.Random(2)
    given = fixtures.texts(5, 40)
    for base in [t for t in given if t and len(t.split()) > 60][:4]:
        for _ in range(6):
            words = base.split(" ")
            words[rng.randrange(len(words))] = "changed"
            given.append(" ".join(words))
    rows = fixtures.rows(given)
    found = simhash.near_duplicates(fixtures.documents(spark, given)).collect()
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    prints = [fingerprint(rows[i][1]) for i in order]
    linked = roots(prints)
    wanted = [(rows[order[i]][0], prints[i], rows[order[linked[i]]][0]) for i in range(len(order))]
    got = [(r.id, r.fingerprint & (2**64 - 1), r.component_id) for r in found]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))
    assert len({w[2] for w in wanted}) < len(wanted) - 10


def clusters(rng, n_clusters, size, flips, n_random):
    out = []
    for _ in range(n_clusters):
        centre = rng.getrandbits(64)
        for _ in range(size):
            value = centre
            for _ in range(rng.randrange(flips + 1)):
                value ^= 1 << rng.randrange(64)
            out.append(value)
    return out + [rng.getrandbits(64) for _ in range(n_random)] + [0, 1, 2**64 - 1, 2**63]


@pytest.mark.parametrize("most,bucket_rows", [(4, 1024), (4, 5), (1, 40), (7, 16), (0, 8)])
def test_links_reach_all_close_pairs(spark, most, bucket_rows):
    prints = sorted(set(clusters(random.Random(most), 6, 60, 3, 300)))
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in prints]
    df = spark.createDataFrame(signed, "fingerprint bigint").repartition(4)
    edges = simhash.links(df, most, bucket_rows)
    pairs = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in edges.collect()]
    assert all(bin(a ^ b).count("1") <= most for a, b in pairs)
    found = {r.node & (2**64 - 1): r.root & (2**64 - 1) for r in components(edges).collect()}
    linked = roots(prints, most)
    groups, wanted = {}, {}
    for p, r in zip(prints, linked):
        wanted.setdefault(r, set()).add(p)
        groups.setdefault(found.get(p, p), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_every_plan_keeps_the_pigeonhole_sum():
    rng = np.random.default_rng(1)
    bits = (rng.random((500, 64)) < rng.random(64)).astype(float)
    bits[:, 10:20] = bits[:, :1]
    both = bits.T @ bits
    for n in (10, 10_000, 100_000_000):
        for most in (0, 2, 4, 6):
            groups, thresholds = simhash.plan_probes(both, n, most)
            assert sorted(b for g in groups for b in g) == list(range(64))
            assert sum(thresholds) >= most - len(groups) + 1 and min(thresholds) >= -1
    together = [g for g in simhash.group_bits(both, 500, 4) if 10 in g][0]
    assert set(range(10, 20)) <= set(together)


def test_nothing_in_nothing_out(spark):
    assert simhash.near_duplicates(fixtures.nothing(spark)).count() == 0
    one = spark.createDataFrame([(5, None)], "doc_id bigint, text string")
    assert [tuple(r)[2:] for r in simhash.near_duplicates(one).collect()] == [(0, 5, True)]
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (5000, -3), (5000, -3)]
    found = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert all(found[i] == 0 for i in range(201))
    assert all(found[i] == 1000 for i in range(1000, 1300)) and found[5000] == -3 == found[-3]


def test_probes_are_linked_once_to_each_group():
    """A ball of near fingerprints, half of them probes, gives about an edge a row, and the same groups."""
    import numpy as np

    rng = np.random.default_rng(3)
    ball = np.unique([sum(1 << int(b) for b in rng.choice(64, 2, replace=False)) for _ in range(4000)]).astype(np.uint64)[:2000]
    far = ball ^ np.uint64(0xFFFFFFFF00000000)
    own, probes = np.concatenate([ball[::2], far[::2]]), np.concatenate([ball[1::2], far[1::2]])
    edges = simhash._forest(own, probes, 4)
    assert sum(len(a) for a, _ in edges) <= 2 * (len(own) + len(probes))
    parent = {int(x): int(x) for x in np.concatenate([own, probes])}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        for x, y in zip(a.tolist(), b.tolist()):
            assert bin(x ^ y).count("1") <= 4
            parent[root(x)] = root(y)
    assert len({root(int(x)) for x in own}) == len({root(x) for x in parent}) == 2
