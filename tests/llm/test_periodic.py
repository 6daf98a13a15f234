"""Periodic runs against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from suarakit.llm import periodic
from suarakit.llm.queries import QUERIES
from tests.llm import fixtures


def brute(words):
    """Every lag, every stretch; a stretch counts for its smallest period."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smaller = any(all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(texts):
    rows = [list(t) for t in texts]
    first = np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int64)
    codes = np.array([c for r in rows for c in r], np.int64)
    out = [[] for _ in rows]
    for r, start, length, period in periodic.find(codes, first).tolist():
        out[r].append((start, length, period))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=4))
def test_small_alphabet(texts):
    assert found(texts) == [brute(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=20), st.integers(3, 8), st.lists(st.integers(0, 3), max_size=20))
def test_planted(period, times, around):
    text = around + period * times + around[::-1] + period * 4
    assert found([text, text[1:], [7, 7]]) == [brute(text), brute(text[1:]), []]


def test_hard_words():
    # Every 5-gram of the period occurs twice in it, and overlap-free words have no run.
    rng = np.random.default_rng(3)
    period = np.concatenate([rng.permutation(4), rng.permutation(4), rng.permutation(4)]).tolist() * 2
    period[5] = 9
    thue = [bin(i).count("1") % 2 for i in range(4096)]
    fib = [0, 1]
    a, b = [0], [0, 1]
    while len(b) < 500:
        a, b = b, b + a
    fib = b[:500]
    given_texts = [period * 9, thue[:700], fib, [1] * 500, thue]
    got = found(given_texts)
    assert got[:4] == [brute(t) for t in given_texts[:4]]
    assert got[4] == []


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(kept).encode()).hexdigest(),
    )


NAMES = "n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()


def test_awkward_rows(spark, tmp_path):
    texts = fixtures.texts()
    texts += ["a  b\ta b\na b a b a b", "x x x x x", "x x x x x x", " ".join(["lorem ipsum dolor"] * 9), "é é " * 8, "A a A a a A A A"]
    docs = fixtures.documents(spark, texts)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    wanted = [(r.doc_id, *expected(r.doc_id, r.text)) for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 20000]
    key = lambda r: tuple((v is not None, v) for v in r)
    ids = {r[0] for r in wanted}
    have = [(r.doc_id, *(r[n] for n in NAMES)) for r in got if r.doc_id in ids]
    assert sorted(have, key=key) == sorted(wanted, key=key)
    assert len(got) == docs.count()


def test_outputs_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b a b a b a b c", 1), (1, None, 2)], "doc_id int, text string, runs int")
    rows = sorted(periodic.periodic_runs(docs).collect(), key=lambda r: r.n_words)
    assert [(r.id, r.n_words, r.runs, r.collapsed) for r in rows] == [(1, 0, [], ""), (None, 9, [(0, 8, 2)], "a b c")]
    empty = periodic.periodic_runs(fixtures.nothing(spark))
    assert empty.count() == 0 and empty.columns == ["id", "n_words", "runs", "collapsed"]


@pytest.mark.parametrize("period", [1, 3, 50_000])
def test_very_long_text(spark, period):
    """One text of a million bytes: time in proportion to words, whatever the period."""
    text = " ".join(f"w{i % period}" for i in range(200_000)) + " end"
    row = periodic.periodic_runs(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert [tuple(r) for r in row.runs] == [(0, 200_000, period)]
    assert row.collapsed == " ".join(f"w{i}" for i in range(period)) + " end"


def test_small_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op12_periodic_runs"](spark, sf_dir).collect():
        if len(docs[r.doc_id] or "") < 4000:
            assert tuple(r[n] for n in NAMES) == expected(r.doc_id, docs[r.doc_id])
