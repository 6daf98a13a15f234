import random
import sys

import numpy as np
import pyarrow as pa

from suarakit.llm import arrays, linechunks
from tests.llm import fixtures


def folded(text):
    piece = next(arrays.pieces(pa.array([text])))
    lines = linechunks.fold(piece)
    return [text.encode()[a:b].decode() for a, b in zip(lines.starts, lines.ends)]


def test_folding_keeps_all_words_and_ignores_the_neighbourhood():
    rng = random.Random(1)
    for _ in range(50):
        text = fixtures.sentence(rng, rng.randrange(1, 200))
        assert " ".join(folded(text)).split() == text.split()
    alone = folded("a b. c d, e f\ng")
    assert alone[0] == "a b." or alone[0] == "a"
    both = next(arrays.pieces(pa.array(["a b. c", "a b. c"])))
    lines = linechunks.fold(both)
    assert list(np.diff(lines.first)) == [len(folded("a b. c"))] * 2


def test_a_shared_span_has_shared_chunks():
    rng = random.Random(4)
    for _ in range(200):
        middle = "\n" + "\n".join(fixtures.sentence(rng, 5).replace("\n", " ") for _ in range(12)) + "\n"
        chunks = []
        for _ in range(2):
            text = fixtures.sentence(rng, rng.randrange(60)) + middle + fixtures.sentence(rng, rng.randrange(60))
            piece = next(arrays.pieces(pa.array([text])))
            chunks.append(set(linechunks.cut(linechunks.fold(piece)).hashes.tolist()))
        assert chunks[0] & chunks[1]


def repeated_words(texts):
    """Brute force over word runs: texts in order, words of a run of 50 or more seen at an earlier place."""
    seen, out = {}, []
    for d, text in enumerate(texts):
        words = (text or "").split()
        mark = [False] * len(words)
        for i in range(len(words) - 49):
            run = tuple(words[i : i + 50])
            if run in seen and (d, i) > seen[run]:
                mark[i : i + 50] = [True] * 50
            seen.setdefault(run, (d, i))
        out.append([w for w, m in zip(words, mark) if m])
    return out


def test_passages_go_and_the_rest_stays(spark):
    rng = random.Random(8)
    passages = [fixtures.sentence(rng, rng.randrange(55, 120)) + "." for _ in range(5)]
    texts = []
    for i in range(120):
        parts = [fixtures.sentence(rng, rng.randrange(5, 90)) for _ in range(3)]
        if i % 3 == 0:
            parts.insert(1, passages[i % 5])
        glue = rng.choice(["\n", ". "])
        texts.append(glue.join(parts))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(6)
    out = {r.doc_id: r for r in linechunks.remove_repeats(df, counts="gone").collect()}
    for i, text in enumerate(texts):
        if i % 3 == 0 and i >= 15:
            kept = out[i].text.split()
            assert out[i].gone >= 50
            middle = passages[i % 5].split()[6:-6]
            assert " ".join(middle) not in " ".join(kept)
        else:
            assert out[i].text == text and out[i].gone == 0
    # All of it is still somewhere, and nothing is left that repeats.
    assert not any(repeated_words([out[i].text for i in range(120)]))


def test_awkward_rows(spark):
    docs = fixtures.documents(spark)
    out = linechunks.remove_repeats(docs)
    assert out.schema == docs.schema and out.count() == docs.count()
    texts = {}
    for before in docs.collect():
        texts.setdefault(before.doc_id, []).append(before.text)
    for after in out.collect():
        given = texts[after.doc_id]
        if after.text is None:
            assert None in given
        else:
            assert any(set(after.text.split()) <= set((g or "").split()) for g in given)
    # The first of equal texts keeps its text, later copies lose it.
    rows = {r.doc_id: r.text for r in out.collect() if r.doc_id is not None}
    copies = [r[0] for r in fixtures.rows(fixtures.texts()) if r[1] == fixtures.texts()[0]]
    if len(fixtures.texts()[0].split()) >= 30:
        assert rows[copies[0]] == fixtures.texts()[0] and rows[copies[1]] == ""
    assert linechunks.remove_repeats(fixtures.nothing(spark)).count() == 0


def test_same_result_however_rows_are_dealt(spark):
    docs = fixtures.documents(spark)
    a = sorted(map(repr, linechunks.remove_repeats(docs.repartition(1)).collect()))
    b = sorted(map(repr, linechunks.remove_repeats(docs.repartition(9)).collect()))
    assert a == b


def test_fifty_words_in_mid_sentence_share_an_anchor():
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(1, 6)))
    for trial in range(600):
        few = [word() for _ in range(3)] if trial % 5 == 0 else None
        passage = " ".join((rng.choice(few) if few else word()) + ("." if rng.random() < (trial % 3) * 0.13 else "") for _ in range(50))
        anchors = []
        for _ in range(2):
            text = " ".join([*(word() for _ in range(rng.randrange(1, 40))), passage, *(word() for _ in range(rng.randrange(1, 40)))])
            lines = linechunks.fold(next(arrays.pieces(pa.array([text]))))
            assert lines.n_words.max() <= linechunks.FOLD
            anchors.append(set(linechunks._anchors(lines, linechunks.cut(lines), 5).hashes.tolist()))
        assert anchors[0] & anchors[1], passage


def test_unpunctuated_passages_of_51_words_go(spark):
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7)))
    passages = [[word() for _ in range(51)] for _ in range(60)]
    texts = [" ".join([word() for _ in range(20)] + p + [word() for _ in range(20)]) for _ in range(2) for p in passages]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    gone = {r.doc_id: r.gone for r in linechunks.remove_repeats(df, counts="gone").collect()}
    assert all(gone[i] == 0 and gone[i + 60] >= 41 for i in range(60))


def test_any_47_shared_words_hold_an_anchor():
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(1, 6)))
    for trial in range(1500):
        few = [word() for _ in range(3)] if trial % 5 == 0 else None
        passage = " ".join((rng.choice(few) if few else word()) + ("." if rng.random() < (trial % 3) * 0.13 else "") for _ in range(47))
        anchors = []
        for _ in range(2):
            text = " ".join([*(word() for _ in range(rng.randrange(1, 40))), passage, *(word() for _ in range(rng.randrange(1, 40)))])
            lines = linechunks.fold(next(arrays.pieces(pa.array([text]))))
            anchors.append(set(linechunks._anchors(lines, linechunks.cut(lines), linechunks.LEAST).hashes.tolist()))
        assert anchors[0] & anchors[1], passage


def test_what_is_carried_is_bounded(spark):
    """Short quotations of a long text that occurs twice carry pieces, not all of it."""
    rng = random.Random(31)
    long = " ".join(fixtures.sentence(rng, 1).split()[0] + str(i % 7) for i in range(6000))
    words = long.split()
    texts = [long, long]
    for i in range(200):
        at = rng.randrange(len(words) - 60)
        texts.append(fixtures.sentence(rng, 5) + " " + " ".join(words[at : at + 45]) + " " + fixtures.sentence(rng, 5))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    carried = sum(len(p["body"]) for r in linechunks.earlier_places(df).collect() for p in r.places)
    assert carried < 2.5 * sum(map(len, texts))
    out = {r.doc_id: r for r in linechunks.remove_repeats(df, counts="gone").collect()}
    assert out[0].gone == 0 and out[1].gone > 5900
    assert sum(out[i].gone >= 30 for i in range(2, 202)) >= 195


def test_very_long_text_and_a_hot_line(spark):
    rng = random.Random(41)
    long = "\n".join(fixtures.sentence(rng, 12).replace("\n", " ") for _ in range(20_000))
    hot = "all rights reserved by the owners of this page and nobody else may copy it in any form or by any means at all without asking the owners first for leave to do it"
    rows = [(0, long), (1, long), (2, None)] + [(i, f"{fixtures.sentence(rng, 20)}\n{hot}\n{fixtures.sentence(rng, 20)}") for i in range(3, 400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    out = {r.doc_id: r for r in linechunks.remove_repeats(df, counts="gone").collect()}
    assert out[0].gone == 0 and out[1].text == "" and out[2].text is None
    assert sum(out[i].gone >= 26 for i in range(4, 400)) >= 390


def test_smallest_of_windows_with_ties():
    rng = np.random.default_rng(3)
    for window in (1, 2, 3, 5, 14):
        values = rng.integers(0, 6, 300).astype(np.uint64)
        row = np.sort(rng.integers(0, 12, 300))
        last, wanted = np.zeros(300, bool), np.zeros(300, bool)
        linechunks._smallest(values, row, window, last)
        for i in range(300 - window + 1):
            if row[i] == row[i + window - 1]:
                part = values[i : i + window]
                wanted[i + np.flatnonzero(part == part.min())[-1]] = True
        assert (last == wanted).all()


def test_bytes_alike_from_two_places_on():
    rng = random.Random(5)
    a = b"".join(rng.choice([b"ab", b"ba", b"a", b"\x80" * 9]) for _ in range(400)) + b"z" * 1500
    b = a[100:] + b"y" + a[:900]
    at, other = zip(*((rng.randrange(len(a)), rng.randrange(len(b))) for _ in range(800)), *((100 + i, i) for i in range(0, len(a) - 100, 7)))
    most = [rng.choice([0, 1, 8, 10**9]) for _ in at]
    most = [min(m, len(a) - i, len(b) - j) for m, i, j in zip(most, at, other)]
    more = np.zeros(8, np.uint8)
    ours, theirs = (np.append(np.frombuffer(x, np.uint8), more) for x in (a, b))
    found = linechunks._alike(ours, np.array(at), theirs, np.array(other), np.array(most))
    for i, j, m, n in zip(at, other, most, found.tolist()):
        assert 0 <= n <= m and a[i : i + n] == b[j : j + n] and (n == m or a[i + n] != b[j + n])


def test_matches_are_followed_together():
    """A passage that one document repeats 400 times has as many diagonals; none costs calls of its own."""
    rng = random.Random(41)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7)))
    passage = " ".join(word() for _ in range(60)) + ". "
    own = [" ".join(word() for _ in range(rng.randrange(3, 9))) + ". " for _ in range(400)]
    text = "".join(passage + more for more in own)
    anchors = []
    for body in (passage, text):
        lines = linechunks.fold(next(arrays.pieces(pa.array([body]))))
        found = linechunks._anchors(lines, linechunks.cut(lines), linechunks.LEAST)
        at = linechunks._plain(next(arrays.pieces(pa.array([body]))), lines)[1]
        anchors.append((found.hashes.tolist(), found.low.tolist(), at))
    theirs = dict(zip(anchors[0][0], anchors[0][1]))
    shared = [{"line": low, "at": int(anchors[0][2][theirs[h]])} for h, low in zip(*anchors[1][:2]) if h in theirs]
    assert len(shared) >= 400
    type_ = pa.list_(pa.struct([("anchors", pa.list_(pa.struct([("line", pa.int32()), ("at", pa.int32())]))), ("body", pa.binary())]))
    places = pa.array([[{"anchors": shared, "body": (" ".join(passage.split()) + " ").encode()}]], type_)
    calls = [0]

    def count(frame, event, arg):
        calls[0] += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        ((row, kept, gone),) = linechunks._cleaned(pa.array([text]), places, 30)
    finally:
        sys.setprofile(None)
    # A run of matched lines is cut out by a handful of calls.
    assert row == 0 and gone >= 400 * 58 and calls[0] < 400 * 6
    assert kept.split() == [w for more in own for w in more.split()] or len(kept.split()) <= 400 * 10
