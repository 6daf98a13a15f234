import base64
import gzip
import hashlib
import io
import os
import re

import pytest

from suarakit.llm import warc


def pages(spark):
    big = "é" * 700_000 + "WARC/1.1\r\nWARC-Type: response\r\n\r\n"
    rows = [(i, f"http://x/{i}", t) for i, t in enumerate(["same", "other", "same", None, "", big, "same", big, "a\r\n\r\nb", "\n"])]
    rows += [(20, None, "z"), (21, "http://bad\r\nWARC-Type: no", "z2"), (None, "u", "z"), (None, "u", "alone"), (30, "u", "tie"), (30, "u", "tie")]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)


def expected(rows, least=0):
    newest = {}
    for i, t in rows:
        newest.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        body = (t or "").encode()
        ids = [x for x in newest[t or ""] if x is not None]
        revisit = len(body) >= least and ids and len(newest[t or ""]) > 1 and i != max(ids)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((i, len(body), digest, "revisit" if revisit else "response", max(ids) if revisit else None, True))
    return sorted(map(repr, out))


@pytest.mark.parametrize("least,chunk", [(0, 1 << 20), (5, 1000)])
def test_round_trip(spark, tmp_path, least, chunk):
    df = pages(spark)
    files = warc.write_archives(df, str(tmp_path / "w"), least_revisit=least, chunk=chunk)
    chunks = warc.read_archives(spark, files, chunk)
    rows = [(r.page_id, r.html) for r in df.collect()]
    assert sorted(map(repr, map(tuple, warc.record_summary(chunks).collect()))) == expected(rows, least)
    assert chunks.selectExpr("max(length(chunk))").first()[0] <= chunk
    texts = {}
    for r in sorted(chunks.collect(), key=lambda r: (r.record_id, r.record_type, r.chunk_no)):
        key = (r.record_id, r.record_type, r.declared_digest)
        texts[key] = texts.get(key, b"") + bytes(r.chunk) if r.chunk_no else bytes(r.chunk)
        assert r.bytes_so_far == len(texts[key]) or r.record_type == "revisit"
        assert r.digest_so_far == base64.b32encode(hashlib.sha1(texts[key]).digest()).decode()
    assert {t for (_, kind, _), t in texts.items() if kind == "response"} == {(t or "").encode() for _, t in rows}


def test_archives_are_valid_and_lost_files_do_not_count(spark, tmp_path):
    files = warc.write_archives(pages(spark), str(tmp_path / "w"))
    one = files.first().path
    raw = gzip.open(one).read()
    assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
    assert not re.search(rb"WARC-Type: no", raw.split(b"\r\n\r\n")[0])
    (tmp_path / "w" / "orphan.warc.gz").write_bytes(b"left by a lost task")
    assert warc.record_summary(warc.read_archives(spark, files)).count() == 16
    cut = open(one, "rb").read()[:-20]
    with pytest.raises(Exception):
        list(warc.read_records(io.BytesIO(cut)))
    assert len(list(warc.read_records(io.BytesIO(raw)))) >= 1  # plain archives as well
    assert os.path.getsize(one) < len(raw)


def test_nothing(spark, tmp_path):
    files = warc.write_archives(pages(spark).where("false"), str(tmp_path / "w"))
    assert files.count() == 0 and warc.read_archives(spark, files).count() == 0
