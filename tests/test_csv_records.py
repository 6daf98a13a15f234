"""Split reading of CSV equals the reader that takes each file in one task."""

import random

import pytest
from pyspark.sql import functions as F

from suarakit.sources import readers, writers
from suarakit.sources.csv_records import read_csv_split, records

SCHEMA = "id string, judul string, isi string"


def texts(seed, n):
    rng = random.Random(seed)
    pieces = ["kata", "a,b", '"', '""', "\n", "\n\n", " ", "é日本🙂", "", "x" * 50, "'", "\\", ";", "\t", "#", "\r\n"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 12))) for _ in range(n)]


def write(path, rows, newline="\n"):
    def field(x):
        return "" if x is None else '"' + x.replace('"', '""') + '"' if any(c in x for c in '",\n\r') or x == "" else x

    lines = ["id,judul,isi"] + [",".join(field(x) for x in row) for row in rows]
    path.write_bytes((newline.join(lines) + newline).encode())


@pytest.mark.parametrize("split", ["200b", "4k", "1m"])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_equals_the_whole_file_reader(spark, tmp_path, split, newline):
    folder = tmp_path / "in"
    folder.mkdir()
    for f in range(3):
        a, b = texts(f, 300), texts(f + 10, 300)
        write(folder / f"{f}.csv", [(str(i), x, y if i % 7 else None) for i, (x, y) in enumerate(zip(a, b))], newline)
    schema = spark.createDataFrame([], SCHEMA).schema
    settings = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(s) for s in settings]
    try:
        for s in settings:
            spark.conf.set(s, split)
        found = read_csv_split(spark, str(folder), schema, "seq")
        tasks = records(spark, str(folder)).rdd.getNumPartitions()
        got = sorted((tuple(r[:3]) for r in found.collect()), key=repr)
        ordered = [r.id for r in found.orderBy("seq").collect()]
    finally:
        for s, v in zip(settings, old):
            spark.conf.set(s, v)
    wanted = sorted(map(tuple, readers.read_csv(spark, str(folder), schema).collect()), key=repr)
    assert got == wanted
    assert ordered == [str(i) for i in range(300)] * 3
    if split == "200b":
        assert tasks > 100


def test_one_record_over_many_splits(spark, tmp_path):
    path = tmp_path / "a.csv"
    body = "\n".join(f"line {i}" for i in range(5000))
    write(path, [("1", "t", body), ("2", "u", "short"), ("3", "", "\n" * 50)])
    schema = spark.createDataFrame([], SCHEMA).schema
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        got = {r.id: r.isi for r in read_csv_split(spark, str(path), schema).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {"1": body, "2": "short", "3": "\n" * 50}


def test_blank_lines_and_empty_files(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,judul,isi\n\n1,a,b\n\n\n2,,"x\n\ny"\n')
    schema = spark.createDataFrame([], SCHEMA).schema
    wanted = sorted(map(tuple, readers.read_csv(spark, str(path), schema).collect()))
    assert sorted(map(tuple, read_csv_split(spark, str(path), schema).collect())) == wanted == [("1", "a", "b"), ("2", None, "x\n\ny")]
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text("id,judul,isi")
    assert read_csv_split(spark, str(tmp_path / "b.csv"), schema).count() == 0
    assert read_csv_split(spark, str(tmp_path / "c.csv"), schema).count() == 0


def test_what_the_writer_writes(spark, tmp_path):
    rows = [(str(i), x, y) for i, (x, y) in enumerate(zip(texts(1, 100), texts(2, 100)))]
    df = spark.createDataFrame(rows, SCHEMA)
    writers.write_csv(df.repartition(3), str(tmp_path / "out"))
    found = read_csv_split(spark, str(tmp_path / "out"), df.schema)
    wanted = readers.read_csv(spark, str(tmp_path / "out"), df.schema)
    assert found.exceptAll(wanted).count() == wanted.exceptAll(found).count() == 0
    assert found.where(F.col("isi").isNotNull()).count() > 50
