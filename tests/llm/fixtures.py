"""Awkward little tables: nulls, empty and long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

# Names that operators use inside, and documents' own columns.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "id string, key string, key__ string, spans__ int, bucket int, size int, n int, h int, at int, words string, kept string"
)
WORDS = "the and of tion er in on that is with Ouwh élan über ñandú naïve 日本 x9 42 don't re-do".split()


def sentence(rng: random.Random, n: int) -> str:
    out = [rng.choice(WORDS) + rng.choice(["", "", "a", "er", "ing"]) for _ in range(n)]
    return " ".join(w + (rng.choice([".", ",", ";\n", "\n"]) if rng.random() < 0.15 else "") for w in out)


def texts(seed: int = 7, n: int = 60) -> list[str | None]:
    rng = random.Random(seed)
    out: list[str | None] = [sentence(rng, rng.randrange(1, 120)) for _ in range(n)]
    out += [out[0], out[0], out[1] + " Tail", None, "", "   \n\t ", "...!!", "one", "x " * 400, sentence(rng, 6000), None, ""]
    passage = sentence(rng, 70)
    for i in range(3, 9):
        out[i] = f"{out[i]}.\n{passage}.\n{sentence(rng, 20)}"
    return out


def rows(given: list[str | None]) -> list[tuple]:
    made = []
    for i, text in enumerate(given):
        lang, source = [None, "en", "de"][i % 3], ["b", "a", None, "ä"][i % 4]
        made.append((i * 3, text, lang, source, None if text is None else len(text), "x", "y", "z", 1, 2, 3, 4, 5, 6, "w", "k"))
    made.append((None, given[2], None, None, 1, *made[0][5:]))
    made.append((None, None, "en", "a", None, *made[0][5:]))
    made.append(made[4])  # a repeated row
    made.append((made[4][0], "another text under the same id", *made[4][2:]))
    return made


def documents(spark: SparkSession, given: list[str | None] | None = None) -> DataFrame:
    return spark.createDataFrame(rows(texts() if given is None else given), SCHEMA).repartition(5)


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def lower(text: str | None) -> str:
    """A-Z as a-z, nothing else."""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
