"""Language identification by mixture inference.

Every word of a text is drawn from one language of a mixture; a language gives a word the
product of its smoothed n-gram probabilities. Expectation-maximisation finds each document's
language proportions, and the set of languages is the one of best penalised likelihood.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from suarakit.llm import arrays
from suarakit.llm.common import column, small_batches, text_key

BUCKETS = 1 << 16
_LETTER = arrays.ALNUM.copy()
_LETTER[48:58] = False


class Model(NamedTuple):
    languages: list[str]
    log_likelihood: np.ndarray  # for each n-gram bucket, one column for each language


def grams(piece: arrays.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the three bytes around each byte of a word, where words begin, and rows' words.

    Word ends count as blanks. Digits and punctuation belong to no word.
    """
    words = arrays.runs(piece, _LETTER)
    if not len(words.starts):
        return np.zeros(0, np.int64), np.zeros(1, np.int64), words.first
    inside = _LETTER[piece.data]
    codes = np.where(inside, arrays.LOWER[piece.data], 32).astype(np.uint32)
    before, after = np.roll(codes, 1), np.roll(codes, -1)
    before[words.starts], after[words.ends - 1] = 32, 32
    mixed = (before | codes << np.uint32(8) | after << np.uint32(16)) * np.uint32(0x9E3779B1)
    first = np.append(0, np.cumsum(words.ends - words.starts))
    return (mixed >> np.uint32(16))[inside].astype(np.int64), first, words.first


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts of each language in a task, handed on before too many languages gather."""
    held: dict[str, np.ndarray] = {}

    def rows(language: str, counts: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([language] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["lang", "bucket", "n"]
        )

    for batch in batches:
        languages = batch.column(0).dictionary_encode()
        names, codes = languages.dictionary.to_pylist(), languages.indices.to_numpy()
        for piece in arrays.pieces(batch.column(1)):
            buckets, first, words = grams(piece)
            spans = first[words]
            of = np.repeat(codes[piece.first : piece.first + len(piece.starts)], np.diff(spans))
            for code in np.unique(of).tolist():
                counts = held.setdefault(names[code], np.zeros(BUCKETS, np.int64))
                counts += np.bincount(buckets[of == code], minlength=BUCKETS)
        while len(held) > 64:
            language = next(iter(held))
            yield rows(language, held.pop(language))
    for language, counts in held.items():
        yield rows(language, counts)


def learn(rows: DataFrame, smoothing: float = 0.5) -> Model:
    """Model from ``lang`` and ``text``; rows that lack either are left out.

    Counts cover all rows. The driver gets at most 65,536 counts for each language.
    """
    small_batches(rows.sparkSession)
    known = rows.where("lang is not null and text is not null").select(F.col("lang").cast("string"), F.col("text").cast("string"))
    counts = known.mapInArrow(_count_batches, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toArrow()
    names = table["lang"].combine_chunks().dictionary_encode()
    languages = sorted(names.dictionary.to_pylist())
    dense = np.full((BUCKETS, len(languages)), smoothing)
    place = np.array([languages.index(name) for name in names.dictionary.to_pylist()], np.int64)
    if len(table):
        dense[table["bucket"].to_numpy(), place[names.indices.to_numpy()]] += table["n"].to_numpy()
    return Model(languages, np.log(dense / dense.sum(axis=0, keepdims=True)).astype(np.float32))


def _by_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros((len(first) - 1, *values.shape[1:]))
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.add.reduceat(values, first[full], axis=0)
    return out


def _mixture(likelihood: np.ndarray, first: np.ndarray, start: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """EM for all rows at once: proportions, and log-likelihood less that of the scaling."""
    n = np.diff(first)
    proportions = start
    for step in range(steps + 1):
        weighted = likelihood * np.repeat(proportions, n, axis=0).astype(np.float32)
        total = np.maximum(weighted.sum(axis=1, keepdims=True), 1e-30)
        if step < steps:
            proportions = _by_row(weighted / total, first) / np.maximum(n, 1)[:, None]
    return proportions, _by_row(np.log(total[:, 0]), first)


def infer(piece: arrays.Piece, model: Model, steps: int = 8, price: float = 2.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Proportions over the chosen language set, best language and its share before the choice.

    Languages enter by falling share; a set of j costs ``price * (j - 1) * log(words)``.
    Of equal shares the first language in code point order wins. Rows without words have share 0.
    """
    buckets, first, words = grams(piece)
    rows, kinds = len(piece.starts), len(model.languages)
    if not len(buckets) or not kinds:
        return np.zeros((rows, kinds)), np.zeros(rows, np.int64), np.zeros(rows)
    log_likelihood = np.add.reduceat(model.log_likelihood[buckets], first[:-1], axis=0)
    top = log_likelihood.max(axis=1, keepdims=True)
    likelihood = np.exp(log_likelihood - top)
    n = np.diff(words)
    shares, _ = _mixture(likelihood, words, np.full((rows, kinds), 1.0 / kinds), steps)
    order = np.argsort(-shares, axis=1, kind="stable")
    best, chosen = np.full(rows, -np.inf), np.zeros((rows, kinds))
    for size in range(1, kinds + 1):
        member = np.zeros((rows, kinds))
        np.put_along_axis(member, order[:, :size], 1.0, axis=1)
        start = member * np.maximum(shares, 1e-3)
        proportions, fit = _mixture(likelihood, words, start / start.sum(axis=1, keepdims=True), steps // 2 if size > 1 else 0)
        value = fit - price * (size - 1) * np.log(np.maximum(n, 2))
        better = value > best + 1e-9
        best[better], chosen[better] = value[better], proportions[better]
    pick = np.argmax(chosen, axis=1)
    share = np.take_along_axis(shares, pick[:, None], axis=1)[:, 0]
    empty = n == 0
    chosen[empty], share[empty] = 0.0, 0.0
    return chosen, pick, np.clip(share, 0.0, 1.0)


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, key, lang_pred, score, mixture (language to proportion) for every row of ``docs``.

    Only the text decides. ``lang_pred`` is the largest part of the chosen set and ``score`` its
    share in the mixture of all languages; a text that is null, empty or has no letters is
    ``und`` with score 0, as is any text if nothing was learnt. Equal texts get equal results.
    """
    spark = small_batches(docs.sparkSession)
    shared = spark.sparkContext.broadcast(tuple(model))
    text = column(docs, text_column).cast("string")
    letters = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    keyed = docs.select(column(docs, id_column).alias("id"), text_key(text).alias("key"), letters.alias("letters"), text.alias("text"))
    # The tables have a column for each language; smaller pieces keep them bounded.
    size = max(1 << 14, 4 * arrays.PIECE // max(4, len(model.languages)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            letters = batch.column(2).to_numpy(zero_copy_only=False)
            predicted, scores, mixtures = [], [], []
            for piece in arrays.pieces(batch.column(3), size):
                chosen, pick, share = infer(piece, model)
                for i in range(len(piece.starts)):
                    if letters[piece.first + i] and share[i] > 0:
                        predicted.append(model.languages[pick[i]])
                        scores.append(float(share[i]))
                        parts = np.flatnonzero(chosen[i] > 0)
                        mixtures.append([(model.languages[j], float(chosen[i, j])) for j in parts])
                    else:
                        predicted.append("und")
                        scores.append(0.0)
                        mixtures.append([])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(predicted, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(mixtures, pa.map_(pa.string(), pa.float64())),
                ],
                names=["id", "key", "lang_pred", "score", "mixture"],
            )

    made = StructType.fromDDL("lang_pred string, score double, mixture map<string,double>")
    return keyed.mapInArrow(run, StructType([*keyed.schema.fields[:2], *made.fields]))
