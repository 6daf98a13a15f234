"""Quality grades by ordinal cumulative-link regression on hashed text.

One weight vector serves all grades: P(grade <= k) = logistic(threshold_k - weights . features)
with rising thresholds. Features are words that occur in the text, each hashed to two slots, and
a few bucketed traits of its shape. The model gives the expected grade and the tail probability
of a good grade, by which documents are selected.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from suarakit.llm import arrays
from suarakit.llm.common import column, small_batches, text_key, written

SLOTS = 1 << 18
# Shares of words and text traits fall into these buckets.
_STEPS = np.array([0.005, 0.02, 0.06, 0.15, 0.3, 0.5, 0.75, 0.95])

_IS = {name: np.zeros(256, bool) for name in ("upper", "digit", "mark", "high")}
_IS["upper"][65:91] = True
_IS["digit"][48:58] = True
_IS["mark"][[33, *range(35, 39), 42, 43, 47, 60, 61, 62, 64, *range(91, 97), *range(123, 127)]] = True
_IS["high"][128:] = True


def features(piece: arrays.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots and values of the features of all rows, and where each row's features begin (one more than rows).

    A text of any length is read whole. One without words has the length feature alone.
    """
    words = arrays.runs(piece, arrays.NOT_SPACE)
    rows = len(piece.starts)
    n_words = np.diff(words.first)
    # Letters and digits of each word, so that punctuation beside it makes no difference.
    inner = arrays.runs(piece, arrays.ALNUM)
    hashes = arrays.word_hashes(piece, inner)
    # Row and hash as one number, 20 and 44 bits: a piece has fewer rows than that.
    pairs = np.unique(inner.row.astype(np.uint64) << np.uint64(44) | hashes >> np.uint64(20))
    row, h = (pairs >> np.uint64(44)).astype(np.int64), pairs & np.uint64((1 << 44) - 1)
    distinct = np.bincount(row, minlength=rows)
    share = lambda part, whole: part / np.maximum(whole, 1)
    length = piece.ends - piece.starts
    traits = []
    for flags in _IS.values():
        total = np.zeros(len(piece.data) + 1, np.int64)
        np.cumsum(flags[piece.data], out=total[1:])
        traits.append(share(total[piece.ends] - total[piece.starts], length))
    traits.append(share(distinct, np.diff(inner.first)))
    traits.append(share(n_words, length))
    levels = [np.searchsorted(_STEPS, t) for t in traits]
    levels.append(np.minimum(np.log2(n_words + 1).astype(np.int64), 12))
    shape = np.stack([100_000 + 100 * i + level for i, level in enumerate(levels)], axis=1).astype(np.uint64)
    mask = np.uint64(SLOTS - 1)
    slots = np.concatenate([h & mask, (h >> np.uint64(22)) & mask, (arrays.mix(shape) & mask).ravel()]).astype(np.int32)
    # Each of the two slots of a word carries half of it; long texts are damped.
    damp = (0.5 / np.sqrt(np.sqrt(np.maximum(distinct, 1))))[row].astype(np.float32)
    values = np.concatenate([damp, damp, np.full(shape.size, 2, np.float32)])
    at = np.concatenate([row, row, np.repeat(np.arange(rows), shape.shape[1])])
    order = np.argsort(at, kind="stable")
    return slots[order], values[order], np.append(0, np.cumsum(np.bincount(at, minlength=rows)))


class Model(NamedTuple):
    weights: np.ndarray  # one for each slot
    thresholds: np.ndarray  # rising; one fewer than grades


_SUMS = "loss double, n double, slope binary, steps array<double>"


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def tail_probabilities(model: Model, latent: np.ndarray) -> np.ndarray:
    """P(grade > k) for every threshold k, one column each."""
    return _logistic(latent[:, None] - model.thresholds[None, :])


def _loss(
    latent: np.ndarray, grades: np.ndarray, thresholds: np.ndarray, weight: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted negative log-likelihood, its slope by latent value, and by threshold."""
    edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
    below, upto = _logistic(edges[grades] - latent), _logistic(edges[grades + 1] - latent)
    chance = np.maximum(upto - below, 1e-12)
    by_threshold = np.zeros(len(thresholds) + 2)
    np.add.at(by_threshold, grades + 1, -weight * upto * (1 - upto) / chance)
    np.add.at(by_threshold, grades, weight * below * (1 - below) / chance)
    return float(-(weight * np.log(chance)).sum()), weight * (1 - upto - below), by_threshold[1:-1]


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in arrays.pieces(batch.column(1)):
            slots, values, first = features(piece)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(piece.first, len(piece.starts)),
                    pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(slots)),
                    pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values)),
                ],
                names=["grade", "slots", "vals"],
            )


def _sums(weights, thresholds: np.ndarray, emphasis: np.ndarray):
    """One row for each task: loss, total weight of the rows, and the gradient over its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, total, slope, steps = 0.0, 0.0, np.zeros(SLOTS), np.zeros(len(thresholds))
        for batch in batches:
            for at_row in range(0, batch.num_rows, 256):  # a few megabytes of features at a time
                part = batch.slice(at_row, 256)
                slots, values = part.column(1), part.column(2)
                first = slots.offsets.to_numpy().astype(np.int64)
                at, x = slots.flatten().to_numpy(), values.flatten().to_numpy()
                first = first - first[0]
                grades = part.column(0).to_numpy().astype(np.int64)
                latent = arrays.sums_exact(weights.value[at] * x.astype(np.float64), first)
                weight = emphasis[grades]
                some, by_latent, by_threshold = _loss(latent, grades, thresholds, weight)
                loss, total, steps = loss + some, total + float(weight.sum()), steps + by_threshold
                slope += np.bincount(at, np.repeat(by_latent, np.diff(first)) * x, SLOTS)
        yield pa.RecordBatch.from_pydict(
            {"loss": [loss], "n": [total], "slope": [slope.astype(np.float32).tobytes()], "steps": [steps.tolist()]}
        )

    return run


def fit(
    rated: DataFrame,
    emphasis: tuple[float, ...] = (3, 2, 1),
    ridge: float = 5e-5,
    iterations: int = 40,
    parts: int = 6,
    memory: int = 8,
) -> Model:
    """Fit on ``rated`` (``grade``: int from 0, ``text``) by L-BFGS; ``emphasis`` weights each grade's rows.

    Features are computed once; every step is one job that sums loss and gradient over tasks.
    The driver holds the model and one gradient for each of ``parts`` tasks, sizes that do not
    depend on the data. No rows give a model that grades everything alike.
    """
    spark, grades = small_batches(rated.sparkSession), len(emphasis)
    table = rated.select("grade", "text").mapInArrow(_feature_batches, "grade int, slots array<int>, vals array<float>")
    table = written(table.repartition(parts), "features").coalesce(parts)

    def evaluate(x: np.ndarray) -> tuple[float, np.ndarray]:
        weights = spark.sparkContext.broadcast(x[:SLOTS].astype(np.float32))
        gaps = np.exp(x[SLOTS + 1 :])
        thresholds = x[SLOTS] + np.append(0, np.cumsum(gaps))
        rows = table.mapInArrow(_sums(weights, thresholds, np.array(emphasis, float)), _SUMS).collect()
        weights.destroy()
        n = max(1.0, sum(r["n"] for r in rows))
        slope = np.zeros(SLOTS)
        for r in rows:
            slope += np.frombuffer(r["slope"], np.float32)
        slope /= n
        steps = sum(np.array(r["steps"]) for r in rows) / n
        # Thresholds are the first one and the logarithms of the gaps, which keeps them in order.
        by_gap = np.cumsum(steps[::-1])[::-1][1:] * gaps
        full = np.concatenate([slope + ridge * x[:SLOTS], [steps.sum()], by_gap])
        return sum(r["loss"] for r in rows) / n + ridge / 2 * float(x[:SLOTS] @ x[:SLOTS]), full

    x = np.zeros(SLOTS + grades - 1)
    x[SLOTS] = -1.0
    if table.isEmpty():
        return Model(x[:SLOTS].astype(np.float32), x[SLOTS] + np.append(0, np.cumsum(np.exp(x[SLOTS + 1 :]))))
    value, slope = evaluate(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(iterations):
        direction, scales = -slope, []
        for s, y in reversed(moves):
            a = (s @ direction) / (s @ y)
            direction = direction - a * y
            scales.append(a)
        if moves:
            s, y = moves[-1]
            direction = direction * ((s @ y) / (y @ y))
        for (s, y), a in zip(moves, reversed(scales)):
            direction = direction + s * (a - (y @ direction) / (s @ y))
        size = 1.0 if moves else 1.0 / max(1.0, float(np.abs(slope).max()))
        for _ in range(12):
            moved, new_slope = evaluate(x + size * direction)
            if moved <= value + 1e-4 * size * float(slope @ direction):
                break
            size /= 3
        else:
            break
        step, change = size * direction, new_slope - slope
        if step @ change > 1e-12:
            # Half the memory: the history only shapes the direction.
            moves = [*moves, (step.astype(np.float32), change.astype(np.float32))][-memory:]
        x, gained, value, slope = x + step, value - moved, moved, new_slope
        if gained < 3e-4 * max(value, 1e-3):
            break
    return Model(x[:SLOTS].astype(np.float32), x[SLOTS] + np.append(0, np.cumsum(np.exp(x[SLOTS + 1 :]))))


def grade_of(quality: Column, toxic: Column) -> Column:
    """Grade of a rating: 0 toxic, 1 poor, 2 good; null where neither rating decides."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2)


def rated_sample(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", most: int = 20_000
) -> DataFrame:
    """At most ``most`` rated documents (the ratings of smallest hashed id): ``grade``, ``text``.

    Ratings without an id or a grade are left out; of several ratings of one id the worst counts.
    The sample of ids is bounded by ``most``, so it may be broadcast.
    """
    rated = labels.select(column(labels, id_column).alias("rated_id"), grade_of(labels["quality"], labels["toxic"]).alias("grade"))
    rated = rated.where("rated_id is not null and grade is not null").groupBy("rated_id").agg(F.min("grade").alias("grade"))
    rated = rated.orderBy(F.xxhash64("rated_id"), "rated_id").limit(most)
    text = column(docs, text_column).cast("string").alias("text")
    return docs.select(column(docs, id_column).alias("id"), text).join(F.broadcast(rated), F.col("id") == F.col("rated_id")).select("grade", "text")


def grade(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", keep_tail: float = 0.5) -> DataFrame:
    """id, key, latent, expected_grade, tail_probability, kept for every row of ``docs``.

    ``tail_probability`` is the chance of the best grade; a document is kept from ``keep_tail``
    on. Null and empty texts are graded by their lack of words; equal texts are graded alike.
    """
    spark = small_batches(docs.sparkSession)
    shared = spark.sparkContext.broadcast((model.weights, model.thresholds))
    text = column(docs, text_column).cast("string")
    keyed = docs.select(column(docs, id_column).alias("id"), text_key(text).alias("key"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            latent = np.zeros(batch.num_rows)
            for piece in arrays.pieces(batch.column(2)):
                slots, values, first = features(piece)
                latent[piece.first : piece.first + len(piece.starts)] = arrays.sums_exact(
                    model.weights[slots].astype(np.float64) * values, first
                )
            tails = tail_probabilities(model, latent)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(latent),
                    pa.array(tails.sum(axis=1)),
                    pa.array(tails[:, -1]),
                    pa.array(tails[:, -1] >= keep_tail),
                ],
                names=["id", "key", "latent", "expected_grade", "tail_probability", "kept"],
            )

    made = StructType.fromDDL("latent double, expected_grade double, tail_probability double, kept boolean")
    return keyed.mapInArrow(run, StructType([*keyed.schema.fields[:2], *made.fields]))
