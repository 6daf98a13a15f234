"""Periodic runs of words: stretches that repeat a short period at least four times over.

Seed and extend on diagonals. A run of smallest period q (LEAST_PERIODS * q words or more) matches
itself at lag q over at least three periods, so for q from 2**j to 2**(j+1) - 1 every k-gram of
k = 2**(j+1) words (more than q, fewer than the overlap) that starts in its first period occurs
again exactly q words later, and nowhere between: a nearer occurrence would, by the theorem of
Fine and Wilf, give the run a smaller period. So neighbouring occurrences of equal k-grams within
a document are all the pairs that need a look, and there are fewer of them than words at each of
log2(n) scales, however often a word repeats. k-grams are named exactly, without hashes: a name at
one scale is a pair of names at the scale below, and only repeated ones are carried upwards. A seed
is extended along its diagonal word by word, unless a table of the furthest place covered at each
lag shows that an earlier seed has been there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from suarakit.functions.binding import let
from suarakit.llm import arrays
from suarakit.llm.common import column, small_batches

LEAST_PERIODS = 4
LEAST_WORDS = 6

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _names(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts ``keys`` (stable), whether each sorted key equals the one before, and names in that order."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.append(False, ranked[1:] == ranked[:-1]) if len(keys) else np.zeros(0, bool)
    return order, same, np.cumsum(~same) - 1


def seeds(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places i, lags q and lengths k with equal k-grams at i and i + q of a row, q from k / 2 to k - 1.

    ``codes`` are the words of all rows, row r those from first[r] to first[r + 1].
    """
    n = len(codes)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    stop = np.repeat(first[1:], np.diff(first))
    places, lags, sizes = [], [], []
    # Names of the repeated 1-grams of each row; -1 elsewhere.
    order, same, name = _names(row * (int(codes.max()) + 1 if n else 1) + codes)
    k = 1
    at = np.arange(n)
    while True:
        repeated = same.copy()
        repeated[:-1] |= same[1:]
        found = at[order]
        if k > 1:
            lag = found[1:] - found[:-1]
            pick = np.flatnonzero(same[1:] & (lag >= k // 2) & (lag < k))
            places.append(found[pick])
            lags.append(lag[pick])
            sizes.append(np.full(len(pick), k))
        named = np.full(n, -1, np.int64)
        named[found[repeated]] = name[repeated]
        # k-grams twice as long: both halves repeat, and the row is long enough for their runs.
        at = np.flatnonzero(named >= 0)
        at = at[at + 2 * k <= stop[at]]
        at = at[named[at + k] >= 0]
        if not len(at):
            break
        order, same, name = _names(named[at] * (int(name[-1]) + 1) + named[at + k])
        k *= 2
    if not places:
        none = np.zeros(0, np.int64)
        return none, none, none
    return np.concatenate(places), np.concatenate(lags), np.concatenate(sizes)


def _reach(codes: np.ndarray, low: int, lag: int, stop: int) -> int:
    """First place from ``low`` on, below ``stop``, whose word differs from the one ``lag`` later."""
    step = 32
    while low < stop:
        high = min(stop, low + step)
        differ = np.flatnonzero(codes[low:high] != codes[low + lag : high + lag])
        if len(differ):
            return low + int(differ[0])
        low, step = high, step * 2
    return stop


def _reach_back(codes: np.ndarray, high: int, lag: int, stop: int) -> int:
    """Smallest place from ``stop`` on from which all words up to ``high`` equal those ``lag`` later."""
    step = 32
    while high > stop:
        low = max(stop, high - step)
        differ = np.flatnonzero(codes[low:high] != codes[low + lag : high + lag])
        if len(differ):
            return low + int(differ[-1]) + 1
        high, step = low, step * 2
    return stop


def find(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Runs of all rows as columns (row, start within the row, length, period), by row, start and period."""
    places, lags, sizes = seeds(codes, first)
    order = np.lexsort((places, lags))
    places, lags, sizes = places[order], lags[order], sizes[order]
    # Of seeds that follow each other on a diagonal the first one speaks for all.
    heads = np.ones(len(places), bool)
    heads[1:] = (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1)
    row = np.searchsorted(first, places, "right") - 1
    covered: dict[int, int] = {}
    out = []
    for i, q, k, r in zip(places[heads].tolist(), lags[heads].tolist(), sizes[heads].tolist(), row[heads].tolist()):
        if i < covered.get(q, -1):
            continue
        low, high = int(first[r]), int(first[r + 1])
        start = _reach_back(codes, i, q, low)
        end = _reach(codes, i + k, q, high - q) + q
        covered[q] = end - q
        if end - start >= max(LEAST_WORDS, LEAST_PERIODS * q):
            out.append((r, start - low, end - start, q))
    found = np.array(sorted(out, key=lambda x: (x[0], x[1], x[3])), np.int64)
    return found.reshape(-1, 4)


def _exact_codes(piece: arrays.Piece, words: arrays.Runs) -> np.ndarray:
    """A number for each word, the same for equal words only."""
    offsets = np.append(0, np.cumsum(words.ends - words.starts))
    inside = arrays.NOT_SPACE[piece.data]
    flat = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(words.starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(piece.data[inside]))]
    )
    return flat.dictionary_encode().indices.to_numpy().astype(np.int64)


def _joined(piece: arrays.Piece, words: arrays.Runs, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of all rows, each followed by a blank, and where each row begins and ends."""
    starts, sizes = words.starts[kept], (words.ends - words.starts)[kept] + 1
    ends = np.cumsum(sizes)
    take = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
    take[ends - 1] = 0
    out = piece.data[take] if len(take) else np.zeros(0, np.uint8)
    out[ends - 1] = 32
    bounds = np.append(0, ends)[np.searchsorted(np.flatnonzero(kept), words.first)]
    return out, bounds


def _run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in arrays.pieces(batch.column(1)):
            rows = len(piece.starts)
            words = arrays.runs(piece, arrays.NOT_SPACE)
            found = find(_exact_codes(piece, words), words.first)
            marks = np.zeros(len(words.starts) + 1, np.int64)
            base = words.first[found[:, 0]] + found[:, 1]
            np.add.at(marks, base + found[:, 3], 1)
            np.add.at(marks, base + found[:, 2], -1)
            text, bounds = _joined(piece, words, np.cumsum(marks)[:-1] == 0)
            raw = text.tobytes()
            collapsed = [raw[a : max(a, b - 1)].decode() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            items = pa.StructArray.from_arrays([pa.array(found[:, j]) for j in (1, 2, 3)], fields=list(_RUN))
            spans = np.searchsorted(found[:, 0], np.arange(rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(piece.first, rows),
                    pa.array(np.diff(words.first).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(spans), items),
                    pa.array(collapsed, pa.string()),
                ],
                names=["id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_words, runs, collapsed for every row of ``docs``; whole texts, and no row depends on another.

    Words are what stands between white space, numbered from 0; case and punctuation count.
    ``runs`` has every maximal run (start, length, period) of at least 6 words and four periods, by
    start and period. ``collapsed`` keeps the first period of each run: words that any run holds
    after its first period go, the others are joined by one blank. A null or empty text, or one
    without words, has no runs and an empty collapsed text; null ids and repeated rows stay as
    they are; no rows give no rows. A task holds one text at a time beyond a megabyte, and
    arrays of its words.
    """
    small_batches(docs.sparkSession)
    given = docs.select(column(docs, id_column).alias("id"), column(docs, text_column).cast("string").alias("text"))
    made = StructType.fromDDL("n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return given.mapInArrow(_run_batches, StructType([given.schema.fields[0], *made.fields]))


def longest(runs: Column) -> Column:
    """The run of greatest length; ties go to the smallest start, then period. Null if there is none."""

    def better(best: Column, run: Column) -> Column:
        # Runs come by start and period, so an equally long later one never wins.
        return F.when(best.isNull() | (run["length"] > best["length"]), run).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, better)


def listed(runs: Column) -> Column:
    """``start,length,period`` and a line feed for each run, in order."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def with_tail_repeated(text: Column, number: Column) -> Column:
    """Words of ``text`` joined by a blank, where every tenth ``number`` makes their tail periodic.

    With g = number div 10 and n words, each word i >= a is word a + (i - a) mod p for a = g mod n
    and p = 1 + (n - a) div (3 + g mod 8). Other texts, and those with a null number, stay.
    """

    def repeated(words: Column) -> Column:
        n, g = F.size(words).cast("bigint"), F.floor(number / 10)
        a = F.pmod(g, n)
        p = F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8)))) + 1
        tail = let(
            F.struct(a.alias("a"), p.alias("p")),
            lambda s: F.transform(
                words, lambda w, i: F.when(i < s["a"], w).otherwise(F.get(words, (s["a"] + F.pmod(i - s["a"], s["p"])).cast("int")))
            ),
        )
        return F.when(n > 0, F.array_join(tail, " ")).otherwise(F.lit(""))

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.when(F.pmod(number, F.lit(10)) == 0, let(words, repeated)).otherwise(text)
