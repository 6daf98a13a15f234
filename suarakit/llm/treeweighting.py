"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions. For every decision a tree of contexts, the last 0 to ``depth``
bytes, mixes Krichevsky-Trofimov estimates of all depths: the weighted probability of a context
is half its own estimate plus half the product of those of its longer contexts. Trees are grown
from counts over all training texts and keep every context: a tree is folded upwards in tasks that
each hold whole subtrees of contexts with three last bytes in common, the few shorter contexts are
folded on the driver, and the weights are carried down again. With the counts fixed, each context
has one probability for each next byte, and a text's score is a sum. Frequent contexts and windows
are looked up in arrays of a fixed greatest size, all others by a join.

Words seen and not seen in training are counted beside it for a unigram base score.
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

BEFORE, END = 0xFF, 0xFE  # bytes that UTF-8 never has: before the text, and its end
WORD, GRAM = 0, 1


def _windows(piece: arrays.Piece, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of every row and its end: the byte and the ``depth`` bytes before it as one code."""
    rows, room = len(piece.starts), depth + 1
    lengths = piece.ends - piece.starts
    # Each row as depth BEFORE bytes, its own bytes, and END.
    first = np.cumsum(lengths + room) - (lengths + room)
    line = np.full(int((lengths + room).sum()), BEFORE, np.uint8)
    own = np.ones(len(line), bool)
    own[(first[:, None] + np.arange(depth)[None, :]).ravel()] = False
    own[first + depth + lengths] = False
    line[own] = arrays.LOWER[piece.data]
    line[first + depth + lengths] = END
    codes = np.zeros(len(line) - depth, np.uint64)
    for j in range(room):
        codes = codes << np.uint64(8) | line[j : len(line) - depth + j].astype(np.uint64)
    own[first + depth + lengths] = True
    return codes[own[depth:]], np.append(0, np.cumsum(lengths + 1)) if rows else np.zeros(1, np.int64)


def _words(piece: arrays.Piece) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of every row, an end last; where rows begin."""
    words = arrays.runs(piece, arrays.NOT_SPACE)
    first = words.first + np.arange(len(words.first))
    out = np.zeros(first[-1], np.uint64)
    at = np.arange(len(words.starts)) + words.row
    out[at] = arrays.word_hashes(piece, words)
    out[first[1:] - 1] = np.uint64(1)  # the end
    return out, first


def _count_batches(depth: int, most: int = 1 << 21):
    """Word and context counts of a task, handed on whenever more than ``most`` have gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {WORD: [], GRAM: []}

        def fold(kind: int) -> tuple[np.ndarray, np.ndarray]:
            codes = np.concatenate([c for c, _ in held[kind]])
            counts = np.concatenate([n for _, n in held[kind]])
            order = np.argsort(codes, kind="stable")
            codes, counts = codes[order], counts[order]
            first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            return codes[first], np.add.reduceat(counts, first)

        def rows(kind: int) -> Iterator[pa.RecordBatch]:
            codes, counts = fold(kind)
            for at in range(0, len(codes), 1 << 18):
                part, n = codes[at : at + (1 << 18)], counts[at : at + (1 << 18)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), kind, np.int32)), pa.array(part.view(np.int64)), pa.array(n)], names=["kind", "code", "n"]
                )
            held[kind] = []

        for batch in batches:
            for piece in arrays.pieces(batch.column(0), 4 * arrays.PIECE):
                for kind, codes in ((WORD, _words(piece)[0]), (GRAM, _windows(piece, depth)[0])):
                    held[kind].append(np.unique(codes, return_counts=True))
                    if sum(len(c) for c, _ in held[kind]) > most:
                        held[kind] = [fold(kind)]
                        if len(held[kind][0][0]) > most // 2:
                            yield from rows(kind)
        for kind in held:
            if held[kind]:
                yield from rows(kind)

    return run


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x >= 0.5."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift[low] += np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def kt_log_probability(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov probability (natural log) of any sequence with these counts."""
    out = np.zeros(zeros.shape)
    seen = (zeros > 0) | (ones > 0)  # few nodes: the others have probability one
    a, b = zeros[seen].astype(np.float64), ones[seen].astype(np.float64)
    out[seen] = _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1) - np.log(np.pi)
    return out


class Level(NamedTuple):
    """The nodes (context << 8 | node) of all contexts of one length, sorted.

    ``mixed`` is what contexts up to this one contribute to the probability of a one, ``left``
    the weight that longer contexts share.
    """

    keys: np.ndarray
    mixed: np.ndarray
    left: np.ndarray


def _path(byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eight nodes and decisions (columns) that lead to each byte."""
    byte, step = byte.astype(np.uint64)[:, None], np.arange(8, dtype=np.uint64)[None, :]
    return byte >> (np.uint64(8) - step) | np.uint64(1) << step, byte >> (np.uint64(7) - step) & np.uint64(1)


def _mask(depth: int) -> np.uint64:
    return np.uint64((1 << 8 * (depth + 1)) - 1)


class _Nodes(NamedTuple):
    keys: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray
    share: np.ndarray  # weight of a context's own estimate
    parents: np.ndarray | None  # places in the nodes one byte shorter, where these are held


def _leaves(codes: np.ndarray, counts: np.ndarray) -> _Nodes:
    nodes, bits = _path(codes & np.uint64(255))
    keys, back = np.unique((codes >> np.uint64(8) << np.uint64(8))[:, None] | nodes, return_inverse=True)
    back, n = back.ravel(), np.repeat(counts.astype(np.float64), 8)
    bits = bits.ravel().astype(np.float64)
    zeros, ones = np.bincount(back, n * (1 - bits), len(keys)), np.bincount(back, n * bits, len(keys))
    return _Nodes(keys, zeros, ones, kt_log_probability(zeros, ones), np.ones(len(keys)), None)


def _inner(keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray) -> _Nodes:
    """Nodes of contexts that have longer ones, whose weights multiply to ``children``."""
    own, half = kt_log_probability(zeros, ones), np.log(0.5)
    weighted = np.logaddexp(half + own, half + children)
    return _Nodes(keys, zeros, ones, weighted, np.exp(np.minimum(0.0, half + own - weighted)), None)


def _climb(nodes: _Nodes, depth: int, stop: int) -> list[_Nodes]:
    """The nodes of lengths ``stop`` to ``depth``, from those of ``depth``."""
    out = [nodes]
    for d in range(depth - 1, stop - 1, -1):
        nodes = out[0]
        keys, back = np.unique(nodes.keys & _mask(d), return_inverse=True)
        out[0] = nodes._replace(parents=back)
        sums = [np.bincount(back, x, len(keys)) for x in (nodes.zeros, nodes.ones, nodes.weighted)]
        out.insert(0, _inner(keys, *sums))
    return out


def _descend(climbed: list[_Nodes], mixed: np.ndarray, left: np.ndarray) -> list[Level]:
    """Carry weights down; ``mixed`` and ``left`` are those above the first nodes."""
    out = []
    for nodes in climbed:
        if out:
            mixed, left = out[-1].mixed[nodes.parents], out[-1].left[nodes.parents]
        one = (nodes.ones + 0.5) / (nodes.zeros + nodes.ones + 1)
        out.append(Level(nodes.keys, mixed + left * nodes.share * one, left * (1 - nodes.share)))
    return out


def _above(levels: list[Level], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``mixed`` and ``left`` of the longest context of each node that was seen in training."""
    mixed, left = np.zeros(keys.shape), np.ones(keys.shape)
    for d, level in enumerate(levels):
        if not len(level.keys):
            continue
        wanted = keys & _mask(d)
        at = np.minimum(np.searchsorted(level.keys, wanted), len(level.keys) - 1)
        found = level.keys[at] == wanted
        mixed[found], left[found] = level.mixed[at[found]], level.left[at[found]]
    return mixed, left


def _one(levels: list[Level], keys: np.ndarray) -> np.ndarray:
    """Probability of a one at each node; contexts never seen say one half."""
    mixed, left = _above(levels, keys)
    return np.clip(mixed + left * 0.5, 1e-12, 1 - 1e-12)


def _last_byte(levels: list[Level], codes: np.ndarray) -> np.ndarray:
    """log10 probability of the last byte of each code after the others, rounded as where it is looked up."""
    nodes, bits = _path(codes & np.uint64(255))
    one = _one(levels, (codes >> np.uint64(8) << np.uint64(8))[:, None] | nodes)
    return np.log10(np.where(bits > 0, one, 1 - one)).sum(axis=1).astype(np.float32).astype(np.float64)


def _all_bytes(levels: list[Level], contexts: np.ndarray) -> np.ndarray:
    """log10 probability of each of the 256 bytes after every context."""
    one = _one(levels, (contexts << np.uint64(8))[:, None] | np.arange(256, dtype=np.uint64)[None, :])
    out = np.zeros((len(contexts), 1))
    for bit in range(8):
        p = one[:, 1 << bit : 2 << bit]
        out = np.stack([out + np.log10(1 - p), out + np.log10(p)], axis=2).reshape(len(contexts), -1)
    return out


TOP = 2  # contexts of so many bytes and fewer are folded on the driver
UNIT = float(1 << 24)  # weights are summed as whole numbers of its inverse, in any order alike


def _dealt(codes: DataFrame, depth: int) -> DataFrame:
    """Codes by their last bytes of context, so that a task has whole subtrees."""
    low = (1 << 8 * min(depth, TOP + 1)) - 1
    dealt = codes.withColumn("subtree", F.shiftright("code", 8).bitwiseAND(F.lit(low)))
    return dealt.repartition("subtree").sortWithinPartitions("subtree").select("subtree", "code", "n")


def _subtrees(batches: Iterator[pa.RecordBatch], least: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes and counts of whole subtrees, at least so many rows of them at once."""
    held, size = [], 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        size += batch.num_rows
        if size < least:
            continue
        subtree, codes, counts = (np.concatenate(c) for c in zip(*held))
        upto = int(np.searchsorted(subtree, subtree[-1]))
        if upto:
            yield codes[:upto].view(np.uint64), counts[:upto]
        held, size = [[subtree[upto:], codes[upto:], counts[upto:]]], len(subtree) - upto
        least = max(1 << 15, 2 * size)
    if size:
        _, codes, counts = (np.concatenate(c) for c in zip(*held))
        yield codes.view(np.uint64), counts


def _top_batches(depth: int):
    """Sums over subtrees for the nodes of the longest contexts that the driver folds."""
    top = min(depth, TOP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, counts in _subtrees(batches):
            nodes = _climb(_leaves(codes, counts), depth, min(depth, TOP + 1))[0]
            keys, back = np.unique(nodes.keys & _mask(top), return_inverse=True)
            sums = np.zeros((3, len(keys)), np.int64)
            for i, x in enumerate((nodes.zeros, nodes.ones, nodes.weighted * UNIT)):
                np.add.at(sums[i], back, np.rint(x).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *map(pa.array, sums)], names=["key", "zeros", "ones", "weight"])

    return run


def _top(sums: pa.Table, depth: int) -> list[Level]:
    top = min(depth, TOP)
    keys = sums["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    zeros, ones, weight = (sums[c].to_numpy()[order].astype(np.float64) for c in ("zeros", "ones", "weight"))
    nodes = _inner(keys[order], zeros, ones, weight / UNIT)
    if top == depth:
        nodes = nodes._replace(weighted=kt_log_probability(zeros, ones), share=np.ones(len(keys)))
    climbed = _climb(nodes, top, 0)
    n = len(climbed[0].keys)
    return _descend(climbed, np.zeros(n), np.ones(n))


def _levels(top: list[Level], codes: np.ndarray, counts: np.ndarray, depth: int) -> list[Level]:
    """All levels that the contexts of these whole subtrees need."""
    seen = counts > 0
    if depth <= TOP or not seen.any():
        return top
    climbed = _climb(_leaves(codes[seen], counts[seen]), depth, TOP + 1)
    return [*top, *_descend(climbed, *_above(top, climbed[0].keys))]


def _learnt_batches(depth: int, shared):
    """The probability of every code, and of all next bytes after the contexts that are looked up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, kept = shared.value
        top = [Level(*x) for x in top]
        names = ["code", "n", "value", "after"]
        for codes, counts in _subtrees(batches):
            levels = _levels(top, codes, counts, depth)
            none = pa.nulls(len(codes), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(counts), pa.array(_last_byte(levels, codes)), none], names=names)
            own = np.intersect1d(codes >> np.uint64(8), kept)
            for at in range(0, len(own), 256):
                part = own[at : at + 256]
                after = pa.array([x.tobytes() for x in _all_bytes(levels, part).astype(np.float32)], pa.binary())
                zeros = np.zeros(len(part), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(part.view(np.int64)), pa.array(zeros), pa.array(zeros * 0.0), after], names=names)

    return run


def _asked_batches(depth: int, shared):
    """The probability of codes that are asked for: rows without a count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = [Level(*x) for x in shared.value]
        for codes, counts in _subtrees(batches):
            asked = codes[counts == 0]
            if len(asked):
                values = _last_byte(_levels(top, codes, counts, depth), asked)
                yield pa.RecordBatch.from_arrays([pa.array(asked.view(np.int64)), pa.array(values)], names=["code", "value"])

    return run


class Model(NamedTuple):
    depth: int
    contexts: np.ndarray  # sorted, the most frequent of full length
    table: np.ndarray  # log10 probability of the 256 next bytes after each
    codes: np.ndarray  # sorted, the most frequent contexts with their next byte
    values: np.ndarray  # log10 probability of that byte
    words: np.ndarray  # sorted hashes of the most frequent words
    word_counts: np.ndarray
    train_tokens: int
    distinct_tokens: int
    top: list[Level]
    grams: DataFrame  # every context of full length with its next byte (``code``) and count (``n``)


def learn(
    rows: DataFrame, depth: int = 5, most_contexts: int = 1 << 15, most_words: int = 1 << 20, most_codes: int = 1 << 19
) -> tuple[Model, DataFrame]:
    """Model from all of ``rows`` (``text``), and the counts of all its words (``code``, ``n``).

    Counts of contexts and words are gathered from every text, combined within tasks and summed
    by key. All contexts are weighed. The driver gets sums for contexts of two bytes, and what
    is looked up without a join: the next-byte probabilities of the ``most_contexts`` most
    frequent contexts, the ``most_codes`` most frequent codes and the ``most_words`` most frequent
    words; all others stay in tables. No rows give a model that knows nothing.
    """
    spark = small_batches(rows.sparkSession)
    texts = rows.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = texts.mapInArrow(_count_batches(depth), "kind int, code bigint, n bigint")
    counts = written(counted.groupBy("kind", "code").agg(F.sum("n").alias("n")), "counts")
    words, grams = counts.where(f"kind = {WORD}").select("code", "n"), counts.where(f"kind = {GRAM}").select("code", "n")
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()

    made = _dealt(grams, depth).mapInArrow(_top_batches(depth), "key bigint, zeros bigint, ones bigint, weight bigint")
    top = _top(made.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "weight")]).toArrow(), depth)
    full = F.shiftright("code", 8).bitwiseAND(F.lit((1 << 8 * depth) - 1))
    often = grams.groupBy(full.alias("context")).agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "context").limit(most_contexts)
    contexts = np.sort(often.select("context").toArrow()["context"].to_numpy().view(np.uint64))
    shared = spark.sparkContext.broadcast(([tuple(x) for x in top], contexts))
    learnt = written(
        _dealt(grams, depth).mapInArrow(_learnt_batches(depth, shared), "code bigint, n bigint, value double, after binary"), "learnt"
    )
    after = learnt.where("after is not null").select("code", "after").toArrow()
    order = np.argsort(after["code"].to_numpy().view(np.uint64))
    table = np.frombuffer(b"".join(after["after"].to_pylist()), np.float32).reshape(-1, 256)[order]
    del after
    asked = learnt.where("after is null").orderBy(F.desc("n"), "code").limit(most_codes).select("code", "value").toArrow()
    codes, values = asked["code"].to_numpy().view(np.uint64), asked["value"].to_numpy().astype(np.float32)
    at = np.argsort(codes)
    frequent = words.orderBy(F.desc("n"), "code").limit(most_words).toArrow()
    hashes, often = frequent["code"].to_numpy().view(np.uint64), frequent["n"].to_numpy()
    order = np.argsort(hashes)
    model = Model(depth, contexts, table, codes[at], values[at], hashes[order], often[order], int(n), int(v), top, grams)
    return model, words


def byte_log10(model: Model, codes: np.ndarray) -> np.ndarray:
    """log10 probability of the last byte of each code after the rest; NaN if it is not looked up here."""
    # Without any training text all decisions are even.
    out = np.full(len(codes), np.nan if model.train_tokens else -8 * np.log10(2), np.float32)
    if len(model.codes):
        at = np.minimum(np.searchsorted(model.codes, codes), len(model.codes) - 1)
        found = model.codes[at] == codes
        out[found] = model.values[at[found]]
    if len(model.contexts):
        before = codes >> np.uint64(8)
        at = np.minimum(np.searchsorted(model.contexts, before), len(model.contexts) - 1)
        found = model.contexts[at] == before
        out[found] = model.table[at[found], (codes[found] & np.uint64(255)).astype(np.int64)]
    return out


class _Memo:
    """Scores of codes met before, one slot for each hash; a slot is overwritten when another code needs it."""

    def __init__(self, model: Model, bits: int = 21):
        self.model, self.shift = model, np.uint64(64 - bits)
        self.codes = np.full(1 << bits, np.uint64(2**64 - 1))
        self.values = np.zeros(1 << bits, np.float32)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        at = (codes * np.uint64(0x9E3779B97F4A7C15)) >> self.shift
        out = self.values[at]
        missing = np.flatnonzero(self.codes[at] != codes)
        if len(missing):
            new, back = np.unique(codes[missing], return_inverse=True)
            values = byte_log10(self.model, new)
            out[missing] = values[back]
            self.codes[at[missing]], self.values[at[missing]] = codes[missing], out[missing]
            # Two new codes may share a slot; the slot must hold one of them whole.
            at_new = (new * np.uint64(0x9E3779B97F4A7C15)) >> self.shift
            self.codes[at_new], self.values[at_new] = new, values
        return out


def _with_counts(row: np.ndarray, hashes: np.ndarray, rows: int) -> pa.ListArray:
    """For each of ``rows`` its distinct hashes with their number; ``row`` is in order."""
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1]))[: len(row)])
    counts = np.diff(np.append(first, len(row)))
    offsets = np.append(0, np.cumsum(np.bincount(row[first], minlength=rows)))
    items = pa.StructArray.from_arrays([pa.array(hashes[first].view(np.int64)), pa.array(counts)], names=["h", "c"])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), items)


def score(docs: DataFrame, model: Model, words: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, key, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for every row of ``docs``.

    Null texts read as empty and consist of their end alone. Frequent words and windows of bytes
    come from the model; any other word from a join with all counted words, any other window from
    a join with its probability in the whole tree, so none is approximate. ``score`` is the log10
    probability of the lower-cased bytes and the end.
    """
    spark = small_batches(docs.sparkSession)
    shared = spark.sparkContext.broadcast(tuple(model._replace(top=None, grams=None)))
    text = F.coalesce(column(docs, text_column).cast("string"), F.lit(""))
    keyed = docs.select(column(docs, id_column).alias("id"), text_key(text).alias("key"), text.alias("text"))
    complete = model.distinct_tokens <= len(model.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        memo = _Memo(model)
        gains = np.log10(model.word_counts + 1.0)
        for batch in batches:
            for piece in arrays.pieces(batch.column(2)):
                rows = len(piece.starts)
                codes, first = _windows(piece, model.depth)
                logs = memo(codes).astype(np.float64)
                unknown = np.flatnonzero(np.isnan(logs))
                logs[unknown] = 0.0
                scores = arrays.sums_exact(logs, first)
                windows = np.searchsorted(first, unknown, "right") - 1
                hashes, word_first = _words(piece)
                row = np.repeat(np.arange(rows), np.diff(word_first))
                distinct, back = np.unique(hashes, return_inverse=True)
                known = np.zeros(len(distinct), bool)
                gain = np.zeros(len(distinct))
                if len(model.words):
                    at = np.minimum(np.searchsorted(model.words, distinct), len(model.words) - 1)
                    known = model.words[at] == distinct
                    gain[known] = gains[at[known]]
                rare = np.flatnonzero(~known[back]) if not complete else np.zeros(0, np.int64)
                # Rare words and windows of a row with their number, for the join.
                words_left = _with_counts(row[rare], hashes[rare], rows)
                codes_left = _with_counts(windows, codes[unknown], rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.first, rows),
                        batch.column(1).slice(piece.first, rows),
                        pa.array(np.diff(word_first)),
                        pa.array(arrays.sums_by_row(known[back].astype(np.int64), word_first)),
                        pa.array(arrays.sums_exact(gain[back], word_first)),
                        pa.array(scores),
                        pa.array(piece.ends - piece.starts),
                        words_left,
                        codes_left,
                    ],
                    names=["id", "key", "n_tokens", "known", "gain", "score", "n_bytes", "rare", "windows"],
                )

    made = StructType.fromDDL(
        "n_tokens bigint, known bigint, gain double, score double, n_bytes bigint, "
        "rare array<struct<h:bigint,c:bigint>>, windows array<struct<h:bigint,c:bigint>>"
    )
    scored = written(keyed.mapInArrow(run, StructType([*keyed.schema.fields[:2], *made.fields])), "scored")
    left = [
        scored.where(F.size(name) > 0).select("id", "key", F.lit(kind).alias("kind"), F.inline(name))
        for name, kind in (("rare", WORD), ("windows", GRAM))
    ]
    asked = left[1].select(F.col("h").alias("code"), F.lit(0).cast("bigint").alias("n")).distinct()
    tops = spark.sparkContext.broadcast([tuple(x) for x in model.top])
    answers = _dealt(model.grams.unionByName(asked), model.depth).mapInArrow(_asked_batches(model.depth, tops), "code bigint, value double")
    table = words.select(F.lit(WORD).alias("of"), "code", F.log10(F.col("n") + 1).alias("value"))
    table = table.unionByName(answers.select(F.lit(GRAM).alias("of"), "code", "value"))
    met = left[0].unionByName(left[1]).join(table, (F.col("kind") == F.col("of")) & (F.col("h") == F.col("code")))
    # Rows equal in id and text meet the same words and windows: each counts once.
    met = met.groupBy("id", "key", "kind", "h").agg(F.first("c").alias("c"), F.first("value").alias("value"))
    of_word, worth = F.col("kind") == WORD, F.col("c") * F.col("value")
    met = met.groupBy(F.col("id").alias("met_id"), F.col("key").alias("met_key")).agg(
        F.sum(F.when(of_word, F.col("c"))).alias("met_known"),
        F.sum(F.when(of_word, worth)).alias("met_gain"),
        F.sum(F.when(~of_word, worth)).alias("met_score"),
    )
    if not model.train_tokens:  # nothing is known: no word or window has anything to meet
        met = met.limit(0)
    joined = scored.join(met, F.col("id").eqNullSafe(F.col("met_id")) & (F.col("key") == F.col("met_key")), "left")
    joined = joined.withColumn("score", F.col("score") + F.coalesce("met_score", F.lit(0.0)))
    unit = float(np.log10(max(1, model.train_tokens + model.distinct_tokens + 1)))
    return joined.select(
        "id",
        "key",
        "n_tokens",
        (F.col("known") + F.coalesce("met_known", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("gain") + F.coalesce("met_gain", F.lit(0.0)) - F.col("n_tokens") * unit).alias("base_score"),
        "score",
        (-F.col("score") / float(np.log10(2)) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"),
    )


def held_out(id_: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id does not."""
    return F.coalesce(F.crc32(id_.cast("string")) % parts == part, F.lit(False))
