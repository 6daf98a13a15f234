"""Line de-duplication by content-defined chunks of lines.

Lines are folded at sentence and clause ends and at the word whose hash is smallest among FOLD
neighbouring ones, so that no line is longer than FOLD words wherever a passage stands in a
paragraph. A chunk ends after the line whose rolling hash is smallest within a window of
neighbouring lines; where chunks end depends on nearby lines alone, so a shared passage is cut
alike in every document. Each chunk is hashed together with the lines that follow it, up to LEAST
words (an anchor): so much is rarely alike by chance. Of a shared span, the first line end that
is alike comes after at most 2 * FOLD - 1 words, a chunk starts at most WINDOW + 1 lines later, an
anchor has at most LEAST + FOLD - 1 words, and line ends are alike up to FOLD - 1 words before the
span's end: any 47 shared words hold an anchor. Anchors that occur more than once anywhere are
compared byte by byte with their first occurrence, the match is extended line by line to both sides,
and long enough runs of matched lines are removed, except where they come first. What is carried
for the comparison are pieces of a bounded number of lines, however long a repeated passage is.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from suarakit.llm import arrays
from suarakit.llm.common import bit_map, column, discard, fresh, in_bit_map, in_map, small_batches, text_key, written

WINDOW = 14  # lines among which the smallest rolling hash ends a chunk
FOLD = 2  # words among which the smallest hash ends a line, besides punctuation
LEAST = 12  # words of a chunk and the lines after it that are hashed as one
PIECE = 96  # lines in which anchors of one carried piece start
AROUND = 16  # lines on each side of a chunk that a match may be extended by
BYTES = 1 << 18  # of text handled at once: what is derived from them fits a core's cache

_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?,;:")] = True
_IS_WORD = arrays.NOT_SPACE.tobytes()
_BLANKS = np.where(arrays.NOT_SPACE, np.arange(256), 32).astype(np.uint8).tobytes()


class Lines(NamedTuple):
    """Folded lines of a piece: bytes, hash and words of each; ``first`` bounds the rows' lines."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    n_words: np.ndarray
    first: np.ndarray
    words: arrays.Runs  # of the piece


def _smallest(values: np.ndarray, row: np.ndarray, window: int, last: np.ndarray) -> None:
    """Mark in ``last`` the smallest (of equal ones the last) value of every window within a row."""
    windows = len(values) - window + 1
    if windows < 1:
        return
    # Windows of twice the size from two of half the size; the last step may overlap. How far into
    # its window the smallest value stands takes a byte.
    best, into, size = values, np.zeros(len(values), np.uint8), 1
    while size < window:
        step = min(size, window - size)
        later = np.negative((best[step:] <= best[:-step]).view(np.uint8))  # all bits or none
        into = into[:-step] ^ ((into[:-step] ^ (into[step:] + np.uint8(step))) & later)
        best = np.minimum(best[step:], best[:-step])
        size += step
    within = np.flatnonzero(row[:windows] == row[window - 1 :][:windows])
    last[within + into[within]] = True


def fold(piece: arrays.Piece) -> Lines:
    words = arrays.runs(piece, arrays.NOT_SPACE)
    n = len(words.starts)
    if not n:
        none = np.zeros(0, np.int64)
        return Lines(none, none, np.zeros(0, np.uint64), none, np.zeros(len(piece.starts) + 1, np.int64), words)
    hashes = arrays.span_hashes(arrays.prefix_hashes(piece.data), words.starts, words.ends)
    last = _ENDS[piece.data[words.ends - 1]]
    _smallest(hashes, words.row, FOLD, last)
    last[words.first[1:][np.diff(words.first) > 0] - 1] = True
    # The word before a line feed.
    before = np.searchsorted(words.starts, np.flatnonzero(piece.data == 10)) - 1
    last[before[before >= 0]] = True
    tail = np.flatnonzero(last)
    head = np.append(0, tail[:-1] + 1)
    starts, ends = words.starts[head], words.ends[tail]
    first = np.append(np.searchsorted(starts, piece.starts), len(starts))
    # The words decide, not the white space between them.
    return Lines(starts, ends, arrays.span_hashes(arrays.prefix_hashes(hashes), head, tail + 1), tail - head + 1, first, words)


def _plain(piece: arrays.Piece, lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all words of a piece, each followed by one blank, and where each line begins in them."""
    words = lines.words
    begin = np.append(0, np.cumsum(words.ends - words.starts + 1))
    at = begin[np.append(0, np.cumsum(lines.n_words))]
    if not len(words.starts):
        return np.zeros(0, np.uint8), at
    raw = piece.data.tobytes()
    kept = np.frombuffer(bytearray(raw.translate(_IS_WORD)), bool)
    text = np.frombuffer(raw.translate(_BLANKS), np.uint8)
    # White space after a word is its blank; a word at the very end of a row has none yet.
    bare = words.ends == piece.ends[words.row]
    kept[words.ends[~bare]] = True
    return np.insert(text[kept], begin[1:][bare] - 1 - np.arange(int(bare.sum())), 32), at


class Chunks(NamedTuple):
    """Chunks as lines from ``low`` to ``high`` (exclusive), their hashes, words and rows."""

    low: np.ndarray
    high: np.ndarray
    hashes: np.ndarray
    n_words: np.ndarray
    row: np.ndarray


def cut(lines: Lines, window: int = WINDOW) -> Chunks:
    """Chunk the lines of every row."""
    n = len(lines.starts)
    row = np.repeat(np.arange(len(lines.first) - 1), np.diff(lines.first))
    last = np.zeros(n, bool)
    last[lines.first[1:][np.diff(lines.first) > 0] - 1] = True
    rolling = lines.hashes.copy()
    if n > 1:  # over two lines of a row
        rolling[1:] = np.where(row[1:] == row[:-1], arrays.mix(lines.hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + lines.hashes[1:]), rolling[1:])
    _smallest(rolling, row, window, last)
    high = np.flatnonzero(last) + 1
    low = np.append(0, high[:-1]) if len(high) else high
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(lines.hashes * arrays.powers(max(n, 1))[:n], out=sums[1:])
    counted = np.append(0, np.cumsum(lines.n_words))
    return Chunks(low, high, arrays.span_hashes(sums, low, high), counted[high] - counted[low], row[low] if n else row)


def _anchors(lines: Lines, chunks: Chunks, least_words: int) -> Chunks:
    """From where each chunk starts, two lines and on to ``least_words`` words; none goes past its row."""
    counted = np.append(0, np.cumsum(lines.n_words))
    high = np.maximum(chunks.low + 2, np.searchsorted(counted, counted[chunks.low] + least_words))
    fits = high <= lines.first[chunks.row + 1]
    low, high, row = chunks.low[fits], high[fits], chunks.row[fits]
    n = len(lines.starts)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(lines.hashes * arrays.powers(max(n, 1))[:n], out=sums[1:])
    return Chunks(low, high, arrays.span_hashes(sums, low, high), counted[high] - counted[low], row)


def _count_batches(least_words: int):
    """Distinct chunk hashes of a batch and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in arrays.pieces(batch.column(0), BYTES):
                lines = fold(piece)
                hashes, counts = np.unique(_anchors(lines, cut(lines), least_words).hashes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], names=["h", "n"])

    return run


_RUN = "low int, body binary, anchors array<struct<h:bigint,line:int,at:int>>"


def _run_batches(least_words: int, probe):
    """Neighbouring anchors whose hash may be repeated, as one run with a few lines around it.

    A run has its first line's place in the row, its words (a bounded number of lines), each followed
    by a blank, and its anchors: their line in the row and where they begin in the run's bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in arrays.pieces(batch.column(2), BYTES):
                lines = fold(piece)
                anchors = _anchors(lines, cut(lines), least_words)
                found = np.flatnonzero(in_bit_map(probe.value, anchors.hashes))
                if not len(found):
                    continue
                rows = anchors.row[found]
                low = np.maximum(anchors.low[found] - AROUND, lines.first[rows])
                high = np.minimum(anchors.high[found] + AROUND, lines.first[rows + 1])
                # Anchors whose surroundings meet are one run; a long run is cut into pieces that
                # overlap by their surroundings.
                opens = np.append(True, (rows[1:] != rows[:-1]) | (low[1:] > high[:-1]))
                begin = low[np.flatnonzero(opens)][np.cumsum(opens) - 1]
                opens[1:] |= ((low - begin) // PIECE)[1:] != ((low - begin) // PIECE)[:-1]
                head = np.flatnonzero(opens)
                tail = np.append(head[1:], len(found)) - 1
                text, at = _plain(piece, lines)
                raw = text.tobytes()
                own = at[low[head]]
                items = pa.StructArray.from_arrays(
                    [
                        pa.array(anchors.hashes[found].view(np.int64)),
                        pa.array((anchors.low[found] - lines.first[rows]).astype(np.int32)),
                        pa.array((at[anchors.low[found]] - own[np.cumsum(opens) - 1]).astype(np.int32)),
                    ],
                    names=["h", "line", "at"],
                )
                take = pa.array(rows[head] + piece.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        pa.array((low[head] - lines.first[rows[head]]).astype(np.int32)),
                        pa.array([raw[a:b] for a, b in zip(own.tolist(), at[high[tail]].tolist())], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.append(head, len(found)).astype(np.int32)), items),
                    ],
                    names=["id", "key", "low", "body", "anchors"],
                )

    return run


def earlier_places(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_words: int = LEAST
) -> DataFrame:
    """id, key, places: where a document's anchors stand first, for all that stand elsewhere first.

    A place has the words of the earlier run (``body``) and the anchors shared with it: their line
    in this document, and where they begin in the body. Earlier means the smaller (id, key, line);
    null ids come last. Rows equal in id and text are one document. Two scans of the texts: the
    first counts anchor hashes, combined per batch and before the shuffle; the second writes the
    runs of lines that hold repeated ones. Only hashes and places are joined to find each anchor's
    first place; then every document gets the bodies that hold the first places of its anchors,
    once each: bytes in proportion to its own.
    """
    spark = small_batches(docs.sparkSession)
    text = column(docs, text_column).cast("string")
    keyed = docs.select(column(docs, id_column).alias("id"), text_key(text).alias("key"), text.alias("text"))
    counts = keyed.select("text").mapInArrow(_count_batches(least_words), "h bigint, n bigint")
    repeated = written(counts.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h"), "repeated")
    probe = spark.sparkContext.broadcast(bit_map(repeated, "h"))
    schema = StructType([*keyed.schema.fields[:2], *StructType.fromDDL(_RUN)])
    runs = written(keyed.mapInArrow(_run_batches(least_words, probe), schema), "runs")

    anchors = runs.select("id", "key", "low", F.inline("anchors"))
    place = [F.col("id").isNull().alias("none"), F.col("id"), F.col("key"), F.col("line")]
    first = F.min(F.struct(*place, "low", "at")).alias("first")
    # Written, so that the join below may split the rows of a frequent hash.
    firsts = written(anchors.groupBy("h").agg(first).withColumnRenamed("h", "first_h"), "firsts")
    later = anchors.drop("at").join(firsts, F.col("h") == F.col("first_h"))
    later = later.where(F.struct(*place) > F.struct("first.none", "first.id", "first.key", "first.line"))
    run = F.xxhash64("first.id", "first.key", "first.low")
    pairs = later.groupBy("id", "key", run.alias("first_run"), F.col("first.key").alias("first_key")).agg(
        F.collect_set(F.struct("line", "first.at")).alias("anchors")
    )
    pairs = written(pairs, "pairs")
    discard(repeated, firsts)
    # The words of runs that are first anywhere. Rows equal in id and text have equal runs.
    wanted = written(pairs.select("first_run", "first_key").distinct(), "wanted")
    bodies = runs.select(F.xxhash64("id", "key", "low").alias("run"), F.col("key").alias("run_key"), "body")
    asked = spark.sparkContext.broadcast(bit_map(wanted.select(F.xxhash64("first_run", "first_key").alias("h")), "h"))
    bodies = in_map(bodies, F.xxhash64("run", "run_key"), asked).join(
        wanted, (F.col("run") == F.col("first_run")) & (F.col("run_key") == F.col("first_key")), "left_semi"
    )
    bodies = bodies.groupBy("run", "run_key").agg(F.first("body").alias("body"))
    met = pairs.join(bodies, (F.col("first_run") == F.col("run")) & (F.col("first_key") == F.col("run_key")))
    return met.groupBy("id", "key").agg(F.collect_list(F.struct("anchors", "body")).alias("places"))


def _alike(ours: np.ndarray, at: np.ndarray, theirs: np.ndarray, other: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many bytes from ours[at] and theirs[other] on are equal, at most ``most``, for each pair of places.

    Both arrays have eight more bytes at their end.
    """
    mine, yours = (np.ndarray(len(x) - 7, "<u8", np.ascontiguousarray(x), strides=(1,)) for x in (ours, theirs))
    n, left = np.zeros(len(at), np.int64), np.flatnonzero(most > 0)
    for _ in range(64):
        differ = mine[at[left] + n[left]] ^ yours[other[left] + n[left]]
        ends = np.flatnonzero(differ)
        # The lowest bit that differs is in the first byte that does.
        lowest = differ[ends] & (~differ[ends] + np.uint64(1))
        n[left[ends]] += np.log2(lowest.astype(np.float64)).astype(np.int64) >> 3
        left = left[differ == 0]
        n[left] += 8
        left = left[n[left] < most[left]]
        if not len(left):
            break
    for i in left.tolist():  # long ones, one by one
        a, b, size = int(at[i] + n[i]), int(other[i] + n[i]), int(most[i] - n[i])
        differ = ours[a : a + size] != theirs[b : b + size]
        first = int(differ.argmax())
        n[i] += first if differ[first] else size
    return np.minimum(n, most)


class _Places(NamedTuple):
    """Places of the rows of a batch as flat arrays."""

    rows: np.ndarray  # row i has the places from rows[i] to rows[i + 1]
    anchors: np.ndarray  # place j has the anchors from anchors[j] to anchors[j + 1]
    lines: np.ndarray
    others: np.ndarray
    bodies: np.ndarray  # place j has the bytes from bodies[j] to bodies[j + 1]
    bytes: np.ndarray
    backward: np.ndarray


_MORE = np.zeros(8, np.uint8)


def _flat(places: pa.ListArray) -> _Places:
    anchors, items = places.values.field("anchors"), places.values.field("anchors").values
    bodies = places.values.field("body")
    _, offsets, data = bodies.buffers()
    wide = np.int64 if pa.types.is_large_binary(bodies.type) else np.int32
    offsets = np.frombuffer(offsets, wide)[bodies.offset : bodies.offset + len(bodies) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return _Places(
        places.offsets.to_numpy(), anchors.offsets.to_numpy(), items.field("line").to_numpy(), items.field("at").to_numpy(),
        offsets - offsets[0], np.append(raw, _MORE), np.append(raw[::-1], _MORE),
    )


def _matched(text: np.ndarray, line_at: np.ndarray, lines: Lines, flat: _Places, first: int) -> np.ndarray:
    """Whether each line of a piece, whose rows start at row ``first``, is in a span equal to one of a place.

    ``text`` are words, each followed by a blank, and ``line_at`` where lines begin in them. Each
    shared anchor is compared byte by byte and extended both ways, unless an earlier match on its
    diagonal went past it. All diagonals are followed at once.
    """
    n = len(lines.starts)
    marks = np.zeros(n + 1, np.int64)
    upto = flat.rows[first : first + len(lines.first)]
    low, high = flat.anchors[upto[0]], flat.anchors[upto[-1]]
    place = np.repeat(np.arange(upto[0], upto[-1]), np.diff(flat.anchors[upto[0] : upto[-1] + 1]))
    row = np.searchsorted(upto, place, "right") - 1
    line, other = flat.lines[low:high] + lines.first[row], flat.others[low:high].astype(np.int64)
    diagonal = line_at[line] - other
    order = np.lexsort((line, diagonal, place))
    place, diagonal, row, line, other = (v[order] for v in (place, diagonal, row, line, other))
    opens = np.append(True, (place[1:] != place[:-1]) | (diagonal[1:] != diagonal[:-1]))[: len(place)]
    group = np.cumsum(opens) - 1
    key = group * (n + 1) + line
    forward, backward = np.append(text, _MORE), np.append(text[::-1], _MORE)
    now = np.flatnonzero(opens)
    while len(now):
        at, begin = line_at[line[now]], flat.bodies[place[now]] + other[now]
        most = np.minimum(line_at[lines.first[row[now] + 1]] - at, flat.bodies[place[now] + 1] - begin)
        stop = at + _alike(forward, at, flat.bytes, begin, most)
        end = np.searchsorted(line_at, stop, "right") - 1
        after = now + 1
        some = np.flatnonzero(end > line[now])  # the others have equal hashes alone
        found, at, begin, end = now[some], at[some], begin[some], end[some]
        most = np.minimum(at - line_at[lines.first[row[found]]], other[found])
        back = _alike(backward, len(text) - at, flat.backward, flat.bodies[-1] - begin, most)
        start = np.searchsorted(line_at, at - back, "left")
        # Our first word may be the end of one of theirs.
        start += (line_at[start] == at - back) & (other[found] > back) & (flat.bytes[begin - back - 1] != 32)
        marks += np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1)
        after[some] = np.maximum(after[some], np.searchsorted(key, group[found] * (n + 1) + end))
        inside = after < len(group)
        now, after = now[inside], after[inside]
        now = after[group[after] == group[now]]
    return np.cumsum(marks)[:-1] > 0


def _cleaned(texts: pa.Array, places: pa.ListArray, least_run: int) -> Iterator[tuple[int, str, int]]:
    """Row, text without the runs of matched lines of at least ``least_run`` words, and words removed, for
    the rows that lose any."""
    flat = _flat(places)
    for piece in arrays.pieces(texts, BYTES):
        lines = fold(piece)
        text, line_at = _plain(piece, lines)
        matched = _matched(text, line_at, lines, flat, piece.first)
        covered = np.concatenate([[0], matched, [0]]).astype(np.int8)
        counted = np.append(0, np.cumsum(lines.n_words))
        raw = piece.data.tobytes()
        for i in np.flatnonzero(np.add.reduceat(covered, np.append(lines.first[:-1] + 1, len(covered) - 1))[:-1] > 0).tolist() if len(lines.starts) else []:
            low, high = int(lines.first[i]), int(lines.first[i + 1])
            own = np.concatenate([[0], covered[low + 1 : high + 1], [0]])
            edges = np.flatnonzero(np.diff(own)).reshape(-1, 2) + low
            kept, upto, gone = [], int(piece.starts[i]), 0
            for a, b in edges.tolist():
                words = int(counted[b] - counted[a])
                if words >= least_run:
                    kept.append(raw[upto : lines.starts[a]])
                    upto = int(lines.starts[b] if b < high else piece.ends[i])
                    gone += words
            if gone:
                out = b"".join([*kept, raw[upto : piece.ends[i]]])
                yield piece.first + i, (out.decode() if gone < counted[high] - counted[low] else ""), gone


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_run: int = 30,
    counts: str | None = None,
) -> DataFrame:
    """``docs`` with repeated passages cut out of the text; all rows and other columns stay.

    A passage goes if it is a run of at least ``least_run`` words of lines that also stand at
    an earlier place; the earliest one stays. ``counts`` names an extra column for the number
    of words removed. Null and empty texts stay as they are; a text that is all repetition
    becomes empty; rows equal in id and text get the same text. No rows give no rows.
    """
    names = docs.columns
    key, places, other_id, other_key = (fresh(names, n) for n in ("key__", "places__", "id__", "other_key__"))
    gone_name = fresh(names, "gone__")
    found = earlier_places(docs, id_column, text_column).toDF(other_id, other_key, places)
    keyed = docs.withColumn(key, text_key(column(docs, text_column).cast("string")))
    joined = keyed.join(
        found, column(keyed, id_column).eqNullSafe(found[other_id]) & (keyed[key] == found[other_key]), "left"
    )
    at = names.index(text_column)
    joined = joined.select(*[column(docs, n) for n in names], places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matched, n = batch.column(len(names)), np.zeros(batch.num_rows, np.int64)
            texts = batch.column(at)
            some = np.flatnonzero(matched.is_valid().to_numpy(zero_copy_only=False))
            if len(some):
                take, changed = pa.array(some), []
                for i, text, gone in _cleaned(texts.take(take), matched.take(take), least_run):
                    changed.append(text)
                    n[some[i]] = gone
                texts = pc.replace_with_mask(texts, pa.array(n > 0), pa.array(changed, texts.type))
            columns = [*batch.columns[:at], texts, *batch.columns[at + 1 : len(names)], pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[: len(names)], gone_name])

    schema = StructType([*joined.schema.fields[: len(names)], StructField(gone_name, StructType.fromDDL("n bigint")[0].dataType)])
    out = joined.mapInArrow(run, schema)
    return out.withColumnRenamed(gone_name, counts) if counts else out.drop(gone_name)
