"""Texts of an Arrow batch as flat byte arrays: words, their hashes, sums per document.

Everything works on bytes of UTF-8: the separators used here are ASCII, so no character is
ever cut. Batches are handled in pieces of about a megabyte, which bounds the working memory
by a small multiple of the piece or of the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes of words between white space, and of words of letters, digits and non-ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, *range(9, 14)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[65:91] = ALNUM[128:] = True


class Piece(NamedTuple):
    """Rows ``first`` to ``first + len(starts)`` of a batch; offsets point into ``data``."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def pieces(texts: pa.Array, size: int = PIECE) -> Iterator[Piece]:
    """Cut a string or binary column into runs of rows; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        stop = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        stop = min(stop, len(texts))
        base = at[first]
        yield Piece(first, raw[base : at[stop]], at[first:stop] - base, at[first + 1 : stop + 1] - base)
        first = stop


def mix(h: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values (a fixed permutation)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the base (or of its inverse) modulo 2**64."""
    kept = _powers.get(inverse)
    if kept is None or len(kept) < n:
        room = max(n, PIECE + 65536)
        steps = np.full(room, _P_INVERSE if inverse else _P, np.uint64)
        steps[0] = 1
        kept = np.multiply.accumulate(steps)
        if room <= 4 * PIECE:
            _powers[inverse] = kept
    return kept


class Runs(NamedTuple):
    """Word boundaries in a piece, the row of each word, and the first word of each row."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray  # one more than rows: the words of row i are first[i] to first[i + 1]


def runs(piece: Piece, member: np.ndarray) -> Runs:
    """Maximal runs of bytes for which ``member`` holds, never across rows."""
    inside = np.frombuffer(piece.data.tobytes().translate(member.tobytes()), bool)
    n = len(inside)
    opens = inside.copy()
    closes = inside.copy()
    if n:
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        full = piece.ends > piece.starts
        at = piece.starts[full]
        opens[at] = inside[at]
        closes[piece.ends[full] - 1] = inside[piece.ends[full] - 1]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    first = np.append(np.searchsorted(starts, piece.starts), len(starts))
    return Runs(starts, ends, np.repeat(np.arange(len(piece.starts)), np.diff(first)), first)


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any span follows; see ``span_hashes``."""
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers(len(codes) or 1)[: len(codes)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-free 64-bit hash of each span of codes; equal spans have equal hashes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    unshift = powers(len(sums), inverse=True)[starts]
    return mix((sums[ends] - sums[starts]) * unshift + (ends - starts).astype(np.uint64))


def word_hashes(piece: Piece, words: Runs) -> np.ndarray:
    """Hash of each word with A-Z taken as a-z."""
    return span_hashes(prefix_hashes(LOWER[piece.data]), words.starts, words.ends)


def sums_by_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of values[first[i]:first[i + 1]] for each row, empty rows included."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def sums_exact(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """As ``sums_by_row`` for floats, each row added on its own: equal rows have equal sums."""
    out = np.zeros(len(first) - 1)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.add.reduceat(values, first[full])
    return out
