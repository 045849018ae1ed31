"""Vectorised byte kernels: words, hashes and slices of UTF-8 columns.

All text is seen as UTF-8 bytes.  A word is a run of bytes other than
0x20 and 0x09-0x0D, which are never part of a longer UTF-8 sequence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Also the ASCII punctuation, where words are compared without it.
SPACE_OR_MARK = SPACE.copy()
SPACE_OR_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
#: Bytes handled at a time; temporaries take about 60 bytes for each.
SLICE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on all input bits."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=U) * U(BASE))
_lower = np.arange(256)
_lower[65:91] += 32
LOWER_BYTE = BYTE[_lower]

_powers = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, INVERSE)):
            p = np.full(n, base, U)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """P with P[i] = sum of values[j] * BASE**j for j < i."""
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span; equal spans have equal hashes wherever they stand."""
    h = prefix[end] - prefix[start]
    h *= powers(len(prefix))[1][start]
    h += (end - start).astype(U)
    return mix(h)


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary()
    column = column.cast(kind if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, b"" if column.type == kind else "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE):
    """Ranges of rows with at most limit bytes each, or one longer row alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def lone(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the characters of scripts that put no blanks between words.

    These are Thai, Lao, Myanmar and Khmer, and all from U+3000 to U+9FFF, of
    full width, or in the planes of rarer ideographs.
    """
    at = np.flatnonzero(data >= 0xE0)
    at = at[at + 2 < len(data)]
    a, b = data[at], data[at + 1]
    three = ((a >= 0xE3) & (a <= 0xE9)) | ((a == 0xE0) & (b >= 0xB8) & (b <= 0xBB)) | ((a == 0xE1) & ((b <= 0x82) | (b == 0x9E) | (b == 0x9F))) | ((a == 0xEF) & ((b == 0xBC) | (b == 0xBD)))
    four = (a == 0xF0) & (b >= 0xA0) & (b <= 0xB3)
    start = at[three | four]
    return start, np.minimum(start + np.where(four[three | four], 4, 3), len(data))


def _spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE, alone: bool = False) -> tuple[np.ndarray, np.ndarray]:
    solid = ~space[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    if alone:
        for edge in lone(data):
            first[edge] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    end = np.flatnonzero(solid & (~after | first[1:])) + 1
    return start, end


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = LOWER_BYTE, space: np.ndarray = SPACE, alone: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words and, by row, where its words begin (one more at the end).

    With alone, each character that `lone` finds is a word.

    Long rows are cut behind white space, so the memory beside the hashes
    stays near SLICE unless one word is longer than that.
    """
    if len(data) <= 2 * SLICE:
        start, end = _spans(data, offsets, space, alone)
        return span_hash(prefix_hash(table[data]), start, end), np.searchsorted(start, offsets)
    found, at, n = [], [0], 0
    for i, j in zip(offsets[:-1], offsets[1:]):
        while i < j:
            k = j
            if j - i > SLICE:
                gap = np.flatnonzero(space[data[i + SLICE : j]][: 1 << 16])
                if not len(gap):
                    gap = np.flatnonzero(space[data[i + SLICE : j]])
                k = i + SLICE + int(gap[0]) if len(gap) else j
            piece = data[i:k]
            start, end = _spans(piece, np.array([0, k - i]), space, alone)
            found.append(span_hash(prefix_hash(table[piece]), start, end))
            n += len(start)
            i = k
        at.append(n)
    return (np.concatenate(found) if found else np.zeros(0, U)), np.array(at)
