"""Exact removal of repeated substrings by difference-cover suffix buckets.

A string of ``LENGTH`` bytes that also starts in a document with a smaller key
is removed.  A suffix array of the corpus, sorted as deep as ``LENGTH``, would
put equal strings side by side; here it is built blockwise, one bucket of
suffixes at a time, and never held as a whole:

* Cover samples.  Places of a document whose number modulo ``PERIOD`` is in the
  difference cover ``COVER`` are samples.  Any two suffixes have a distance
  below ``PERIOD``, which only their places decide, at which both have a
  sample; so equal suffixes have samples that agree in ``GRAM`` bytes.
* Buckets of samples.  A sample whose ``GRAM`` bytes stand once in the corpus
  settles that the suffixes before it are unique there; most of the text ends
  here, at two bytes a sample.
* Samples that share their bytes are compared with all they can tell: the
  bytes within reach on both sides (80 at most).  Of samples that agree in all
  of them, those of larger documents are gone with all their suffixes; this
  settles copies and the inside of passages by a hash of 96 bits.
* Ranks.  What is left of a bucket is one sample for each surrounding.  They are
  sorted once by the bytes to the right and once by the bytes to the left;
  these ranks of cover samples then decide every tie between suffixes: at
  distance d before their samples two are equal if the samples agree in d
  bytes to the left and LENGTH - d to the right, whatever the bytes were.
* A bucket with more than ``HOT`` surroundings is split: its suffixes go one by
  one, each under the hash of its own bytes.

Texts are packed into blocks of about ``BLOCK`` bytes, more for a large corpus, and written once, bucketed
by block, so later steps bring replies to the texts and not texts to replies.
Blocks and parts of the hash space bound the memory of every task.  In a block
equal records are one, so a passage in a third of all documents costs a record
a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .workspace import documents, Workspace

LENGTH = 50
#: A difference cover: each number modulo PERIOD is the difference of two of its members.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
BACK = PERIOD - 1
GRAM = LENGTH - BACK
BLOCK = 2 << 20
#: Bytes of text whose samples one part of the hash space gets.
PART_BYTES = 16 << 20
#: From so many bytes of text on, blocks and parts grow with the corpus, up to these times: their messages are one for each pair.
LARGE, MOST_BLOCK, MOST_PART = 1 << 30, 4, 2
HOT = 50_000
U = np.uint64
_LOW = U((1 << 32) - 1)
#: One of each for all small messages: making them takes longer than their work.
_ZIP, _UNZIP = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
#: A second hash of bytes, for what surrounds a sample.
_OTHER = K.mix(K.BYTE ^ U(0x5851F42D4C957F2D))


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes (so that slow bytes lie together), compressed."""
    head = np.array([len(arrays), *(x for a in arrays for x in (len(a), a.dtype.itemsize))], np.int64).tobytes()
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes() if len(a) else b"" for a in arrays]
    return _ZIP.compress(head + b"".join(planes))


def _unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    raw = _UNZIP.decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * n, 8)
    at, out = 8 + 16 * n, []
    for k, kind in enumerate(kinds):
        count, width = int(head[2 * k]), int(head[2 * k + 1])
        planes = np.frombuffer(raw, np.uint8, count * width, at).reshape(width, count) if count else np.zeros((width, 0), np.uint8)
        at += count * width
        full = np.zeros((count, np.dtype(kind).itemsize), np.uint8)
        full[:, :width] = planes.T
        out.append(full.reshape(-1).view(kind))
    return out


def _rising(x: np.ndarray) -> np.ndarray:
    """Rising 32-bit values as differences, in as few bytes as the largest needs."""
    gap = np.diff(x, prepend=U(0))
    width = max(1, (int(gap.max()).bit_length() + 7) // 8) if len(gap) else 1
    return np.ascontiguousarray(gap.view(np.uint8).reshape(-1, 8)[:, :width]).view(f"V{width}").reshape(-1)


def cover_samples(data: np.ndarray, offsets: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, Callable, np.ndarray, np.ndarray]:
    """Samples of documents with a key, by rising place: hash of the GRAM bytes, how to hash the surroundings of chosen ones, place, document."""
    size = np.diff(offsets)
    own = np.flatnonzero(known & (size >= LENGTH))
    turns, rest = np.divmod(size[own] - GRAM + 1, PERIOD)
    n = len(COVER) * turns + np.searchsorted(COVER, rest)
    cycle = (np.arange(n.max(initial=0) // len(COVER) + 1)[:, None] * PERIOD + np.array(COVER)).reshape(-1)
    ends = np.cumsum(n)
    place = cycle[np.arange(n.sum()) - np.repeat(ends - n, n)] + np.repeat(offsets[own], n)
    doc = np.repeat(own, n)
    return _gram_hash(data, place), lambda k: _surroundings(data, offsets, place[k], doc[k]), place, doc


def _gram_hash(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at each place, read as 64-bit words, the last of which may overlap the one before."""
    out = np.zeros(len(place), U)
    if len(place):
        words = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,))
        for a in range(0, len(place), K.SLICE):
            at, h = place[a : a + K.SLICE], out[a : a + K.SLICE]
            for k in (*range(0, GRAM - 8, 8), GRAM - 8):
                h ^= words[at + k]
                h[:] = K.mix(h * U(K.BASE) + U(k + 1))
    return out


def _surroundings(data: np.ndarray, offsets: np.ndarray, place: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hash of the bytes within reach on both sides of each of rising places."""
    out = np.empty(len(place), U)
    i = 0
    while i < len(place):
        j = max(i + 1, int(np.searchsorted(place, place[i] + K.SLICE)))
        p, d = place[i:j], doc[i:j]
        left, right = np.maximum(p - BACK, offsets[d]), np.minimum(p + LENGTH, offsets[d + 1])
        low = int(left[0])
        out[i:j] = _around(data[low : int(right[-1])], p - low, left - low, right - low)
        i = j
    return out


def _around(data: np.ndarray, place: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return K.mix(K.span_hash(K.prefix_hash(_OTHER[data]), left, right) + (place - left).astype(U))


def _keyed(gram: np.ndarray, parts: int) -> np.ndarray:
    """The part of the hash space and 32 bits in it, in one number."""
    return (((gram >> U(32)) % U(parts)) << U(32)) | (gram & _LOW)


def _edges(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part begins among rising keys, and their number."""
    return np.searchsorted(keys >> U(32), np.arange(parts + 1).astype(U))


def _reach(offsets: np.ndarray, place: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last suffix that a sample decides."""
    return np.maximum(place - BACK, offsets[doc]), np.minimum(place, offsets[doc + 1] - LENGTH)


def _records(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, known: np.ndarray, parts: int, replies: list | None) -> dict:
    """Shared samples of a block, by bucket and surroundings; leaders are the first of equal ones, with the least key.

    first and last tell the suffixes that a record decides.
    """
    gram, around, place, doc = cover_samples(data, offsets, known)
    key = _keyed(gram, parts)
    order = np.argsort(key)
    s = key[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    code = _replies(replies, _edges(s[new], parts))[np.cumsum(new) - 1]
    # surroundings are only hashed of shared samples
    hot, k = np.sort(order[code == 2]), np.sort(order[code == 1])
    h, c, p, d = key[k], around(k), place[k], doc[k]
    i, j = _reach(offsets, p, d)
    if len(hot):  # each suffix of its own
        first, last = _reach(offsets, place[hot], doc[hot])
        n = last - first + 1
        w = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        w, at = np.unique(w, return_index=True)
        own = np.repeat(doc[hot], n)[at]
        whole = K.span_hash(K.prefix_hash(K.BYTE[data]), w, w + LENGTH)
        more = _keyed(whole, parts), _around(data, w, w, w + LENGTH), w, own, w, w
        h, c, p, d, i, j = (np.concatenate(x) for x in zip((h, c, p, d, i, j), more))
    order = np.lexsort((ids[d], c, h))
    h, c, p, d, i, j = (x[order] for x in (h, c, p, d, i, j))
    lead = np.ones(len(h), bool)
    lead[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    top, group = np.flatnonzero(lead), np.cumsum(lead) - 1
    later = ids[d] > ids[d[top]][group] if len(top) else np.zeros(0, bool)
    return {"h": h, "around": c, "place": p, "doc": d, "first": i, "last": j, "top": top, "group": group, "later": later, "edge": _edges(h[top], parts)}


def _decided(g: dict, code: np.ndarray, parts: int) -> tuple:
    """From the verdicts on leaders: samples whose suffixes go, and which surroundings go to which part for sorting.

    Returned are those samples, the leaders to send in the order of parts, where
    parts begin, and the places whose suffixes hang on the answer of a rank.
    """
    fate = np.where(g["later"], 1, code[g["group"]] if len(code) else 0)
    k = np.flatnonzero(fate == 1)
    lead = np.flatnonzero(code == 2)
    t = g["top"][lead]
    part = (K.mix(g["h"][t].copy()) % U(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    alias = np.flatnonzero((fate == 2) & ~g["later"])
    return k, t[order], np.searchsorted(part[order], np.arange(parts + 1)), g["place"][alias], rank[np.searchsorted(lead, g["group"][alias])]


def _joined(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, pa.ChunkedArray]]:
    """Keys and texts of batches put together to at least so many bytes, so that short texts fill a block too."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.column(1).nbytes for x in held) >= size:
            yield pa.chunked_array([x.column(0) for x in held]).combine_chunks(), pa.chunked_array([x.column(1) for x in held])
            held = []
    if held:
        yield pa.chunked_array([x.column(0) for x in held]).combine_chunks(), pa.chunked_array([x.column(1) for x in held])


def sizes(total: int, block: int = BLOCK, part_bytes: int = PART_BYTES) -> tuple[int, int]:
    """Bytes of a block and of a part for a corpus of so many."""
    times = max(1.0, total / LARGE)
    return int(block * min(times, MOST_BLOCK)), int(part_bytes * min(times, MOST_PART))


def blocks(docs: DataFrame, key: str, text: str, size: int = BLOCK) -> DataFrame:
    """(block, bytes, ids, texts): whole documents packed into blocks."""
    picked = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for ids, texts in _joined(batches, size):
            data, offsets = K.utf8(texts)
            for i, j in K.slices(offsets, size):
                own = ids.slice(i, j - i)
                a, e = int(offsets[i]), int(offsets[j])
                meta = _pack(own.fill_null(0).to_numpy(), (~np.asarray(own.is_null())).astype(np.uint8), offsets[i : j + 1] - a)
                yield pa.RecordBatch.from_arrays([pa.array([e - a]), pa.array([meta], pa.binary()), pa.array([pack.compress(data[a:e].tobytes())], pa.binary())], ["bytes", "ids", "texts"])

    packed = picked.mapInArrow(run, "bytes bigint, ids binary, texts binary")
    return packed.select(F.monotonically_increasing_id().alias("block"), "*")


def _open(ids: bytes, texts: bytes) -> tuple:
    key, known, offsets = _unpack(ids, np.int64, np.uint8, np.int64)
    return np.frombuffer(zstandard.decompress(texts), np.uint8), offsets, key, known.astype(bool)


_SENT = "part int, block bigint, payload binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    part, block, payload = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(block, pa.int64()), pa.array(payload, pa.binary())], ["part", "block", "payload"])


def _replies(rows: list | None, edge: np.ndarray) -> np.ndarray:
    """One code for each record that was sent, from the parts' replies."""
    out = np.zeros(int(edge[-1]), np.uint8)
    for x in rows or []:
        out[edge[x["part"]] : edge[x["part"] + 1]] = _unpack(x["payload"], np.uint8)[0]
    return out


def _within(around: Callable, key: np.ndarray, order: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of groups of samples that `order` puts side by side: how many surroundings, and whether several keys, they have in the block."""
    count, several = np.ones(len(size), np.int64), np.zeros(len(size), bool)
    more = np.flatnonzero(size > 1)
    if len(more):
        n = size[more]
        k = np.sort(order[np.repeat(size > 1, size)])
        group = np.empty(len(order), np.int64)
        group[order] = np.repeat(np.arange(len(size)), size)
        c, g, own = around(k), group[k], key[k]
        by = np.lexsort((c, g))
        c, g, own = c[by], g[by], own[by]
        other = np.ones(len(k), bool)
        other[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
        start = np.cumsum(n) - n
        count[more] = np.add.reduceat(other.astype(np.int64), start)
        several[more] = np.minimum.reduceat(own, start) != np.maximum.reduceat(own, start)
    return count, several


def _send_grams(parts: int):
    """The different samples of a block, and of those that occur again there how many surroundings and documents have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, ids, texts in zip(*(c.to_pylist() for c in b.columns)):
                data, offsets, key, known = _open(ids, texts)
                gram, around, place, doc = cover_samples(data, offsets, known)
                h = _keyed(gram, parts)
                order = np.argsort(h)
                h = h[order]
                new = np.ones(len(h), bool)
                new[1:] = h[1:] != h[:-1]
                top = np.flatnonzero(new)
                rows = []
                if len(top):
                    size = np.diff(np.append(top, len(h)))
                    count, several = _within(around, key[doc], order, size)
                    h, again = h[top], np.flatnonzero((count > 1) | several)
                    edge = _edges(h, parts)
                    at = np.searchsorted(again, edge)
                    for p in np.flatnonzero(np.diff(edge)).tolist():
                        k = again[at[p] : at[p + 1]]
                        rows.append((p, block, _pack(_rising(h[edge[p] : edge[p + 1]] & _LOW), _rising((k - edge[p]).astype(U)), count[k].astype(np.uint32), several[k].astype(np.uint8))))
                yield _rows(rows)

    return run


def _judge_grams(table: pa.Table) -> pa.Table:
    """For each sample sent: 0 stands in one document, 1 in several, 2 in too many surroundings."""
    h, count, several, sizes = [], [], [], []
    for x in table.column("payload").to_pylist():
        gap, at, n, s = _unpack(x, U, U, np.uint32, np.uint8)
        h.append(np.cumsum(gap).astype(np.uint32))
        sizes.append(len(gap))
        at = np.cumsum(at).astype(np.int64)
        count.append(np.ones(len(gap), np.uint32)), several.append(np.zeros(len(gap), bool))
        count[-1][at], several[-1][at] = n, s
    h, count, several = map(np.concatenate, (h, count, several))
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    top = np.flatnonzero(new)
    many = (np.diff(np.append(top, len(s))) > 1) | np.logical_or.reduceat(several[order], top)
    code = np.where(many, np.where(np.add.reduceat(count[order], top, dtype=np.int64) > HOT, 2, 1), 0).astype(np.uint8)
    out = np.empty(len(h), np.uint8)
    out[order] = np.repeat(code, np.diff(np.append(top, len(s))))
    return _answer(table, np.split(out, np.cumsum(sizes)[:-1]))


def _answer(table: pa.Table, codes: list[np.ndarray]) -> pa.Table:
    return pa.table([table.column("part"), table.column("block"), pa.array([_pack(c) for c in codes], pa.binary())], ["part", "block", "payload"])


def _send_records(parts: int):
    """The leaders of a block's shared samples: bucket, hash of the surroundings, document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, ids, texts, grams in zip(*(c.to_pylist() for c in b.columns)):
                data, offsets, key, known = _open(ids, texts)
                g = _records(data, offsets, key, known, parts, grams)
                rows = []
                for p in np.flatnonzero(np.diff(g["edge"])).tolist():
                    t = g["top"][g["edge"][p] : g["edge"][p + 1]]
                    own, local = np.unique(g["doc"][t], return_inverse=True)
                    rows.append((p, block, _pack(_rising(g["h"][t] & _LOW), g["around"][t], local.astype(np.uint32), key[own])))
                yield _rows(rows)

    return run


def _judge_records(table: pa.Table) -> pa.Table:
    """For each record sent: 0 stays, 1 has its like in a smaller document, 2 needs its bucket sorted."""
    got = [_unpack(x, U, U, np.uint32, np.int64) for x in table.column("payload").to_pylist()]
    sizes = [len(x[0]) for x in got]
    h, c = np.concatenate([np.cumsum(x[0]).astype(np.uint32) for x in got]), np.concatenate([x[1] for x in got])
    doc = np.concatenate([x[3][x[2]] for x in got])
    got.clear()
    order = np.lexsort((doc, c, h))
    h, c, doc = h[order], c[order], doc[order]
    new_h = np.ones(len(h), bool)
    new_h[1:] = h[1:] != h[:-1]
    new_c = new_h.copy()
    new_c[1:] |= c[1:] != c[:-1]
    top = np.flatnonzero(new_c)
    least = doc[top]
    start = np.flatnonzero(new_h[top])
    mixed = np.minimum.reduceat(least, start) != np.maximum.reduceat(least, start)
    code = np.where(doc > least[np.cumsum(new_c) - 1], 1, 2 * mixed[np.cumsum(new_h) - 1]).astype(np.uint8)
    out = np.empty_like(code)
    out[order] = code
    return _answer(table, np.split(out, np.cumsum(sizes)[:-1]))


def _send_contexts(parts: int):
    """The bytes around the leaders whose buckets are sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, ids, texts, grams, records in zip(*(c.to_pylist() for c in b.columns)):
                data, offsets, key, known = _open(ids, texts)
                g = _records(data, offsets, key, known, parts, grams)
                _, t, edge, _, _ = _decided(g, _replies(records, g["edge"]), parts)
                rows = []
                for p in np.flatnonzero(np.diff(edge)).tolist():
                    o = t[edge[p] : edge[p + 1]]
                    first, size = g["first"][o], g["last"][o] - g["first"][o] + LENGTH
                    ends = np.cumsum(size)
                    at = np.repeat(first - (ends - size), size) + np.arange(ends[-1])
                    rows.append((p, block, _pack(g["h"][o], key[g["doc"][o]], (g["place"][o] - first).astype(np.uint8), size.astype(np.uint8), data[at])))
                yield _rows(rows)

    return run


def _words(rows: np.ndarray) -> list[np.ndarray]:
    return [rows[:, k : k + 8].copy().view(">u8").reshape(-1).astype(U) for k in range(0, rows.shape[1], 8)]


def _classes(bucket: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows within buckets, and how many bytes each has in common with the one before (-1: another bucket)."""
    order = np.lexsort((*_words(rows)[::-1], bucket))
    s = rows[order]
    differs = s[1:] != s[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), s.shape[1])
    common[bucket[order][1:] != bucket[order][:-1]] = -1
    return order, np.concatenate([[-1], common])


def _sort_buckets(length: int, gram: int):
    reach = length - gram

    def run(table: pa.Table) -> pa.Table:
        """For each context sent, a bit for each distance whose window is also in a smaller document."""
        got = [_unpack(x, U, np.int64, np.uint8, np.uint8, np.uint8) for x in table.column("payload").to_pylist()]
        counts = [len(x[0]) for x in got]
        h, doc, ahead, size = (np.concatenate([x[k] for x in got]) for k in range(4))
        data = np.concatenate([x[4] for x in got])
        got.clear()
        ahead, size = ahead.astype(np.int64), size.astype(np.int64)
        out = np.zeros(len(h), U)
        # whole buckets, a bounded number of contexts at a time
        order = np.argsort(h, kind="stable")
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        cut, n = [0], len(h)
        while cut[-1] < n:
            e = min(n, cut[-1] + 60_000)
            cut.append(n if e == n else max(int(np.searchsorted(h[order], h[order[e]], "left")), int(np.searchsorted(h[order], h[order[cut[-1]]], "right"))))
        for i, j in zip(cut[:-1], cut[1:]):
            o = order[i:j]
            a, left_n, right_n = starts[o] + ahead[o], ahead[o], size[o] - ahead[o]
            left = np.zeros((len(o), -(-reach // 8) * 8), np.uint8)
            for k in range(reach):
                ok = left_n > k
                left[ok, k] = data[a[ok] - 1 - k]
            right = np.zeros((len(o), -(-length // 8) * 8), np.uint8)
            for k in range(length):
                ok = right_n > k
                right[ok, k] = data[a[ok] + k]
            bucket = h[o]
            by_left, same_left = _classes(bucket, left)
            by_right, same_right = _classes(bucket, right)
            lc, rc = np.empty(len(o), np.int64), np.empty(len(o), np.int64)
            for d in range(reach + 1):
                valid = np.flatnonzero((left_n >= d) & (right_n >= length - d))
                if len(valid) < 2:
                    continue
                lc[by_left] = np.cumsum(same_left < d)
                rc[by_right] = np.cumsum(same_right < length - d)
                same = lc[valid] * (len(o) + 1) + rc[valid]
                _, inverse = np.unique(same, return_inverse=True)
                least = np.full(inverse.max() + 1, np.iinfo(np.int64).max)
                own = doc[o[valid]]
                np.minimum.at(least, inverse, own)
                out[o[valid[own > least[inverse]]]] |= U(1) << U(d)
        cuts = np.split(out, np.cumsum(counts)[:-1])
        return pa.table([table.column("part"), table.column("block"), pa.array([_pack(c) for c in cuts], pa.binary())], ["part", "block", "payload"])

    return run


def _finish(length: int, parts: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts, grams, records, bits in zip(*(c.to_pylist() for c in b.columns)):
                data, offsets, key, known = _open(ids, texts)
                g = _records(data, offsets, key, known, parts, grams)
                k, _, edge, place, rank = _decided(g, _replies(records, g["edge"]), parts)
                # bytes that a string to remove covers: those between where one begins and where one ends
                step = np.zeros(len(data) + 1, np.int32)
                np.add.at(step, g["first"][k], 1)
                np.add.at(step, g["last"][k] + length, -1)
                if len(place):
                    answer = np.zeros(int(edge[-1]), U)
                    for x in bits or []:
                        answer[edge[x["part"]] : edge[x["part"] + 1]] = _unpack(x["payload"], U)[0]
                    own = answer[rank]
                    hit = np.flatnonzero(own)
                    for d in range(PERIOD):
                        at = place[hit[(own[hit] >> U(d)) & U(1) == 1]] - d
                        np.add.at(step, at, 1)
                        np.add.at(step, at + length, -1)
                gone = np.cumsum(step[:-1], dtype=np.int32) > 0
                n = len(key)
                opens, shuts = gone.copy(), gone.copy()
                opens[1:] &= ~gone[:-1]
                shuts[:-1] &= ~gone[1:]
                border = offsets[(offsets > 0) & (offsets < len(data))]  # no run crosses documents
                opens[border], shuts[border - 1] = gone[border], gone[border - 1]
                opens, shuts = np.flatnonzero(opens), np.flatnonzero(shuts) + 1
                at = np.searchsorted(opens, offsets)
                spans = np.diff(at)
                total = np.concatenate([[0], np.cumsum(shuts - opens)])
                keep = [data[i:j][~gone[i:j]] if m else data[i:j] for i, j, m in zip(offsets[:-1].tolist(), offsets[1:].tolist(), spans.tolist())]
                cols = [pa.array(key, mask=~known), pa.array(np.diff(offsets)), pa.array(np.diff(total[at])), pa.array(spans), pa.array([hashlib.sha256(x).hexdigest() for x in keep])]
                names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_text:
                    cols.append(pa.array([x.tobytes() for x in keep], pa.binary()))
                    names.append("kept_bytes")
                for i in range(0, n, 512):
                    yield pa.RecordBatch.from_arrays([c.slice(i, 512) for c in cols], names)

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False, block: int = BLOCK, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row a document: key, n_bytes, n_removed, n_spans, kept_sha256, and kept_bytes if asked for.

    Every byte of a ``LENGTH``-byte string that also starts in a document with
    a smaller key goes; strings are judged on the input.  Null texts are empty,
    texts of any length are read whole, an empty table gives no row, and other
    columns are not read.  Documents with one key do not remove each other's
    strings, and a document without a key neither loses bytes nor makes others
    lose any.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "substrings")
    total = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    n = max(spark.sparkContext.defaultParallelism, -(-total // (16 * block)))
    block, part_bytes = sizes(total, block, part_bytes)
    parts = max(1, -(-total // part_bytes))
    table = ws.save_bucketed(blocks(docs, key, text, block), "blocks", "block", n)
    # replies come in the partitioning of the blocks, whose texts stay where they lie
    lists = lambda df, name: df.repartition(n, "block").groupBy("block").agg(F.collect_list(F.struct("part", "payload")).alias(name))
    by_part = lambda df, judge: df.groupBy("part").applyInArrow(judge, _SENT)
    sent = table.select("block", "ids", "texts").mapInArrow(_send_grams(parts), _SENT)
    shared = ws.save(by_part(sent, _judge_grams), "shared", "none")
    one = table.join(lists(shared, "grams"), "block", "left").select("block", "ids", "texts", "grams")
    verdicts = ws.save(by_part(one.mapInArrow(_send_records(parts), _SENT), _judge_records), "verdicts", "none")
    two = one.join(lists(verdicts, "records"), "block", "left").select("block", "ids", "texts", "grams", "records")
    bits = ws.save(by_part(two.mapInArrow(_send_contexts(parts), _SENT), _sort_buckets(LENGTH, GRAM)), "bits", "none")
    out = two.join(lists(bits, "bits"), "block", "left").select("ids", "texts", "grams", "records", "bits")
    return out.mapInArrow(_finish(LENGTH, parts, with_text), "key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept_bytes binary" * with_text).withColumnRenamed("key", key)


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


SQL = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
w AS (SELECT doc_id, unnest(range(n - 49)) AS p, x FROM h WHERE n >= 50),
k AS (SELECT doc_id, p, substr(x, CAST(2 * p + 1 AS INT), 100) AS s FROM w),
m AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS least FROM k),
g AS (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS _, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM m WHERE least < doc_id),
i AS (SELECT doc_id, p, sum(CASE WHEN gap <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS island FROM g),
j AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM i GROUP BY doc_id, island),
c AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM j),
t AS (SELECT c.doc_id, CAST(sum(b - a) AS BIGINT) AS removed, count(*) AS spans, string_agg(substr(x, CAST(2 * before + 1 AS INT), CAST(2 * (a - before) AS INT)), '' ORDER BY a) AS front, max(b) AS last FROM c JOIN h USING (doc_id) GROUP BY c.doc_id)
SELECT h.doc_id, n AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(front, '') || substr(x, CAST(2 * coalesce(last, 0) + 1 AS INT)))) AS kept_sha256 FROM h LEFT JOIN t USING (doc_id)
"""

QUERIES = {"op6_substring_dedup": op6_repeats}
ORACLES = {"op6_substring_dedup": SQL}
