"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1.  Test items are cut into passages of at most ``PASSAGE`` words, half
    overlapping, and every trigram of a passage is a possible seed.  Trigrams
    that more than ``SHARED_TEXTS`` different item texts hold are a common
    prompt: they are no seeds, and words in such trigrams only are not the
    item's own.  A passage without own words counts only where its item has no
    other.
2.  One pass over the corpus counts in how many documents each possible seed
    stands.  Trigrams in at most ``RARE_SHARE`` of the documents (or in
    ``RARE_LEAST``, or in twice as many as the passage's rarest one) are seeds,
    and of every ``RUN`` neighbours the rarest is one whatever its count, so any
    exact run of ``RUN + 2`` words that are the item's own holds a seed,
    however common its words are.
3.  A second pass joins the documents' trigrams to the seeds, lays a window
    around each place where a passage may start, and aligns all windows of a
    slice together (match 2, mismatch -1, gap -1).  The score as a share of the
    best possible one is the similarity; paraphrased and edited copies keep a
    large part of it.  Where a passage has shared words, an alignment in which
    only own words score must reach the bounds as well.

Seeds go to the tasks as arrays.  Their number is bounded: the benchmark is
worked off in blocks of about ``BLOCK_WORDS`` words, each against all
documents.  Words are runs without white space and ASCII punctuation, in lower
case; in scripts without blanks each character is one and counts as half.
Both passes run where the documents lie; only counts are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .workspace import Workspace, documents

PASSAGE, RUN, GRAM = 64, 3, 3
RARE_SHARE, RARE_LEAST = 0.0005, 20
#: A trigram in more item texts than this is a prompt's.
SHARED_TEXTS = 5
BLOCK_WORDS = 100_000
#: A leak has this share of the best score and this score, or the second score
#: whatever its share: 13 words in a row, or as much with gaps and changes.
SIMILARITY, LEAST_SCORE, ENOUGH_SCORE = 0.4, 14, 26
#: Document words by which candidate windows advance.
STRIDE = 64
U = np.uint64
_W = [U(pow(K.BASE, 5 * k + 9, 1 << 64)) for k in range(GRAM)]


def _words(column) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = K.utf8(pc.utf8_lower(column.cast(pa.large_string())))
    return data, offsets


def grams(words: np.ndarray) -> np.ndarray:
    n = len(words) - GRAM + 1
    if n <= 0:
        return np.zeros(0, U)
    return K.mix(words[:n] * _W[0] + words[1 : n + 1] * _W[1] + words[2 : n + 2] * _W[2])


def _item_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Word hashes of texts, where each begins, and how many words make one of a text's: 2 in scripts without blanks."""
    data, offsets = _words(pa.array(texts, pa.string()))
    words, at = K.word_hashes(data, offsets, K.BYTE, K.SPACE_OR_MARK, True)
    alone = np.diff(np.searchsorted(K.lone(data)[0], offsets))
    return words, at, [1 + int(2 * n > k) for n, k in zip(alone.tolist(), np.diff(at).tolist())]


class Block:
    """Passages of some test items and, once counts are known, their seeds."""

    def __init__(self, items: list[tuple[int, str]], shared: np.ndarray | None = None):
        words, at, units = _item_words([t for _, t in items])
        shared = np.zeros(0, U) if shared is None else shared
        self.item, self.words, self.own, self.unit = [], [], [], []
        for (item, _), i, j, unit in zip(items, at[:-1].tolist(), at[1:].tolist(), units):
            text = words[i:j]
            if len(text) < GRAM * unit:
                continue
            g = grams(text)
            own = np.zeros(len(text), bool)
            for k in range(GRAM):
                own[k : k + len(g)] |= ~np.isin(g, shared)
            passages = [(text[k : k + PASSAGE], own[k : k + PASSAGE]) for k in range(0, max(1, len(text) - PASSAGE // 2), PASSAGE // 2)]
            some = [p for p in passages if p[1].sum() >= GRAM]
            for p, o in some or [(p, np.ones(len(p), bool)) for p, _ in passages]:
                self.item.append(item), self.words.append(p), self.own.append(o), self.unit.append(unit)
        self.grams = [grams(w) for w in self.words]
        # a gram is the passage's own if all its words are: those of a prompt are no seeds
        self.seeded = [o[: len(o) - 2] & o[1:-1] & o[2:] & (~np.isin(g, shared) | o.all()) for g, o in zip(self.grams, self.own)]
        self.all = np.unique(np.concatenate([*(g[s] for g, s in zip(self.grams, self.seeded)), np.zeros(0, U)]))
        self.hash, self.passage, self.place = self.all, None, None
        self._table()

    def _table(self) -> None:
        self.table = np.zeros(1 << 16, bool)
        self.table[(self.hash >> U(48)).astype(np.int64)] = True

    def choose(self, count: np.ndarray, docs: int) -> Block:
        """Keep rare grams and the rarest of every RUN neighbours; count is aligned with self.all."""
        h, p, q = [], [], []
        rare = max(RARE_LEAST, RARE_SHARE * docs)
        for n, (g, seeded) in enumerate(zip(self.grams, self.seeded)):
            at = np.flatnonzero(seeded)
            if not len(at):
                continue
            c = count[np.searchsorted(self.all, g[at])]
            near = max(1, len(at) - RUN + 1)
            kept = {k + int(np.argmin(c[k : k + RUN])) for k in range(near)} | set(np.flatnonzero(c <= max(rare, 2 * c.min())).tolist())
            for k in sorted(kept):
                h.append(g[at[k]]), p.append(n), q.append(int(at[k]))
        order = np.argsort(np.array(h, U), kind="stable")
        self.hash, self.passage, self.place = np.array(h, U)[order], np.array(p, np.int64)[order], np.array(q, np.int64)[order]
        self._table()
        return self

    def find(self, g: np.ndarray) -> np.ndarray:
        """Indices of grams that are seeds."""
        k = np.flatnonzero(self.table[(g >> U(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hash, g[k]), len(self.hash) - 1)
        return k[self.hash[at] == g[k]]

    def matches(self, words: np.ndarray, at: np.ndarray) -> list[tuple]:
        """(row, item, similarity, first word, last word) of documents that leak, the best place of each item."""
        if not len(self.hash):
            return []
        g = grams(words)
        k = self.find(g)
        row = np.searchsorted(at, k, "right") - 1
        inside = k + GRAM <= at[row + 1]
        k, row = k[inside], row[inside]
        if not len(k):
            return []
        lo, hi = np.searchsorted(self.hash, g[k], "left"), np.searchsorted(self.hash, g[k], "right")
        n = hi - lo
        seed = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        row, passage = np.repeat(row, n), self.passage[seed]
        begins = np.repeat(k, n) - self.place[seed] - at[row]  # where the passage would start in the document
        windows = np.unique(np.stack([row, passage, np.floor_divide(begins, STRIDE)], 1), axis=0)
        best: dict[tuple, tuple] = {}
        for i in range(0, len(windows), 512):
            some = windows[i : i + 512]
            found = self._align(words, at, some)
            ok = [self._enough(p, raw, len(self.words[p])) for p, (raw, *_) in zip(some[:, 1], found)]
            mixed = [k for k, p in enumerate(some[:, 1]) if ok[k] and not self.own[p].all()]
            for k, (raw, *_) in zip(mixed, self._align(words, at, some[mixed], True) if mixed else []):
                ok[k] = self._enough(some[k, 1], raw, int(self.own[some[k, 1]].sum()))
            for (r, p, _), (_, score, first, last), good in zip(some.tolist(), found, ok):
                key, place = (r, self.item[p]), (score, -first, -last)
                if good and place > best.get(key, (0,)):
                    best[key] = place
        return [(r, item, s, -a, -b) for (r, item), (s, a, b) in sorted(best.items(), key=lambda x: (x[0][0], str(x[0][1])))]

    def _enough(self, passage: int, raw: int, words: int) -> bool:
        """Whether a score is that of a leak, for a passage of so many words that score."""
        unit = self.unit[passage]
        return raw >= ENOUGH_SCORE * unit or raw >= SIMILARITY * 2 * words and raw >= min(LEAST_SCORE * unit, 2 * words)

    def _align(self, words: np.ndarray, at: np.ndarray, windows: np.ndarray, own: bool = False) -> list[tuple]:
        """Smith-Waterman of each window with its passage, all windows a row at a time; with own, other words' matches are worth nothing."""
        n, pad = len(windows), PASSAGE // 4 + GRAM
        width = STRIDE + PASSAGE + 2 * pad
        start = np.maximum(windows[:, 2] * STRIDE - pad, 0)
        length = at[windows[:, 0] + 1] - at[windows[:, 0]]
        place = start[:, None] + np.arange(width)
        text = np.where(place < length[:, None], words[np.minimum(at[windows[:, 0]][:, None] + place, len(words) - 1)], U(0))
        lens = np.array([len(self.words[p]) for p in windows[:, 1]])
        item, worth = np.ones((n, PASSAGE), U), np.full((n, PASSAGE), 2)
        for i, p in enumerate(windows[:, 1]):
            item[i, : lens[i]] = self.words[p]
            if own:
                worth[i, : lens[i]] = 2 * self.own[p]
        ramp = np.arange(width + 1, dtype=np.int32)
        h = np.zeros((n, width + 1), np.int32)
        origin = np.tile(ramp, (n, 1))  # where the alignment that ends in a cell began
        top, first, last = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
        every = np.arange(n)
        for j in range(int(lens.max())):
            step = np.where(text == item[:, j : j + 1], worth[:, j : j + 1], -1).astype(np.int32)
            diagonal, above = h[:, :-1] + step, h[:, 1:] - 1
            best = np.zeros_like(h)
            best[:, 1:] = np.maximum(np.maximum(diagonal, above), 0)
            source = np.tile(ramp, (n, 1))
            source[:, 1:] = np.where((diagonal >= above) & (diagonal > 0), origin[:, :-1], np.where(above > 0, origin[:, 1:], ramp[1:]))
            # gaps along the row: the running maximum of best + column, less the column
            raised = best + ramp
            run = np.maximum.accumulate(raised, axis=1)
            came = np.maximum.accumulate(np.where(raised == run, ramp, 0), axis=1)
            h = run - ramp
            h[j >= lens] = 0
            origin = np.take_along_axis(source, came.astype(np.int64), 1)
            end = h.argmax(axis=1)
            better = h[every, end] > top
            top = np.where(better, h[every, end], top)
            first, last = np.where(better, origin[every, end], first), np.where(better, end - 1, last)
        return list(zip(top.tolist(), (top / (2.0 * lens)).tolist(), (first + start).tolist(), (last + start).tolist()))


def _slices(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = _words(column)
    for i, j in K.slices(offsets):
        words, at = K.word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], K.BYTE, K.SPACE_OR_MARK, True)
        yield i, j, words, at


def _counted(docs: DataFrame, text: str, block: Block) -> Block:
    """Seeds of the block by their document counts over the whole corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(block.all), np.int64)
        rows = 0
        for b in batches:
            rows += b.num_rows
            for _, _, words, at in _slices(b.column(0)):
                if not len(block.all):
                    continue
                g = grams(words)
                k = block.find(g)
                row = np.searchsorted(at, k, "right") - 1
                ok = k + GRAM <= at[row + 1]
                seed = np.searchsorted(block.all, g[k[ok]])
                pair = np.unique(row[ok] * len(block.all) + seed)
                total += np.bincount(pair % len(block.all), minlength=len(block.all))
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(k, -1)), pa.array(np.append(total[k], rows))], ["seed", "docs"])

    sums = docs.select(F.col(text).cast("string")).mapInArrow(run, "seed bigint, docs bigint").groupBy("seed").agg(F.sum("docs").alias("docs"))
    count = np.zeros(len(block.all) + 1, np.int64)
    for r in sums.collect():  # at most one row for each gram of the block; -1 counts the documents
        count[r.seed] = r.docs
    return block.choose(count[:-1], int(count[-1]))


def _shared(ws: Workspace, own: DataFrame) -> DataFrame:
    """(block, gram): the trigrams of each block's item texts that more than SHARED_TEXTS texts of the benchmark hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, at, _ = _item_words(b.column(1).to_pylist())
            for k, (i, j) in enumerate(zip(at[:-1], at[1:])):
                g = np.unique(grams(words[i:j])).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), b.column(0)[k].as_py(), np.int32)), pa.array(g)], ["block", "gram"])

    # one row a text, however many items have it
    texts = own.groupBy("text").agg(F.min("block").alias("block")).select("block", "text")
    held = ws.save(texts.mapInArrow(run, "block int, gram bigint").groupBy("gram", "block").agg(F.count("*").alias("n")), "grams")
    common = held.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > SHARED_TEXTS).select("gram")
    return ws.save(common, "shared")


def blocks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The benchmark in blocks of bounded size, each with seeds chosen by its counts in docs."""
    ws = Workspace(docs.sparkSession, "benchmark")
    own = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item).alias("item"), F.col(item_text).cast("string").alias("text")).distinct()
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // (5 * words)))
    own = ws.save(own.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n)).cast("int")), "items")
    shared = _shared(ws, own)
    for k in range(n):
        rows = own.where(F.col("block") == k).collect()
        mine = Block(sorted(((r.item, r.text) for r in rows), key=str))
        # of the shared trigrams only those of this block's items come here
        known = docs.sparkSession.createDataFrame([(int(x),) for x in mine.all.view(np.int64)], "gram bigint") if len(mine.all) else None
        prompt = [r.gram for r in shared.join(F.broadcast(known), "gram").collect()] if known is not None else []
        yield _counted(docs, text, Block(sorted(((r.item, r.text) for r in rows), key=str), np.array(prompt, np.int64).view(U)) if prompt else mine)


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """(key, item, similarity, first_word, last_word) of every document that holds an item.

    A row for each pair, at the best place in the document (ties: the first).
    Null and empty texts leak nothing, texts of any length are read whole, an
    empty table of either kind gives no row.  Items of fewer than three words
    (six characters in scripts without blanks) are too short to tell a leak and
    are not searched; repeated documents are each returned, repeated items
    count once.  An item column named like the key is named `benchmark_` and
    the name; other columns of either table are not read.
    """
    picked = docs.select(F.col(key).alias("key"), F.col(text).cast("string"))
    kinds = docs.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    out = None
    for block in blocks(docs, benchmark, text, item):

        def run(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i, j, words, at in _slices(b.column(1)):
                    if found := block.matches(words, at):
                        rows, items, score, first, last = zip(*found)
                        yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i).take(pa.array(rows)), *map(pa.array, (items, score, first, last))], ["key", "item", "similarity", "first_word", "last_word"])

        part = picked.mapInArrow(run, f"key {kinds[0]}, item {kinds[1]}, similarity double, first_word bigint, last_word bigint")
        out = part if out is None else out.unionByName(part)
    return out.withColumnsRenamed({"key": key, "item": item if item.lower() != key.lower() else f"benchmark_{item}"})


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """The documents that hold no test item by the rule of `leaks`, with all their columns, whatever their names.

    Null and empty texts stay, repeated rows share their fate, and an empty
    benchmark takes nothing.
    """
    out = docs
    for block in blocks(docs, benchmark, text, item):
        at = docs.columns.index(text)

        def run(batches: Iterator[pa.RecordBatch], block: Block = block, at: int = at) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                for i, _, words, ends in _slices(b.column(at)):
                    keep[[i + m[0] for m in block.matches(words, ends)]] = False
                yield b.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
    return out


def op1_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without test items: all columns of docs, null and empty texts kept, any row order."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op1_benchmark_leaks": op1_leaks}
