"""Quality rules: base counts and a linear-chain CRF over lines.

The base rules count words and repeats exactly.  The verdict comes from a
conditional random field: each line that has a word gets features, Viterbi
decoding marks it content or boilerplate, and the words of content lines as a
share of all words decide whether the document stays.

Training sees at most ``TRAIN_DOCS`` labelled documents (those of the smallest
doc_id hashes, so the sample grows no further with the corpus).  Tasks read
their texts whole and give ``TRAIN_LINES`` lines in a row of each, from a place
that the doc_id's hash chooses; only the lines' features reach the driver, which
fits by gradient ascent on the conditional likelihood.  Every line of a document
carries the document's label.  Everything else is one pass over the documents
without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import documents, ship

#: Labelled documents the CRF is fitted on, and lines in a row of each, from anywhere in its text.
TRAIN_DOCS, TRAIN_LINES = 1500, 40
#: Least share of a document's words in content lines.
MIN_CONTENT_SHARE = 0.5
WORD = re.compile("[^\\x20\\x09-\\x0D]+")
SYMBOLS = "#*$%&|<>"
#: Classes of characters that the features count: letters, capitals, digits, symbols, pipes, tag marks.
_CLASSES = tuple(map(re.compile, (r"[^\W\d_]", "[A-ZÀ-ÖØ-Þ]", r"\d", "[#*$%&|<>]", "[|]", "<", ">")))
_PLANE = 1 << 16
FEATURES = ("bias", "short", "long", "symbols", "pipes", "upper", "digits", "repeat", "closed", "rare_alpha", "bang", "few_distinct", "first", "markup")


def line_words(text: str) -> list[tuple[str, list[str]]]:
    return [(line, w) for line in text.split("\n") if (w := WORD.findall(line))]


def _class_bits(chars: str) -> np.ndarray:
    out = np.zeros(len(chars), np.uint8)
    for k, pattern in enumerate(_CLASSES):
        for m in pattern.finditer(chars):
            out[m.start()] |= 1 << k
    return out


@lru_cache(maxsize=1)
def _plane_bits() -> np.ndarray:
    return _class_bits("".join(map(chr, range(_PLANE))))


def class_counts(lines: list[str]) -> np.ndarray:
    """How many characters of each class each line has; lines are not empty."""
    code = np.frombuffer("\n".join(lines).encode("utf-32-le"), np.uint32)
    bits = _plane_bits()[np.minimum(code, _PLANE - 1)]
    if len(far := np.flatnonzero(code >= _PLANE)):
        bits[far] = _class_bits("".join(map(chr, code[far].tolist())))
    starts = np.cumsum([0, *(len(line) + 1 for line in lines[:-1])])
    return np.stack([np.add.reduceat(bits >> k & 1, starts, dtype=np.int64) for k in range(len(_CLASSES))])


def features(lines: list[tuple[str, list[str]]]) -> np.ndarray:
    """One row of FEATURES for each line; all within 0 and 1."""
    if not lines:
        return np.zeros((0, len(FEATURES)))
    texts = [line for line, _ in lines]
    alpha, upper, digits, symbols, pipes, left, right = class_counts(texts)
    chars, n = np.array([len(t) for t in texts]), np.array([len(w) for _, w in lines])
    first: dict[str, int] = {}
    for k, t in enumerate(texts):
        first.setdefault(t, k)
    few = lambda x: np.minimum(1, x)
    return np.stack([
        np.ones(len(n)), n < 4, n > 12, few(4 * symbols / n), few(4 * pipes / n), upper / np.maximum(alpha, 1),
        few(4 * digits / chars), [first[t] < k for k, t in enumerate(texts)], [w[-1][-1] in ".!?:;\"'…。！？" for _, w in lines], 1 - alpha / chars,
        few(2 * np.array([t.count("!!") for t in texts]) / n), 1 - np.array([len(set(w)) for _, w in lines]) / n, np.arange(len(n)) == 0, (left > 0) & (right > 0),
    ], 1).astype(float)


class LineCrf:
    """Two labels, 0 boilerplate and 1 content, with a 2x2 transition matrix."""

    def __init__(self, weights: np.ndarray | None = None, transitions: np.ndarray | None = None):
        self.weights = np.zeros((len(FEATURES), 2)) if weights is None else weights
        self.transitions = np.zeros((2, 2)) if transitions is None else transitions

    def marginals(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label marginals of each line and pair marginals of neighbours."""
        n, t = len(scores), self.transitions
        a, b = np.zeros((n, 2)), np.zeros((n, 2))
        a[0] = scores[0]
        for k in range(1, n):
            a[k] = scores[k] + np.logaddexp(a[k - 1, 0] + t[0], a[k - 1, 1] + t[1])
        for k in range(n - 2, -1, -1):
            x = scores[k + 1] + b[k + 1]
            b[k] = np.logaddexp(t[:, 0] + x[0], t[:, 1] + x[1])
        z = np.logaddexp(*a[-1])
        pair = np.exp(a[:-1, :, None] + t + (scores[1:] + b[1:])[:, None, :] - z)
        return np.exp(a + b - z), pair

    def fit(self, docs: list[np.ndarray], labels: list[np.ndarray], rounds: int = 40, rate: float = 2.0, decay: float = 1e-3) -> LineCrf:
        for _ in range(rounds):
            gw, gt, n = np.zeros_like(self.weights), np.zeros((2, 2)), 0
            for x, y in zip(docs, labels):
                node, pair = self.marginals(x @ self.weights)
                gw += x.T @ (np.eye(2)[y] - node)
                gt -= pair.sum(0)
                np.add.at(gt, (y[:-1], y[1:]), 1)
                n += len(y)
            self.weights += rate * (gw / max(n, 1) - decay * self.weights)
            self.transitions += rate * (gt / max(n, 1) - decay * self.transitions)
        return self

    def viterbi(self, scores: np.ndarray) -> list[int]:
        """The likeliest labels; of equals, content."""
        (t00, t01), (t10, t11) = self.transitions.tolist()
        a0 = a1 = 0.0
        back = []
        for k, (s0, s1) in enumerate(scores.tolist()):
            if k:
                x0, x1, y0, y1 = a0 + t00, a1 + t10, a0 + t01, a1 + t11
                back.append((x1 >= x0, y1 >= y0))
                a0, a1 = max(x0, x1) + s0, max(y0, y1) + s1
            else:
                a0, a1 = s0, s1
        label = int(a1 >= a0)
        out = [label] if len(scores) else []
        for b in reversed(back):
            label = int(b[label])
            out.append(label)
        return out[::-1]


def _train_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of TRAIN_LINES lines in a row of each whole text; the hash `pick` says which."""
    for b in batches:
        out = []
        for key, quality, pick, text in zip(*b.columns):
            lines = line_words(text.as_py() or "")
            if lines:
                at = pick.as_py() % -(-len(lines) // TRAIN_LINES) * TRAIN_LINES
                out.append((key, quality, features(lines)[at : at + TRAIN_LINES].tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([x.as_py() for x in c], t) for c, t in zip(list(zip(*out))[:2] or [[], []], b.schema.types)] + [pa.array([x[2] for x in out], pa.binary())], ["doc_id", "quality", "x"])


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> LineCrf:
    """Fit on at most `most` labelled documents, `TRAIN_LINES` lines of each.

    With no label of one kind, nothing is boilerplate; texts that are null or
    blank teach nothing; of repeated ids at most twice `most` rows are taken.
    """
    ship(docs.sparkSession)
    picked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most)
    rows = docs.join(F.broadcast(picked), "doc_id").select("doc_id", "quality", F.xxhash64("doc_id", F.lit("lines")).alias("pick"), "text")
    rows = rows.mapInArrow(_train_lines, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, quality int, x binary")
    rows = rows.orderBy("doc_id", "quality", "x").limit(2 * most).select("quality", "x").collect()
    xs = [np.frombuffer(r.x).reshape(-1, len(FEATURES)) for r in rows]
    ys = [np.full(len(x), r.quality) for x, r in zip(xs, rows)]
    if len({r.quality for r in rows}) < 2:
        return LineCrf(np.zeros((len(FEATURES), 2)), np.zeros((2, 2)))
    return LineCrf().fit(xs, ys)


def repeated_words(words: list[str]) -> int:
    """Words inside a 3-word window that the text has twice or more."""
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == len(grams):
        return 0
    seen: set = set()
    twice: set = set()
    for g in grams:
        (twice if g in seen else seen).add(g)
    n = end = 0
    for i, g in enumerate(grams):
        if g in twice:
            n += i + 3 - max(i, end)
            end = i + 3
    return n


def judge(text: str | None, crf: LineCrf, share: float = MIN_CONTENT_SHARE) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_words, kept."""
    lines = line_words(text or "")
    words = [w for _, ws in lines for w in ws]
    n = len(words)
    symbols = sum(map((text or "").count, SYMBOLS))
    dup = len(lines) - len({line for line, _ in lines})
    repeats = repeated_words(words)
    failed = n < 50 or 100 * repeats > 50 * n
    marked = crf.viterbi(features(lines) @ crf.weights) if lines else []
    content = sum(len(ws) for (_, ws), m in zip(lines, marked) if m)
    return n, sum(map(len, words)), symbols, dup, repeats, failed, content, not failed and content >= share * n


SCHEMA = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, content_words bigint, kept boolean"
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
_TYPES = [pa.bool_() if x.endswith("boolean") else pa.int64() for x in SCHEMA.split(", ")]


def assess(docs: DataFrame, crf: LineCrf, text: str = "text", keep: tuple[str, ...] = ("doc_id",), share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """The columns of `keep` and SCHEMA for every document, by one pass without a shuffle.

    Null or blank text has no words and fails; repeated rows are judged each,
    texts of any length whole; an empty table gives no row; ties of the decoder
    go to content.  Columns of `keep` named like a result are refused.
    """
    ship(docs.sparkSession)
    if clash := {c.lower() for c in keep} & set(_NAMES):
        raise ValueError(f"columns named like results: {sorted(clash)}")
    picked = docs.select(*(F.col(c) for c in keep), F.col(text).alias("__text"))
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                got = list(zip(*(judge(t, crf, share) for t in part.column(len(keep)).to_pylist())))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *(pa.array(v, k) for v, k in zip(got, _TYPES))], [*keep, *_NAMES])

    return picked.mapInArrow(run, f"{out}, {SCHEMA}")


def _crf(spark: SparkSession, sf_dir: str) -> LineCrf:
    return train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(documents(spark, sf_dir), _crf(spark, sf_dir))


def keep_good(docs: DataFrame, crf: LineCrf, text: str = "text", share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """The documents that `assess` keeps, with all their columns, whatever their names."""
    ship(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                yield part.filter(pa.array([judge(t, crf, share)[-1] for t in part.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the CRF keep, with all columns; null and blank texts fail the rules."""
    return keep_good(docs, _crf(spark, sf_dir))


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and base verdict of op10, which SQL can check."""
    return assess(documents(spark, sf_dir), LineCrf()).drop("content_words", "kept")


BASE_SQL = """
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM w)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(ws) < 50 OR 100 * coalesce(c.n, 0) > 50 * len(ws) AS base_failed
FROM w JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)
"""

QUERIES = {"op10_quality_rules": op10_quality, "quality_base_counts": quality_base_counts}
ORACLES = {"quality_base_counts": BASE_SQL}
