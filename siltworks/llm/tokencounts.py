"""Token counts: the exact histogram of encoded lengths and its suffix sums.

Documents are encoded once, where they lie, and summed by encoded length
before the shuffle.  Everything asked of lengths is then read off the
histogram: how many documents and tokens have at least n tokens, what a limit
of n tokens leaves (``truncated_tokens``), and quantiles.  Suffix sums run in
two steps, over blocks of lengths and inside a block, so no task gets the
whole histogram.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .workspace import documents, ship, Workspace

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Splits text before the merges of rank files; a fixed value of their format.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Lengths in a block of the suffix sums.
BLOCK = 256


class Counter:
    """Counts a text's tokens: rank files by tiktoken, .json by tokenizers, .model by sentencepiece."""

    def __init__(self, path: str, data: bytes | None = None):
        self.path, self.data, self._count = path, data, None

    def _load(self):
        data = self.data
        if data is None:
            with open(self.path, "rb") as f:
                data = f.read()
        if self.path.endswith(".json"):
            from tokenizers import Tokenizer

            t = Tokenizer.from_buffer(data)
            t.encode_special_tokens = True
            return lambda x: len(t.encode(x, add_special_tokens=False).ids)
        if self.path.endswith(".model"):
            import sentencepiece

            return lambda x, p=sentencepiece.SentencePieceProcessor(model_proto=data): len(p.encode(x, num_threads=1))
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        e = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda x: len(e.encode_ordinary(x))

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        if self._count is None:
            self._count = self._load()
        return self._count(text)

    def __reduce__(self):
        return Counter, (self.path,)


_COUNTERS: dict[str, Counter] = {}


def counter(path: str, data: bytes | None = None) -> Counter:
    """The counter of a vocabulary file, loaded once in each Python worker."""
    return _COUNTERS.setdefault(path, Counter(path, data))


def lengths(docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text") -> DataFrame:
    """(n_tokens, docs) partly summed: a row for each length and batch of rows.

    The driver reads the vocabulary, a file of some MB at most whatever the
    corpus, and sends it to the tasks, so executors need no file.
    """
    ship(docs.sparkSession)
    with open(vocabulary, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary, held.value)
        for b in batches:
            n = pa.array([count(t) for t in b.column(0).to_pylist()], pa.int64())
            c = pc.value_counts(n)
            yield pa.RecordBatch.from_arrays([c.field("values"), c.field("counts")], ["n_tokens", "docs"])

    return docs.select(F.col(text).cast("string")).mapInArrow(run, "n_tokens bigint, docs bigint")


def histogram(docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text") -> DataFrame:
    """One row for each encoded length that occurs.

    n_tokens and docs; docs_at_least and tokens_at_least, of documents with so
    many tokens or more; truncated_tokens, what is left of all documents under
    a limit of n_tokens; quantile, the share of documents with at most n_tokens.
    Null and empty texts have 0 tokens, texts of any length are encoded whole,
    repeated rows and rows without a key count each, an empty table gives no
    rows; other columns are not read.
    """
    ws = Workspace(docs.sparkSession, "tokens")
    h = ws.save(lengths(docs, vocabulary, text).groupBy("n_tokens").agg(F.sum("docs").alias("docs")), "histogram")
    h = h.withColumn("tokens", F.col("n_tokens") * F.col("docs")).withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    later = W.Window.orderBy(F.col("block").desc()).rowsBetween(W.Window.unboundedPreceding, -1)
    blocks = h.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    blocks = blocks.select(
        "block", *(F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_after") for c in "dt"), *(F.sum(c).over(W.Window.partitionBy()).alias(f"{c}_all") for c in "dt")
    )
    inside = W.Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
    out = h.join(blocks, "block").select(
        "n_tokens", "docs",
        (F.sum("docs").over(inside) + F.col("d_after")).alias("docs_at_least"),
        (F.sum("tokens").over(inside) + F.col("t_after")).alias("tokens_at_least"),
        "d_all", "t_all",
    )
    n = F.col("n_tokens")
    return out.select(
        "n_tokens", "docs", "docs_at_least", "tokens_at_least",
        (F.col("t_all") - F.col("tokens_at_least") + n * F.col("docs_at_least")).alias("truncated_tokens"),
        ((F.col("d_all") - F.col("docs_at_least") + F.col("docs")) / F.col("d_all")).alias("quantile"),
    )


def truncated_total(hist: DataFrame, limit: int) -> DataFrame:
    """One row: tokens left under a limit, from the histogram alone."""
    return hist.agg(F.coalesce(F.sum(F.least("n_tokens", F.lit(limit)) * F.col("docs")), F.lit(0)).alias("tokens"))


def quantile(hist: DataFrame, share: float) -> DataFrame:
    """One row: the least length that at least this share of documents does not exceed."""
    return hist.where(F.col("quantile") >= share).agg(F.min("n_tokens").alias("n_tokens"))


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(documents(spark, sf_dir))


QUERIES = {"op3_token_counts": op3_tokens}
