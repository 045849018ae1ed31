"""Tokenizers: training on word counts, encoding, decoding and compression reports."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions import values as V
from ..functions.text import strip_py
from ..session import Workspace, ship
from ..sources.readers import corpus_files, numbered, read_records
from ..sources.sinks import write_json
from . import bpe

MODEL_TYPES = ("bpe", "wordpiece", "unigram")
#: Bytes of texts up to which the library's trainer reads them in the driver.
SMALL = 1 << 25
_SPACE = "▁"
_LOADED: dict = {}


def create(model_type: str = "bpe", vocab_size: int = 65536, special_tokens=V.SPECIAL_TOKENS):
    """An untrained tokenizer and its trainer.

    bpe works on bytes with the pre-tokenising pattern of byte-level models and
    no leading blank; the others mark blanks and always begin with one.
    """
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers, trainers

    special = list(special_tokens)
    if model_type == "bpe":
        t = Tokenizer(models.BPE(unk_token=V.UNKNOWN_TOKEN))
        trainer = trainers.BpeTrainer(vocab_size=vocab_size, special_tokens=special, initial_alphabet=pre_tokenizers.ByteLevel.alphabet(), min_frequency=2, show_progress=False)
        t.pre_tokenizer, t.decoder = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True), decoders.ByteLevel()
    elif model_type in MODEL_TYPES:
        if model_type == "wordpiece":
            t = Tokenizer(models.WordPiece(unk_token=V.UNKNOWN_TOKEN))
            trainer = trainers.WordPieceTrainer(vocab_size=vocab_size, special_tokens=special, show_progress=False)
        else:
            t = Tokenizer(models.Unigram())
            trainer = trainers.UnigramTrainer(vocab_size=vocab_size, special_tokens=special, unk_token=V.UNKNOWN_TOKEN, show_progress=False)
        t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=_SPACE, prepend_scheme="always")
        t.decoder = decoders.Metaspace(replacement=_SPACE, prepend_scheme="always")
    else:
        raise ValueError(f"unknown model type {model_type!r}")
    return t, trainer


def train(texts: DataFrame, text: str = "text", model_type: str = "bpe", vocab_size: int = 65536, special_tokens=V.SPECIAL_TOKENS, max_samples: int | None = None):
    """Train on a table's texts: all, or max_samples of them.

    Of a byte-level model's texts above SMALL bytes only counts of distinct
    words come to the driver (`bpe.learn`, which makes the same merges); other
    texts are streamed there a partition at a time.
    """
    t, trainer = create(model_type, vocab_size, special_tokens)
    rows = texts.select(F.col(text)).where(F.length(text) > 0)
    rows = rows.limit(max_samples) if max_samples else rows
    if model_type == "bpe" and (rows.agg(F.sum(F.octet_length(text))).first()[0] or 0) > SMALL:
        from tokenizers import models

        vocab, merges = bpe.learn(rows, text, vocab_size, list(special_tokens))
        t.model = models.BPE(vocab, merges, unk_token=V.UNKNOWN_TOKEN)
        t.add_special_tokens(list(special_tokens))
        return t
    t.train_from_iterator((r[0] for r in rows.toLocalIterator()), trainer=trainer)
    return t


def save(tokenizer, folder: str) -> None:
    os.makedirs(folder, exist_ok=True)
    tokenizer.save(os.path.join(folder, "tokenizer.json"))
    write_json({"model_type": type(tokenizer.model).__name__, "vocab_size": tokenizer.get_vocab_size()}, os.path.join(folder, "tokenizer_config.json"))


def load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(os.path.join(path, "tokenizer.json") if os.path.isdir(path) else path)


def _tokenizer(state: str):
    from tokenizers import Tokenizer

    if state not in _LOADED:
        _LOADED.clear()
        _LOADED[state] = Tokenizer.from_str(state)
    return _LOADED[state]


def encode(texts: DataFrame, tokenizer, text: str = "text", out: str = "tokens") -> DataFrame:
    """texts with array<int> token ids; the tokenizer is read once in each Python worker."""
    ship(texts.sparkSession)
    state = texts.sparkSession.sparkContext.broadcast(tokenizer.to_str())

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = _tokenizer(state.value)
        for s in batches:
            rows = s.tolist()
            for k in range(0, len(rows), 64):
                coded = iter(t.encode_batch_fast([x for x in rows[k : k + 64] if x is not None]))
                rows[k : k + 64] = [None if x is None else np.array(next(coded).ids, np.int32) for x in rows[k : k + 64]]
            yield pd.Series(rows, dtype=object)

    return texts.withColumn(out, ids(F.col(text)))


def decode(tokens: DataFrame, tokenizer, ids: str = "tokens", out: str = "text") -> DataFrame:
    ship(tokens.sparkSession)
    state = tokens.sparkSession.sparkContext.broadcast(tokenizer.to_str())

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        t = _tokenizer(state.value)
        return pd.Series([None if x is None else t.decode(np.asarray(x).tolist()) for x in s], dtype=object)

    return tokens.withColumn(out, run(F.col(ids)))


def tokenize(texts: DataFrame, tokenizer, text: str = "text", seq: str | None = None, stem: str = "part") -> DataFrame:
    """(source_id, tokens, n_tokens, source): source_id is the id, or the source_id, or stem:number."""
    own = [F.col(c).cast("string") for c in ("id", "source_id") if c in texts.columns]
    texts = texts.where(F.length(text) > 0)
    texts = texts.withColumn("__n", F.col(seq)) if seq else numbered(texts, "__n")
    name = F.coalesce(*(F.nullif(c, F.lit("")) for c in own), F.concat(F.lit(f"{stem}:"), F.col("__n").cast("string")))
    source = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in texts.columns else F.lit("")
    rows = encode(texts.withColumns({"__id": name, "__source": source}), tokenizer, text)
    return rows.select(F.col("__id").alias("source_id"), "tokens", F.size("tokens").alias("n_tokens"), F.col("__source").alias("source"))


def tokenize_files(spark: SparkSession, tokenizer, paths: list[str], text: str | None = "text", max_files: int = 0, max_tokens: int = 0) -> DataFrame:
    """(source_id, tokens, n_tokens, source, file) of files and folders, in path order until a limit is reached; 0 is no limit.

    A record without an id or source gets them from its file's name and its
    number there.  Files are encoded some at a time where tokens are limited:
    so many that their bytes could make the rest; the file that reaches the
    limit is in.
    """
    files = corpus_files(spark, paths).orderBy("path")
    left = [(r.path, r.size) for r in (files.limit(max_files) if max_files else files).collect()]
    if not left:
        raise FileNotFoundError(f"no file to read in {paths}")
    ws = Workspace(spark, "tokenize")
    out, had, k = None, 0, 0
    while left and (not max_tokens or had < max_tokens):
        n = len(left)
        if max_tokens:
            sums, n = 0, 0
            while n < len(left) and (n == 0 or sums < 4 * (max_tokens - had)):
                sums, n = sums + left[n][1], n + 1
        rows = read_records(spark, [p for p, _ in left[:n]], text)
        stem = F.regexp_extract("file", "([^/]+?)(?:[.][^./]*)?$", 1)
        rows = rows.select(F.coalesce("source_id", F.concat(stem, F.lit(":"), F.col("number").cast("string"))).alias("__id"), F.coalesce("source", stem).alias("source"), "file", "text")
        part = encode(rows, tokenizer, "text").select(F.col("__id").alias("source_id"), "tokens", F.size("tokens").alias("n_tokens"), "source", "file")
        if max_tokens:
            part = ws.save(part, f"part{k}")
            per_file = part.groupBy("file").agg(F.sum("n_tokens").alias("tokens"))
            part = part.join(files_within(per_file, max_tokens=max_tokens - had).select("file"), "file", "left_semi").select(*part.columns)
            had += part.agg(F.sum("n_tokens")).first()[0] or 0
        out = part if out is None else out.unionByName(part)
        left, k = left[n:], k + 1
    return out


def totals(tokenized: DataFrame) -> DataFrame:
    """One row: records and tokens."""
    return tokenized.agg(F.count("*").alias("records"), F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("bigint").alias("tokens"))


def files_within(per_file: DataFrame, max_files: int | None = None, max_tokens: int | None = None) -> DataFrame:
    """(file, tokens) rows in file order until a limit is reached; the file that reaches it is in."""
    order = W.Window.orderBy("file")
    df = per_file.withColumns({"__n": F.row_number().over(order), "__before": F.coalesce(F.sum("tokens").over(order.rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0))})
    if max_files is not None:
        df = df.where(F.col("__n") <= max_files)
    if max_tokens is not None:
        df = df.where(F.col("__before") < max_tokens)
    return df.drop("__n", "__before")


def _uses(texts: DataFrame, tokenizer, names: list[str]) -> DataFrame:
    """(names, id, n): how often each entry is used in a batch's texts, so that no token leaves its task."""
    ship(texts.sparkSession)
    state = texts.sparkSession.sparkContext.broadcast(tokenizer.to_str())
    size = tokenizer.get_vocab_size()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(state.value)
        for b in batches:
            group = pa.Table.from_batches([b]).append_column("__row", pa.array(np.arange(b.num_rows))).group_by(names).aggregate([("__row", "list")]) if names else None
            for k, rows in enumerate(group.column("__row_list").to_pylist() if names else [list(range(b.num_rows))]):
                count = np.zeros(size, np.int64)
                texts = b.column(len(names)).take(pa.array(rows, pa.int64())).to_pylist()
                for i in range(0, len(texts), 64):
                    for x in t.encode_batch_fast(texts[i : i + 64]):
                        count += np.bincount(x.ids, minlength=size) if len(x.ids) > size // 8 else 0
                        if len(x.ids) <= size // 8:
                            np.add.at(count, x.ids, 1)
                used = np.flatnonzero(count)
                own = [pa.repeat(group.column(n)[k], len(used)) for n in names]
                yield pa.RecordBatch.from_arrays([*own, pa.array(used, pa.int32()), pa.array(count[used])], [*names, "id", "n"])

    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in texts.schema.fields[:-1])
    return texts.mapInArrow(run, head + "id int, n bigint")


def compression(texts: DataFrame, tokenizer, text: str = "text", by: str | None = None, max_samples: int | None = None, order: str | None = None) -> DataFrame:
    """Bytes, characters and tokens of the non-blank texts, and how much of the vocabulary they use.

    One row, or one a value of `by`.  With max_samples only so many texts of
    each group are measured, in the order given.  Groups without a token have
    no row.
    """
    group = [F.col(by).alias(by)] if by else []
    names = [by] if by else []
    blank = F.length(strip_py(F.coalesce(F.col(text), F.lit("")))) == 0
    rows = texts.select(*group, F.col(text).alias("__text"), *([F.col(order).alias("__order")] if order else []))
    empty = rows.groupBy(*names).agg(F.count_if(F.length(strip_py(F.coalesce("__text", F.lit("")))) == 0).alias("empty_samples"))
    full = texts.where(~blank).select(*group, F.col(text).alias("__text"), *([F.col(order).alias("__order")] if order else []))
    if max_samples:
        rank = F.row_number().over(W.Window.partitionBy(*names).orderBy("__order" if order else F.xxhash64("__text")))
        full = full.withColumn("__rank", rank).where(F.col("__rank") <= max_samples)
    size = tokenizer.get_vocab_size()
    volumes = full.groupBy(*names).agg(F.count("*").alias("samples"), F.sum(F.octet_length("__text")).alias("total_bytes"), F.sum(F.length("__text")).alias("total_chars"))
    # texts are encoded once: all token figures come from the counts by id, a row for each entry used
    used = _uses(full.select(*names, "__text"), tokenizer, names).groupBy(*names, "id").agg(F.sum("n").alias("n"))
    used = Workspace(texts.sparkSession, "tokens").save(used, "used")
    total = used.groupBy(*names).agg(F.sum("n").alias("total_tokens"))
    top = used.withColumn("__r", F.row_number().over(W.Window.partitionBy(*names).orderBy(F.col("n").desc(), "id"))).where("__r <= 10")
    top = top.groupBy(*names).agg(F.transform(F.array_sort(F.collect_list(F.struct("__r", "id", "n"))), lambda x: F.struct(x.id.alias("id"), x.n.alias("count"))).alias("top_10_tokens"))
    distinct = used.groupBy(*names).agg(F.count("*").alias("used_tokens"))
    if by:
        out = volumes.join(total, by).join(distinct, by).join(top, by).join(empty, by, "left")
    else:
        out = volumes.join(F.broadcast(total)).join(F.broadcast(distinct)).join(F.broadcast(top)).join(F.broadcast(empty))
    t = F.col("total_tokens")
    return out.where(t > 0).select(
        *names, "samples", "total_bytes", "total_chars", "total_tokens", F.round(F.col("total_bytes") / t, 2).alias("bytes_per_token"), F.round(F.col("total_chars") / t, 2).alias("chars_per_token"),
        F.round(t / F.col("samples"), 1).alias("tokens_per_sample"), F.lit(size).alias("vocab_size"), F.round(F.col("used_tokens") / size, 4).alias("vocab_utilization"), "used_tokens", "empty_samples", "top_10_tokens",
    )


def compare(texts: DataFrame, tokenizers: dict[str, object], text: str = "text") -> DataFrame:
    """`compression` of each tokenizer on one corpus, side by side."""
    out = None
    for name, t in tokenizers.items():
        part = compression(texts, t, text).withColumn("tokenizer", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def named_config(configs: list[dict], name: str) -> dict:
    for c in configs:
        if c.get("name") == name:
            return c
    raise ValueError(f"no configuration {name!r}")


def with_template(folder: str, template: str) -> None:
    """Add a chat template to a saved tokenizer's configuration."""
    path = os.path.join(folder, "tokenizer_config.json")
    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    write_json(config | {"chat_template": template}, path)


def out_of_vocabulary(texts: DataFrame, tokenizer, text: str = "text") -> DataFrame:
    """One row: unknown tokens among all, and their share."""
    unk = tokenizer.token_to_id(V.UNKNOWN_TOKEN)
    coded = encode(texts.where(F.length(text) > 0), tokenizer, text, "__ids")
    n = F.sum(F.size("__ids"))
    bad = F.sum(F.size(F.filter("__ids", lambda x: x == (unk if unk is not None else -1))))
    return coded.agg(n.cast("bigint").alias("total_tokens"), bad.cast("bigint").alias("unknown_tokens"), F.round(bad / n, 6).alias("unknown_rate"))

