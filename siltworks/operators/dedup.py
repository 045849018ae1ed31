"""Exact and SimHash near duplicates as joins."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..session import ship

#: Keys that let a row meet more than this share of all rows find pairs no faster than comparing all with all.
MEETS = 1 / 64
#: Fingerprints in a block, and blocks there are at least: a task holds two blocks at a time.
BLOCK, BLOCKS = 1 << 15, 12
#: Pairs of a step inside two blocks.
_PAIRS = 1 << 16


def first_seen(df: DataFrame, key: str = "text_sha256", seq: str = "seq") -> DataFrame:
    """(key, first): the least seq of each key; summed before the shuffle, so hot keys cost a row a task."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(seq).alias("first"))


def exact_duplicates(df: DataFrame, key: str = "text_sha256", seq: str = "seq", out: str = "is_duplicate") -> DataFrame:
    """df with a flag for rows whose key an earlier row has; null keys are no duplicates."""
    firsts = first_seen(df, key, seq).withColumnRenamed(key, "__key")
    # rows without a key match nothing; a key of their own keeps them from meeting in one task
    own = F.coalesce(F.col(key), F.concat(F.lit("\0"), F.col(seq).cast("string")))
    return df.join(firsts, own == F.col("__key"), "left").withColumn(out, F.coalesce(F.col(seq) > F.col("first"), F.lit(False))).drop("__key", "first")


def block_keys(fp: Column, threshold: int, match: int) -> Column:
    """array<bigint> of keys, equal in at least one place for fingerprints within the threshold.

    The 64 bits fall into threshold + match blocks.  Bits that differ touch at
    most threshold of them, so `match` blocks agree; every choice of so many
    blocks makes a key.  match 1 gives few short keys, 2 or 3 more and longer
    ones, with fewer chance meetings: N fingerprints meet about
    N * N / 2 ** (64 * match / (threshold + match)) times a key.
    """
    n = threshold + match
    cuts = [64 * k // n for k in range(n + 1)]
    out = []
    for chosen in combinations(range(n), match):
        mask = sum(((1 << (cuts[k + 1] - cuts[k])) - 1) << cuts[k] for k in chosen)
        mask -= (1 << 64) if mask >> 63 else 0
        out.append(fp.bitwiseAND(F.lit(mask).cast("bigint")))
    return F.array(*out)


def near_duplicates(prints: DataFrame, threshold: int = 3, bands: int = 4, seq: str = "seq", fp: str = "fp", match: int = 2) -> DataFrame:
    """(seq) of rows within `threshold` bits of an earlier row's fingerprint.

    Every row that was looked at counts as earlier, duplicates too, so the
    sequential rule is this declarative one, and the keys only serve to find
    the pairs: threshold and bands are checked as a configuration of the rule,
    `match` (see block_keys) should grow with the number of rows.  Equal
    fingerprints are one row of the join, which keeps it free of hot copies.
    Where the threshold leaves only short keys, all pairs are compared, in
    blocks (`near_by_blocks`).
    """
    H.check_bands(threshold, bands)
    rows = prints.select(F.col(seq).alias("seq"), F.col(fp).alias("fp"))
    least = rows.groupBy("fp").agg(F.min("seq").alias("first"))
    n = threshold + match
    if comb(n, match) > MEETS * 2 ** (64 * match / n):
        near = near_by_blocks(least, threshold)
    else:
        near = near_by_keys(least, threshold, match)
    near = near.select("fp").distinct().withColumn("near", F.lit(True))
    flagged = rows.join(least, "fp").join(near, "fp", "left")
    return flagged.where((F.col("seq") > F.col("first")) | F.col("near")).select("seq")


def near_by_keys(least: DataFrame, threshold: int, match: int) -> DataFrame:
    """(fp) of (fp, first) rows within the threshold of one with a lesser first, found by block_keys."""
    keyed = least.select("fp", "first", F.posexplode(block_keys(F.col("fp"), threshold, match)).alias("place", "key"))
    a, b = keyed.alias("a"), keyed.alias("b")
    close = (F.col("a.place") == F.col("b.place")) & (F.col("a.key") == F.col("b.key")) & (F.col("b.first") < F.col("a.first")) & (H.hamming(F.col("a.fp"), F.col("b.fp")) <= threshold)
    # the planner takes the keys for no larger than the rows they are made of, and would send them all to the driver
    return a.hint("merge").join(b.hint("merge"), close, "left_semi").select("fp")


def near_by_blocks(least: DataFrame, threshold: int) -> DataFrame:
    """As near_by_keys, by comparing all pairs.

    Rows are dealt into blocks by hash; a task compares two blocks at a time
    and gives one row for each fingerprint that is near an earlier one.
    """
    ship(least.sparkSession)
    least = least.where("fp IS NOT NULL AND first IS NOT NULL")
    blocks = max(BLOCKS, -(-least.count() // BLOCK))
    rows = least.select("fp", "first", F.pmod(F.xxhash64("fp"), F.lit(blocks)).cast("int").alias("own"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("fp", "first", "own", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left = (pdf["own"] == pdf["i"]).to_numpy()
        a, b = pdf[left], (pdf if pdf["i"].iloc[0] == pdf["j"].iloc[0] else pdf[~left])
        (x, p), (y, q) = ((t["fp"].to_numpy(np.int64).view(np.uint64), t["first"].to_numpy()) for t in (a, b))
        near_x, near_y = np.zeros(len(x), bool), np.zeros(len(y), bool)
        step = max(1, _PAIRS // max(1, len(y)))
        for k in range(0, len(x), step):
            at, to = np.nonzero(np.bitwise_count(x[k : k + step, None] ^ y) <= threshold)
            later = p[k + at] > q[to]
            near_x[k + at[later]] = True
            near_y[to[p[k + at] < q[to]]] = True
        return pd.DataFrame({"fp": np.concatenate([x[near_x], y[near_y]]).view(np.int64)})

    # a number of partitions of its own: little data, and much work
    return rows.repartition(blocks * (blocks + 1) // 2, "i", "j").groupBy("i", "j").applyInPandas(run, "fp bigint")
