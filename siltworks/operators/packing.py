"""Packing tokenised samples into sequences of a fixed length."""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions import values as V
from ..session import Workspace, ship


def problems(samples: DataFrame) -> DataFrame:
    """samples (tokens, source_id[, targets]) with a column `problem`, null where a sample is sound."""
    n = F.size("tokens")
    empty = F.coalesce(n, F.lit(0)) <= 0
    out = F.when(empty, "tokenized sample is empty")
    if "targets" in samples.columns:
        t = F.col("targets")
        out = out.when(t.isNotNull() & (F.size(t) != n), "tokens and targets differ in length").when(t.isNotNull() & F.forall(t, lambda x: x == V.IGNORE_INDEX), "no target to train on")
    return samples.withColumn("problem", out)


def best_fit(lengths: list[tuple[int, str]], capacity: int) -> list[tuple[str, int, int]]:
    """(id, bin, place in the bin): longest first, each into the fullest bin that still holds it.

    Ties go to the smaller id and the lower bin.  A sample longer than the
    capacity gets a bin of its own.
    """
    room: list[tuple[int, int]] = []
    used: list[int] = []
    out = []
    for n, key in sorted(lengths, key=lambda x: (-x[0], x[1])):
        k = bisect_left(room, (n, -1))
        if k == len(room):
            b, free = len(used), capacity
            used.append(0)
        else:
            free, b = room.pop(k)
        out.append((key, b, used[b]))
        used[b] += 1
        if free > n:
            insort(room, (free - n, b))
    return out


def pack(samples: DataFrame, capacity: int, *, allow_overlength: bool = False, shards: int = 1) -> tuple[DataFrame, DataFrame]:
    """Packed sequences and the samples longer than the capacity.

    samples: tokens array<int>, source_id string, targets array<int> or null.
    Packed: shard, bin, tokens, targets, cu_seqlens, source_ids.  Lengths alone
    are packed, in `shards` independent groups; one shard gives the packing of
    the whole set, more bound what a task holds.  Unsound samples, and bins
    that would mix samples with and without targets, stop the query.
    """
    ship(samples.sparkSession)
    if "targets" not in samples.columns:
        samples = samples.withColumn("targets", F.lit(None).cast("array<int>"))
    checked = problems(samples).where(F.when(F.col("problem").isNull(), True).otherwise(F.raise_error("problem").cast("boolean"))).drop("problem")
    checked = checked.withColumns({"n": F.size("tokens"), "shard": F.pmod(F.xxhash64("source_id"), F.lit(shards)).cast("int")})
    over = checked.where(F.col("n") > capacity).select(*samples.columns)
    fit = checked if allow_overlength else checked.where(F.col("n") <= capacity)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = best_fit(list(zip(pdf["n"].astype(int), pdf["source_id"])), capacity)
        return pd.DataFrame([(int(pdf["shard"].iloc[0]), *r) for r in rows], columns=["shard", "source_id", "bin", "place"])

    # ids that occur more than once are told apart by their number among equals
    same = W.Window.partitionBy("shard", "source_id", "n").orderBy("tokens")
    fit = fit.withColumn("source_id_", F.concat(F.col("source_id"), F.lit("\0"), F.row_number().over(same)))
    plan = fit.select("shard", F.col("source_id_").alias("source_id"), "n").groupBy("shard").applyInPandas(run, "shard int, source_id string, bin int, place int").withColumnsRenamed({"source_id": "__id", "shard": "__shard"})
    placed = fit.join(plan, (F.col("source_id_") == F.col("__id")) & (F.col("shard") == F.col("__shard")))
    bins = placed.groupBy("shard", "bin").agg(
        F.array_sort(F.collect_list(F.struct("place", "tokens", "targets", "source_id"))).alias("x"), F.countDistinct(F.col("targets").isNull()).alias("kinds")
    )
    bins = bins.where(F.when(F.col("kinds") == 1, True).otherwise(F.raise_error(F.lit("pretraining and SFT samples cannot share a sequence")).cast("boolean")))
    sizes = F.transform("x", lambda s: F.size(s.tokens))
    packed = bins.select(
        "shard", "bin", F.flatten(F.transform("x", lambda s: s.tokens)).alias("tokens"),
        F.when(F.get("x", F.lit(0)).targets.isNotNull(), F.flatten(F.transform("x", lambda s: s.targets))).alias("targets"),
        F.aggregate(sizes, F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n))).alias("cu_seqlens"),
        F.transform("x", lambda s: s.source_id).alias("source_ids"),
    )
    return packed, over


def running_sums(rows: DataFrame, value: str, group: str, order: str, out: str) -> DataFrame:
    """rows with the sum of value up to each row in the order of its group; rows of one place get the same sum.

    Rows are cut into ranges of (group, order), so that a large group is many
    tasks; a range adds what the ranges before it hold, of which one number a
    range and group is kept.
    """
    ranges = rows.repartitionByRange(group, order).withColumn("__range", F.spark_partition_id())
    ranges = Workspace(rows.sparkSession, "sums").save(ranges, "ranges")
    totals = ranges.groupBy("__range", group).agg(F.sum(value).alias("__sum"))
    before = F.sum("__sum").over(W.Window.partitionBy(group).orderBy("__range").rowsBetween(W.Window.unboundedPreceding, -1))
    totals = totals.select(F.col("__range").alias("__at"), F.col(group).alias("__group"), F.coalesce(before, F.lit(0)).alias("__before"))
    both = ranges.join(F.broadcast(totals), (F.col("__range") == F.col("__at")) & F.col(group).eqNullSafe(F.col("__group")))
    own = F.sum(value).over(W.Window.partitionBy("__range", group).orderBy(order))
    return both.withColumn(out, own + F.col("__before")).select(*rows.columns, out)
