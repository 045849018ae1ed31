"""Quotas, seeded sampling, context mixes and work balancing."""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions import values as V
from ..functions.hashing import stable_key
from ..functions.text import context_bucket
from ..session import Workspace, ship


def quotas(weights: DataFrame, total: int, key: str = "source", weight: str = "weight") -> DataFrame:
    """(key, quota): total shared by weight, the rest by largest remainder, ties by key.

    Rows without a positive weight have no share; none at all is an error.
    """
    if total < 0:
        raise ValueError("the total is negative")
    w = weights.where(F.col(weight) > 0).select(F.col(key).cast("string").alias(key), F.col(weight).cast("double").alias("w"))
    whole = W.Window.partitionBy()
    share = w.withColumn("exact", F.lit(float(total)) * F.col("w") / F.sum("w").over(whole)).withColumn("low", F.floor("exact"))
    rank = F.row_number().over(W.Window.orderBy((F.col("exact") - F.col("low")).desc(), key))
    left = F.lit(total) - F.sum("low").over(whole)
    return share.select(key, (F.col("low") + F.when(rank <= left, 1).otherwise(0)).cast("bigint").alias("quota"))


def allocate(weights: Mapping[str, float], total: int) -> dict[str, int]:
    """`quotas` for a small mapping on the driver."""
    if total < 0:
        raise ValueError("the total is negative")
    positive = {str(k): float(v) for k, v in weights.items() if float(v) > 0}
    if not positive:
        raise ValueError("no weight is positive")
    whole = sum(positive.values())
    exact = {k: total * v / whole for k, v in positive.items()}
    out = {k: int(x // 1) for k, x in exact.items()}
    for k in heapq.nsmallest(total - sum(out.values()), exact, key=lambda k: (out[k] - exact[k], k)):
        out[k] += 1
    return out


def least_keys(df: DataFrame, group: list[str], limit: str, key: str = "key", tie: str = "id") -> DataFrame:
    """The rows of each group with the least (key, tie), as many as the column `limit` says.

    Keys are hexadecimal hashes, so their first digits deal a group of any size
    into even buckets.  Counts by bucket tell which are in as a whole; only the
    bucket in which the limit falls is ranked.
    """
    rows = df.withColumn("__b", F.substring(key, 1, 4))
    counts = rows.groupBy(*group, "__b").agg(F.count("*").alias("__n"), F.max(limit).alias("__limit"))
    upto = F.sum("__n").over(W.Window.partitionBy(*group).orderBy("__b").rowsBetween(W.Window.unboundedPreceding, 0))
    counts = counts.withColumn("__upto", upto).withColumn("__before", F.col("__upto") - F.col("__n")).where(F.col("__before") < F.col("__limit"))
    known = rows.join(counts.drop("__n"), [*group, "__b"])
    inside = known.where(F.col("__upto") <= F.col("__limit"))
    edge = known.where(F.col("__upto") > F.col("__limit")).withColumn("__rank", F.row_number().over(W.Window.partitionBy(*group, "__b").orderBy(key, tie)))
    edge = edge.where(F.col("__rank") <= F.col("__limit") - F.col("__before")).drop("__rank")
    return inside.unionByName(edge).drop("__b", "__limit", "__upto", "__before")


def select_mixed(samples: DataFrame, shares: DataFrame, seed: str, *, id_col: str = "id", source: str = "source", method: str = "md5", check: bool = True) -> DataFrame:
    """(id, source, mix_key) in mixed order: of each source the ids with the least key under seed:source.

    Repeated ids of a source stay.  A source with fewer ids than its quota, or
    a negative quota, stops the query unless check is off.
    """
    ship(samples.sparkSession)
    s = samples.select(F.col(id_col).cast("string").alias("id"), F.col(source).cast("string").alias("source"))
    q = shares.select(F.col(source).cast("string").alias("of"), F.col("quota"))
    own = s.join(q, F.col("source") == F.col("of")).drop("of")
    own = own.withColumn("key", stable_key(F.col("id"), F.concat(F.lit(f"{seed}:"), F.col("source")), method))
    taken = least_keys(own, ["source"], "quota")
    if check:
        have = s.groupBy("source").agg(F.count("*").alias("n")).withColumnRenamed("source", "has")
        short = q.join(have, F.col("of") == F.col("has"), "left").where((F.col("quota") < 0) | (F.coalesce("n", F.lit(0)) < F.col("quota")))
        bad = short.agg(F.max(F.concat_ws(" ", "of", F.lit("needs"), F.col("quota").cast("string"), F.lit("and has"), F.coalesce("n", F.lit(0)).cast("string"))).alias("problem"))
        taken = taken.join(F.broadcast(bad)).where(F.when(F.col("problem").isNull(), True).otherwise(F.raise_error(F.col("problem")).cast("boolean"))).drop("problem")
    return taken.select("id", "source", stable_key(F.col("id"), f"{seed}:mix", method).alias("mix_key")).orderBy("mix_key", "id")


def context_order(targets: Mapping[str, int], lengths: Sequence[int] = V.CONTEXT_LENGTHS, eligible: Mapping[str, Sequence[str]] | None = None) -> list[tuple[str, tuple[str, ...]]]:
    """Targets in the order they are filled, each with the buckets it may draw from."""
    if eligible:
        names = sorted(eligible, key=lambda n: (0, int(n[1:-1]), n) if n[:1] == "B" and n[-1:] == "K" and n[1:-1].isdigit() else (1, 0, n))
        may = {n: tuple(eligible[n]) for n in names}
    else:
        names = [f"B{x // 1024}K" for x in sorted(lengths)]
        may = {n: tuple(names[: k + 1]) for k, n in enumerate(names)}
    order = [n for n in names if n in targets] + [n for n in targets if n not in names]
    return [(n, may.get(n, ())) for n in order]


def prefix_context_mix(samples: DataFrame, targets: Mapping[str, int], seed: str, *, id_col: str = "id", bucket: str = "bucket", eligible: Mapping[str, Sequence[str]] | None = None, method: str = "md5", check: bool = True) -> DataFrame:
    """(id, final): disjoint samples of each target length, drawn from buckets up to it, shortest first.

    Each target is a table of its own, from the ids not chosen before; ids are
    taken once however often they occur.
    """
    ws = Workspace(samples.sparkSession, "prefix-mix")
    ids = samples.select(F.col(id_col).cast("string").alias("id"), F.col(bucket).alias("bucket"))
    out = None
    for name, buckets in context_order(targets, eligible=eligible):
        n = int(targets[name])
        if n < 0:
            raise ValueError(f"the target of {name} is negative")
        may = ids.where(F.col("bucket").isin(*buckets) if buckets else F.lit(False)).select("id").distinct()
        if out is not None:
            may = may.join(out.select("id"), "id", "left_anti")
        keyed = may.select("id", F.lit(n).alias("limit"), F.lit(name).alias("final"), stable_key(F.col("id"), f"{seed}:{name}", method).alias("key"))
        got = ws.save(least_keys(keyed, ["final"], "limit").select("id", "final"), name)
        if check and (have := got.count()) < n:
            raise ValueError(f"{name} needs {n} and has {have}")
        out = got if out is None else out.unionByName(got)
    return out if out is not None else ids.select("id", F.lit("").alias("final")).limit(0)


def balance(units: list[tuple[str, int]], workers: int) -> list[list[tuple[str, int]]]:
    """Longest processing time first: each unit, heaviest first, to the least loaded worker.

    Ties go to the smaller key and the lower worker; negative weights add no load.
    """
    if workers <= 0:
        raise ValueError("there must be a worker")
    loads = [(0, w) for w in range(workers)]
    out: list[list[tuple[str, int]]] = [[] for _ in range(workers)]
    for key, weight in sorted(units, key=lambda u: (-u[1], u[0])):
        load, w = heapq.heappop(loads)
        out[w].append((key, weight))
        heapq.heappush(loads, (load + max(0, int(weight)), w))
    return out


def balance_units(units: DataFrame, workers: int, key: str = "key", weight: str = "weight") -> DataFrame:
    """(key, weight, worker) by `balance`; units are a planner's list, brought to one task."""
    if workers <= 0:
        raise ValueError("there must be a worker")
    ship(units.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(k, n, w) for w, own in enumerate(balance(list(zip(pdf["key"], pdf["weight"].astype(int))), workers)) for k, n in own]
        return pd.DataFrame(rows, columns=["key", "weight", "worker"])

    u = units.select(F.col(key).cast("string").alias("key"), F.col(weight).cast("bigint").alias("weight"))
    return u.withColumn("__all", F.lit(1)).groupBy("__all").applyInPandas(run, "key string, weight bigint, worker int")


def bucket_samples(tokens: DataFrame, n: str = "n_tokens", lengths: Sequence[int] = V.CONTEXT_LENGTHS) -> DataFrame:
    return tokens.withColumn("bucket", context_bucket(F.col(n), lengths))
