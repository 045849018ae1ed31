"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace


#: Keys that a table can have with more than a share of 1 / HOT_KEYS of its rows; so many rows are sent to every task at most.
HOT_KEYS = 10_000


def join_hot(rows: DataFrame, single: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Inner join with a table of one row a key, whose weight says how many of the `total` rows have the key.

    The few keys with a large share of the rows go to the rows, all others meet
    them by a shuffle, so no key makes a large task.
    """
    hot = F.col(weight) * HOT_KEYS > total
    top = F.broadcast(single.where(hot).drop(weight))
    return rows.join(top, key).unionByName(rows.join(top.select(key), key, "left_anti").join(single.where(~hot).drop(weight), key))


def components(ws: Workspace, edges: DataFrame, name: str, rounds: int = 40) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the least node of its component.

    Each round points nodes at smaller neighbours until all edges are stars
    around the least node; the number of rounds grows with the logarithm of a
    component's diameter.  Neighbour lists are never gathered, only their
    minimum, which is reduced before the shuffle and sent to the edges where a
    hub has many (`join_hot`).
    """
    now = ws.save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    k = 0
    for k in range(1, rounds + 1):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n")).select("a", F.least("a", "low").alias("low"), "n")
        low = ws.save(low, f"{name}-low-{k}")
        large = join_hot(both.where("b > a"), low, "a", "n", now.count()).select(F.col("b").alias("a"), F.col("low").alias("b"))
        # nodes that are their own minimum keep no edge here; small star needs those below
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        new = ws.save(small, f"{name}-{k}")
        n, same, both_n = new.count(), new.join(now, ["a", "b"], "left_semi").count(), now.count()
        ws.drop(f"{name}-{k - 1}", f"{name}-low-{k}")
        now = new
        if n == same == both_n:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
