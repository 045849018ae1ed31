"""Mixing sources to target weights by nested hash-threshold histograms.

Every document has a 60-bit hash.  A source that must give R of its words
takes the documents whose hash is below a threshold.  The threshold is found
without a sort: sums of words by (source, 15 leading hash bits) give the bucket
in which R is crossed, and only that bucket is summed again by the next 15
bits, and what is left of it, a part in 2**30 of the source, by the last 30, so
that a bucket is one hash value.  What the boundary document leaves
over is filled by the same search among the smaller documents not yet taken.

Only DataFrame functions run.  Histograms have at most 32768 rows a source, so
a hot source costs no more than another: its rows are summed before the
shuffle.  Thresholds stay in tables, one row a source; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .workspace import documents, Workspace

WORD = "[^\\x20\\x09-\\x0D]+"
#: Hash bits of each level's histogram; the last level holds a 2**30th of a source.
BITS = (15, 15, 30)
CYCLE = (3, 1, 2)


def doc_hash(key: Column, text: Column) -> Column:
    """60 bits of the MD5 of key and text, as a bigint, so that documents without a key, or with one key, differ."""
    own = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(own.cast("binary")), 1, 15), 16, 10).cast("bigint")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, cycle=CYCLE, epochs: float = 1.5, most: float = 2.0) -> DataFrame:
    """Targets by source from (source, source_size).

    Sources in code-point order, null last, weigh as the cycle says.  They
    share epochs times all words by weight; none gets more than most times its
    own words, and what is above goes to the others by weight.  Sources fill up
    in the order of capacity over weight, so one running sum finds who is full.
    """
    order = W.Window.orderBy(F.col("source").asc_nulls_last())
    rank = (F.row_number().over(order) - 1) % len(cycle)
    weight = F.element_at(F.array(*map(F.lit, cycle)), (rank + 1).cast("int")).cast("bigint")
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(most))
    fill = W.Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = W.Window.partitionBy()
    s = (
        s.withColumn("total", F.sum("source_size").over(everything) * F.lit(epochs))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(fill.rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_from", F.sum("weight").over(fill.rowsBetween(0, W.Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("caps_before")) / F.col("weight_from"))
        .withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
        .withColumn("at", F.max(F.when(~F.col("full"), F.col("level"))).over(everything))
    )
    return s.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * F.col("at")).alias("target"))


def _thresholds(ws: Workspace, docs: DataFrame, need: DataFrame, name: str) -> DataFrame:
    """(source, threshold, spent): the largest hash prefix of each source with at most `need` words.

    docs: source, size, hash.  need: source, need.
    """
    known = need.select("source", "need", F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("spent"))
    for level, bits in enumerate(BITS):
        shift = sum(BITS[level + 1 :])
        here = docs.join(known, docs["source"].eqNullSafe(known["source"])).where(
            F.shiftright(docs["hash"], shift + bits) == F.col("prefix") if level else F.lit(True)
        )
        sums = here.groupBy(known["source"].alias("source"), "need", "prefix", "spent", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        by = W.Window.partitionBy("source").orderBy("bucket").rowsBetween(W.Window.unboundedPreceding, 0)
        crossed = sums.withColumn("upto", F.col("spent") + F.sum("words").over(by)).groupBy("source", "need", "prefix", "spent").agg(
            F.min(F.when(F.col("upto") > F.col("need"), F.struct("bucket", (F.col("upto") - F.col("words")).alias("before")))).alias("edge"),
            F.max("upto").alias("all"),
        )
        step = crossed.select(
            "source", "need",
            F.coalesce(F.col("edge.bucket"), F.shiftleft(F.col("prefix") + 1, bits)).alias("prefix"),
            F.coalesce(F.col("edge.before"), F.col("all")).alias("spent"),
        )
        step = step.withColumnRenamed("source", "of").drop("need")
        known = ws.save(
            known.join(step.select("of", F.col("prefix").alias("p"), F.col("spent").alias("s")), known["source"].eqNullSafe(F.col("of")), "left").select(
                "source", "need", F.coalesce("p", F.shiftleft("prefix", bits)).alias("prefix"), F.coalesce("s", "spent").alias("spent")
            ),
            f"{name}-{level}",
        )
    return known.select("source", F.col("prefix").alias("threshold"), F.col("spent").cast("bigint").alias("spent"))


def rules(ws: Workspace, base: DataFrame, cycle=CYCLE, epochs: float = 1.5, most: float = 2.0, fills: int = 2) -> DataFrame:
    """One row a source (of, source_size, target, rounds, and a threshold and size bound for each prefix) from (source, size, hash).

    Whole rounds of a source come first; the rest of its target is the hash
    prefix that stays within it, then `fills` more prefixes of the rest among
    documents that still fit.
    """
    plan = ws.save(targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, epochs, most).withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")), "plan")
    left, rest, cuts = base, plan.select("source", (F.col("target") - F.col("rounds") * F.col("source_size")).alias("need")), []
    for k in range(1 + fills):
        cut = _thresholds(ws, left, rest, f"cut{k}")
        now = rest.join(cut, rest["source"].eqNullSafe(cut["source"]), "left").select(
            rest["source"].alias("source"), F.coalesce("threshold", F.lit(0)).alias("threshold"), (F.col("need") - F.coalesce("spent", F.lit(0))).alias("after"), F.col("need").alias("most")
        )
        now = ws.save(now, f"rest{k}")
        cuts.append(now)
        rest = now.select("source", F.col("after").alias("need"))
        if k < fills:
            sized = left.join(now, left["source"].eqNullSafe(now["source"])).where((F.col("size") > 0) & (F.col("hash") >= F.col("threshold")) & (F.col("size") <= F.col("after")))
            left = ws.save(sized.select(left["source"], left["size"], left["hash"]), f"left{k}")
    out = plan
    for k, now in enumerate(cuts):
        now = now.select(F.col("source").alias(f"s{k}"), F.col("threshold").alias(f"t{k}"), F.col("most").alias(f"m{k}"))
        out = out.join(now, out["source"].eqNullSafe(now[f"s{k}"]), "left")
    return ws.save(out.drop(*(f"s{k}" for k in range(len(cuts)))).withColumnRenamed("source", "of"), "rules")


def copies(fills: int, size: Column, of_hash: Column, rule: Callable[[str], Column]) -> Column:
    """How often a document is taken, by its size, its hash and the row of `rules` for its source."""
    chosen = F.lit(False)
    for k in range(1 + fills):
        # a document is a candidate of fill k if no earlier prefix has it and it fits
        fits = size <= rule(f"m{k}") if k else F.lit(True)
        chosen = chosen | (fits & (of_hash < rule(f"t{k}")))
    return F.when(size > 0, rule("rounds") + F.when(chosen, 1).otherwise(0)).otherwise(0).cast("int")


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", cycle=CYCLE, epochs: float = 1.5, most: float = 2.0, fills: int = 2) -> DataFrame:
    """One row a document: its key, size, source_size, target and taken words.

    Null text has size 0, a null source is a source of its own that comes last,
    an empty table gives none, texts of any length are one number.  Documents
    with a null or repeated key are told apart by their text; rows equal in
    both count each and have the same fate.  Other columns are not read.  No
    document is taken more than `most` times.
    """
    ws = Workspace(docs.sparkSession, "mixing")
    base = ws.save(_sizes(docs, text, source, key), "sizes")
    by = rules(ws, base, cycle, epochs, most, fills)
    out = base.join(by, base["source"].eqNullSafe(by["of"]))
    return out.select(F.col("key").alias(key), "size", "source_size", "target", (F.col("size") * copies(fills, F.col("size"), F.col("hash"), F.col)).cast("bigint").alias("taken"))


def _sizes(docs: DataFrame, text: str, source: str, key: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"), doc_hash(F.col(key), F.col(text)).alias("hash"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", cycle=CYCLE, epochs: float = 1.5, most: float = 2.0, fills: int = 2) -> DataFrame:
    """The documents that the mix takes, with how often (copies), their size and their source's target.

    A document that the mix takes twice is one row with two copies; documents
    without a word are not taken.  Columns of docs that already have such a
    name, in any case, stay, and the new one gets the prefix `mix_` until it is
    a new one.  Each document meets the rule of its source, one row, so texts
    are not joined by their keys.
    """
    ws = Workspace(docs.sparkSession, "mixing")
    base = ws.save(_sizes(docs, text, source, key).drop("key"), "sizes")
    by = rules(ws, base, cycle, epochs, most, fills)
    by = by.select(*(F.col(c).alias(f"__mix_{c}") for c in by.columns))
    taken = {c.lower() for c in docs.columns}
    names = []
    for c in ("copies", "size", "target"):
        while c in taken:
            c = f"mix_{c}"
        names.append(c)
    rule = lambda c: by[f"__mix_{c}"]
    size = word_count(docs[text])
    both = docs.join(by, docs[source].cast("string").eqNullSafe(rule("of")))
    new = copies(fills, size, doc_hash(docs[key], docs[text]), rule).alias(names[0]), size.alias(names[1]), rule("target").alias(names[2])
    return both.select(*(docs[c] for c in docs.columns), *new).where(F.col(names[0]) > 0)


def _fill_sql(k: int) -> str:
    """Rows that prefix k takes, and what it leaves, in ANSI SQL."""
    left = "base" if k == 0 else f"left{k}"
    before = "" if k == 0 else f"""
left{k} AS (SELECT b.* FROM {'base' if k == 1 else f'left{k - 1}'} b JOIN rest{k - 1} r ON b.source IS NOT DISTINCT FROM r.source
  WHERE b.size > 0 AND b.size <= r.need AND b.hash >= r.threshold),"""
    rest = "need0" if k == 0 else f"rest{k - 1}"
    return f"""{before}
cum{k} AS (SELECT source, hash, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY hash) AS upto FROM {left} GROUP BY source, hash),
cut{k} AS (SELECT c.source, coalesce(min(CASE WHEN c.upto > n.need THEN c.hash END), {1 << 60}) AS threshold,
    coalesce(max(CASE WHEN c.upto <= n.need THEN c.upto END), 0) AS spent
  FROM cum{k} c JOIN {rest} n ON c.source IS NOT DISTINCT FROM n.source GROUP BY c.source),
rest{k} AS (SELECT n.source, coalesce(c.threshold, 0) AS threshold, n.need - coalesce(c.spent, 0) AS need, n.need AS most
  FROM {rest} n LEFT JOIN cut{k} c ON c.source IS NOT DISTINCT FROM n.source),"""


SQL = f"""
WITH base AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS hash FROM documents),
sized AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
weighed AS (SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS BIGINT) AS weight, source_size * 2.0::DOUBLE AS cap FROM sized),
levels AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / CAST(sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM weighed),
marked AS (SELECT *, max(CASE WHEN cap > level * weight THEN level END) OVER () AS common FROM levels),
plan AS (SELECT source, source_size, CASE WHEN cap <= level * weight THEN cap ELSE weight * common END AS target FROM marked),
rounded AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS rounds FROM plan),
need0 AS (SELECT source, target - rounds * source_size AS need FROM rounded),{_fill_sql(0)}{_fill_sql(1)}{_fill_sql(2)}
done AS (SELECT 1)
SELECT b.doc_id, b.size, p.source_size, p.target,
  CAST(b.size * (p.rounds + CASE WHEN b.hash < r0.threshold OR (b.size <= r1.most AND b.hash < r1.threshold) OR (b.size <= r2.most AND b.hash < r2.threshold) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM base b JOIN rounded p ON b.source IS NOT DISTINCT FROM p.source
JOIN rest0 r0 ON b.source IS NOT DISTINCT FROM r0.source JOIN rest1 r1 ON b.source IS NOT DISTINCT FROM r1.source JOIN rest2 r2 ON b.source IS NOT DISTINCT FROM r2.source
"""

QUERIES = {"op5_mix_sources": op5_mix}
ORACLES = {"op5_mix_sources": SQL}
