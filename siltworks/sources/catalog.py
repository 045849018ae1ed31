"""Corpus catalogues: sources with size caps, and what of them is fetched."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .readers import capped_prefix, select_files

_DDL = "name string, domain string, repo_id string, max_size_gb double, include_patterns array<string>, exclude_patterns array<string>, notes string"


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One row a source of a YAML or JSON file with a list `sources`; a cap of 0 is none."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        data = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("YAML catalogues need PyYAML; a JSON file needs nothing") from e
        data = yaml.safe_load(text)
    rows = [(s["name"], s.get("domain"), s.get("repo_id"), float(s.get("max_size_gb") or 0), list(s.get("include_patterns") or []), list(s.get("exclude_patterns") or []), s.get("notes")) for s in data["sources"]]
    return spark.createDataFrame(rows, _DDL)


def plan_fetch(files: DataFrame, max_bytes: int, include: list[str] = (), exclude: list[str] = (), present: DataFrame | None = None, test: bool = False) -> DataFrame:
    """(path, size, before, action): files to fetch in path order up to the cap.

    present (path, size) marks files that are there with their size as skipped;
    test takes the first file only.
    """
    chosen = capped_prefix(select_files(files, include, exclude), max_bytes)
    if test:
        chosen = chosen.withColumn("__n", F.row_number().over(W.Window.orderBy("path"))).where("__n = 1").drop("__n")
    if present is None:
        return chosen.withColumn("action", F.lit("fetch"))
    have = present.select(F.col("path").alias("__p"), F.col("size").alias("__s"))
    return chosen.join(have, (F.col("path") == F.col("__p")) & (F.col("size") == F.col("__s")), "left").withColumn("action", F.when(F.col("__p").isNotNull(), "skip").otherwise("fetch")).drop("__p", "__s")


def source_status(results: DataFrame) -> DataFrame:
    """(name, status, size_bytes) from file results (name, outcome fetched/skipped/failed, size).

    Failed if a file failed and none was fetched, partial if some failed, ok
    else; a source without files is empty (its row has a null outcome).
    """
    n = lambda x: F.count_if(F.col("outcome") == x)
    status = F.when(F.count("outcome") == 0, "empty").when((n("failed") > 0) & (n("fetched") == 0), "failed").when(n("failed") > 0, "partial").otherwise("ok")
    return results.groupBy("name").agg(status.alias("status"), F.coalesce(F.sum(F.when(F.col("outcome") != "failed", F.col("size"))), F.lit(0)).cast("bigint").alias("size_bytes"))
