"""Tables in the cluster's shared folder, the package on the executors, and scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import Workspace, shared_root, ship, spread

__all__ = ["Workspace", "documents", "shared_root", "ship", "spread"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents table, over all cores even where it is one file."""
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id")
