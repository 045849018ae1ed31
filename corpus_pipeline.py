"""The document pipeline: five stages, each an operator of siltworks.llm.

Every stage takes (spark, docs, sf_dir); ``run`` writes what a stage returns as
Parquet in the shared folder and reads it again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltworks.llm.decontaminate import decontaminate_stage
from siltworks.llm.minhash import near_stage
from siltworks.llm.mixing import mixed_documents
from siltworks.llm.quality import quality_stage
from siltworks.llm.secretscan import secret_stage
from siltworks.llm.workspace import Workspace


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents that it takes, with copies, size and target."""
    return mixed_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_stage),
    ("decontamination", decontaminate_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
]

#: No SQL has the CRF, alignments or the forest; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = ws.save(stage(spark, docs, sf_dir), name)
    return docs
