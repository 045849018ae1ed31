"""Sinks: JSON lines, Parquet, manifests, summaries and reports."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str) -> int:
    """JSON lines with sorted keys and nulls kept, a folder of part files; returns the number of rows."""
    out = df.select(*sorted(df.columns))
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return df.sparkSession.read.text(path).count()


def write_parquet(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_json(report: dict, path: str) -> None:
    """A small report as pretty JSON on the driver's file system."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps(report, indent=2, ensure_ascii=False, sort_keys=True) + "\n")


def manifest_report(manifest: DataFrame, stage: str, output: str) -> dict:
    """Totals by decision of a (decision, n) table of a few rows."""
    counts = {r.decision: r.n for r in manifest.collect()}
    return {"stage": stage, "output": output, "records": sum(counts.values()), "decisions": counts}


def run_summary(counters: DataFrame, steps: list[str], stage: str, category: str, dataset: str, written: int, manifest: str | None = None) -> dict:
    """The summary of a run from its (counter, n) table, which has a few rows a step, and the manifest's path."""
    return {"stage": stage, "category": category, "dataset": dataset, "written": written, "pipeline": steps, "counters": {r.counter: r.n for r in counters.orderBy("counter").collect()}, "manifest": manifest}


def status_report(results: DataFrame) -> DataFrame:
    """(status, sources, total_gb) of per-source results with status and size_bytes."""
    return results.groupBy("status").agg(F.count("*").alias("sources"), F.round(F.sum("size_bytes") / 1e9, 2).alias("total_gb"))


def write_source_report(results: DataFrame, path: str, endpoint: str | None = None, at: str | None = None) -> dict:
    """The report of a fetch, an entry a source of the catalogue in order of names, written as JSON.

    results has name and any of the other columns; cumulative_gb is rounded to
    three digits, and columns that are not there are null.
    """
    names = ("name", "repo_id", "domain", "status", "max_size_gb", "total_files", "data_files", "downloaded", "skipped", "failed", "cumulative_gb", "error", "notes")
    rows = results.select(*(F.col(c) if c in results.columns else F.lit(None).alias(c) for c in names)).withColumn("cumulative_gb", F.round(F.col("cumulative_gb").cast("double"), 3))
    report = {"generated_at": at or time.strftime("%Y-%m-%d %H:%M:%S"), "hf_endpoint": endpoint, "sources": [r.asDict() for r in rows.orderBy("name").collect()]}
    write_json(report, path)
    return report


def write_summary(report: dict, output: str, path: str | None = None) -> str:
    path = path or f"{output}.summary.json"
    write_json(report, path)
    return path


def clean_jsonl(spark: SparkSession, source: str, output: str, *, category: str, dataset: str, stage: str = "pretrain", config: dict | None = None, manifest_path: str | None = None, summary_path: str | None = None, keep_dropped: bool = False, **adapting) -> int:
    """The cleaning command: strict JSONL in, released JSONL out, with a summary and a manifest."""
    from ..plans import pipeline as P
    from .readers import read_jsonl

    p = P.build_pipeline(category, config)
    cleaned = p.run(read_jsonl(spark, source), dataset, stage, keep_dropped=True, **adapting).persist()
    rows = cleaned if keep_dropped else cleaned.where("decision <> 'drop'")
    released = P.release(rows)
    written = write_jsonl(released, output)
    write_summary(run_summary(P.counters(cleaned), p.steps, stage, category, dataset, written, manifest_path), output, summary_path)
    if manifest_path:
        write_json(manifest_report(P.manifest(spark.read.json(output) if written else released), stage, output), manifest_path)
    cleaned.unpersist()
    return written
