"""Duplicates in unbounded input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import text as X
from ..operators.dedup import near_duplicates
from ..session import ship


def with_digest(df: DataFrame, text: str = "text") -> DataFrame:
    ship(df.sparkSession)
    return df.withColumn("text_sha256", X.text_kernel(F.array(F.col(text)))["text_sha256"])


def exact_stream(df: DataFrame, text: str = "text") -> DataFrame:
    """The first row of every text to arrive; state holds a digest for each text seen."""
    return with_digest(df, text).dropDuplicates(["text_sha256"])


def exact_stream_within(df: DataFrame, time: str, delay: str, text: str = "text") -> DataFrame:
    """As exact_stream, with state that a watermark bounds: copies within the delay are dropped."""
    return with_digest(df, text).withWatermark(time, delay).dropDuplicatesWithinWatermark(["text_sha256"])


class NearStream:
    """Near duplicates batch by batch, against a table of fingerprints seen so far.

    `handler` goes to foreachBatch; rows of a batch are in the order of seq.
    A batch is written to the seen table under its number, so a batch that is
    run again sees what it saw the first time.
    """

    def __init__(self, seen_path: str, sink: Callable[[DataFrame, int], None], threshold: int = 3, bands: int = 4, width: int = 5, text: str = "text", seq: str = "seq"):
        H.check_bands(threshold, bands)
        self.path, self.sink, self.threshold, self.bands, self.width, self.text, self.seq = seen_path, sink, threshold, bands, width, text, seq

    def handler(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        ship(spark)
        prints = batch.select(F.col(self.seq).cast("bigint").alias("seq"), H.simhash64(F.col(self.text), self.width).alias("fp")).persist()
        try:
            seen = spark.read.option("recursiveFileLookup", "true").parquet(self.path).where(F.col("batch") < number).select("fp").distinct()
        except Exception as e:  # no batch has been written yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            seen = prints.select("fp").limit(0)
        # what was seen before comes first in any order: below all numbers of the batch
        low = prints.agg(F.min("seq")).first()[0]
        both = prints.unionByName(seen.select(F.lit((low if low is not None else 0) - 1).cast("bigint").alias("seq"), "fp"))
        near = near_duplicates(both, self.threshold, self.bands).select(F.col("seq").alias("__near")).distinct()
        flagged = batch.join(near, batch[self.seq] == F.col("__near"), "left").withColumn("is_near_duplicate", F.col("__near").isNotNull()).drop("__near")
        self.sink(flagged, number)
        prints.select("fp").distinct().withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{self.path}/{number}")
        prints.unpersist()
