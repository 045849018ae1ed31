"""Session helper, the package on the executors, and tables in the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_IN_A_BATCH = 2000


def ship(spark: SparkSession) -> None:
    """Give the executors this package, whatever their PYTHONPATH is; once an application.

    Rows hold whole texts here, so Arrow batches get fewer of them than Spark's
    default, unless the session has its own number.
    """
    sc = spark.sparkContext
    if spark.conf.get(_BATCH, "10000") == "10000":
        spark.conf.set(_BATCH, str(TEXTS_IN_A_BATCH))
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(root)
    path = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}-code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def session(name: str = "siltworks", **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; cluster settings come from the environment."""
    builder = SparkSession.builder.appName(name).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC").config("spark.sql.execution.arrow.pyspark.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one where that is unset and one machine does all work."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="siltworks-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


class Workspace:
    """Written tables of one operator call.

    ``save`` cuts the lineage: the table is written once as Parquet and read
    back, so lost executors recompute nothing before it.  ``drop`` removes a
    table that no later plan reads; what is left goes when the JVM ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_root(spark)}/siltworks/{label}-{uuid.uuid4().hex}"
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = self._path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path)
        self._fs.deleteOnExit(self._path)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        schema = df.schema
        df.write.mode("overwrite").option("compression", codec).parquet(self.path(name))
        return self.spark.read.schema(schema).parquet(self.path(name))

    def save_bucketed(self, df: DataFrame, name: str, by: str, n: int) -> DataFrame:
        """df in n buckets of a column: joins with what is dealt by it into n partitions do not move its rows."""
        table = f"siltworks_{uuid.uuid4().hex}"
        df.repartition(n, by).write.option("path", self.path(name)).option("compression", "none").bucketBy(n, by).saveAsTable(table)
        return self.spark.table(table)

    def drop(self, *names: str) -> None:
        for name in names:
            self._fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name)), True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df over all cores where it comes from fewer files than there are cores.

    A file of one row group is one task whatever its size; rows are dealt by
    hash of the keys.  Tables of many files are left as they are; either way
    the rows are the same.  Files are counted in the scan's own index, and
    their names are not brought here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if len(df._jdf.inputFiles()) < cores else df
