"""Scans: JSONL strict and lenient, Parquet, plain text, corpora of mixed files."""

from __future__ import annotations

import fnmatch
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from ..functions import values as V
from ..functions.text import strip_py
from ..session import Workspace
from .fields import ColumnFields, VariantFields


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, file) of every line; .gz and .zst are unpacked by their suffix."""
    return spark.read.option("recursiveFileLookup", "true").text(path).select("value", F.col("_metadata.file_path").alias("file"))


def read_jsonl(spark: SparkSession, path: str | list[str], column: str = "data") -> DataFrame:
    """Strict JSONL as one VARIANT column; a line that is no JSON object stops the query with its text.

    Blank lines are skipped.
    """
    lines = read_lines(spark, path).where(F.length(strip_py(F.col("value"))) > 0)
    v = F.try_parse_json(F.col("value"))
    ok = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    fail = F.raise_error(F.concat(F.lit("not a JSON object in "), F.col("file"), F.lit(": "), F.substring("value", 1, 200)))
    return lines.select(F.when(ok, v).otherwise(F.parse_json(fail.cast("string"))).alias(column), "file")


def read_jsonl_lenient(spark: SparkSession, path: str | list[str], names: tuple[str, ...] = V.TEXT_COLUMNS) -> DataFrame:
    """(data variant, text, file): lines that are no JSON object or have no text are dropped.

    The text is the first non-empty string of the named fields.
    """
    v = F.try_parse_json(F.col("value"))
    df = read_lines(spark, path).select(v.alias("data"), "file").where(F.coalesce(F.schema_of_variant("data").startswith("OBJECT"), F.lit(False)))
    f = VariantFields("data")
    text = F.coalesce(*(F.when(F.length(f.string(n)) > 0, f.string(n)) for n in names))
    return df.select("data", text.alias("text"), "file").where("text IS NOT NULL")


def text_column(names: list[str], wanted: str | None = None, fallbacks: tuple[str, ...] = V.TEXT_COLUMNS) -> str | None:
    """The wanted column, whatever its case, or the first fallback that is there."""
    by_lower = {n.lower(): n for n in reversed(names)}
    if wanted in names:
        return wanted
    if wanted and wanted.lower() in by_lower:
        return by_lower[wanted.lower()]
    return next((by_lower[x] for x in fallbacks if x in by_lower), None)


def read_parquet_text(spark: SparkSession, path: str | list[str], wanted: str | None = "text", keep: tuple[str, ...] = V.KEPT_PARQUET_COLUMNS) -> DataFrame:
    """(text, and those of `keep` that are there): null and empty texts are dropped.

    A table without a text column gives no rows.  Only these columns are read.
    """
    df = spark.read.option("recursiveFileLookup", "true").parquet(*([path] if isinstance(path, str) else path))
    name = text_column(df.columns, wanted)
    if name is None:
        return spark.createDataFrame([], "text string")
    kept = [F.col(c) for c in keep if c in df.columns and c != "text"]
    return df.select(F.col(name).cast("string").alias("text"), *kept).where(F.length("text") > 0)


def read_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(text): stripped non-blank lines of plain text files."""
    return spark.read.text(path).select(strip_py(F.col("value")).alias("text")).where(F.length("text") > 0)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, size) of all files below a folder, from the store's listing; contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return rows.select("path", F.col("length").alias("size"))


_KINDS = r"[.](parquet|jsonl|json|gz|zst)$"


def corpus_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, size) of files and of all known files in folders; .txt only where it is named itself."""
    out = None
    for path in paths:
        found = list_files(spark, path)
        found = found if re.search(_KINDS[:-1].replace(")", "|txt)") + "$", path) else found.where(F.rlike(F.lower("path"), F.lit(_KINDS)))
        out = found if out is None else out.unionByName(found)
    return out.distinct() if out is not None else spark.createDataFrame([], "path string, size bigint")


def read_records(spark: SparkSession, files: list[str], wanted: str | None = "text") -> DataFrame:
    """(source_id, source, text, file, number): records with a text of Parquet, JSONL, JSON and their .gz and .zst, and lines of .txt.

    source_id and source are the record's own, or null; number is the record's
    place in its file.
    """
    out = None
    for kind in ("parquet", "txt", "json"):
        own = [p for p in files if (ext := p.rpartition(".")[2].lower()) == kind or (kind == "json" and ext not in ("parquet", "txt"))]
        if not own:
            continue
        none = F.lit(None).cast("string")
        if kind == "parquet":
            df = spark.read.parquet(*own)
            name = text_column(df.columns, wanted)
            if name is None:
                continue
            text = F.col(f"`{name}`").cast("string")
            ids = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in ("id", "source_id") if c in df.columns]
            rows = df.select(F.coalesce(*ids, none).alias("source_id"), (F.nullif(F.col("source").cast("string"), F.lit("")) if "source" in df.columns else none).alias("source"), text.alias("text"), F.col("_metadata.file_path").alias("file"))
        elif kind == "txt":
            rows = spark.read.text(own).select(none.alias("source_id"), none.alias("source"), strip_py(F.col("value")).alias("text"), F.col("_metadata.file_path").alias("file"))
        else:
            rows = read_jsonl_lenient(spark, own)
            f = VariantFields("data")
            ids = F.coalesce(*(F.when(f.truthy(n), f.shown(n)) for n in ("id", "source_id")))
            rows = rows.select(ids.alias("source_id"), F.when(f.truthy("source"), f.shown("source")).alias("source"), "text", "file")
        rows = numbered(rows.where(F.length("text") > 0), "number", each_file=True).select("source_id", "source", "text", "file", "number")
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else spark.createDataFrame([], "source_id string, source string, text string, file string, number bigint")


def read_corpus(spark: SparkSession, paths: list[str], wanted: str | None = "text") -> DataFrame:
    """(text) of files and folders: Parquet, JSONL, JSON, their .gz and .zst, and .txt where named itself."""
    out = None
    files = [r.path for r in corpus_files(spark, paths).orderBy("path").collect()]
    for kind, reader in (("parquet", lambda p: read_parquet_text(spark, p, wanted)), ("txt", lambda p: read_text(spark, p)), ("json", lambda p: read_jsonl_lenient(spark, p))):
        own = [p for p in files if p.rpartition(".")[2].lower() == kind or (kind == "json" and p.rpartition(".")[2].lower() not in ("parquet", "txt"))]
        if own:
            part = reader(own).select("text")
            out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "text string")


def fields_of(df: DataFrame) -> ColumnFields | VariantFields:
    """Access to the record: the VARIANT column `data` where there is one, else the columns."""
    if "data" in df.columns and isinstance(df.schema["data"].dataType, T.VariantType):
        return VariantFields("data")
    return ColumnFields(df)


#: Splits of files whose numbers are sent to every task; beyond it they are joined.
SPLITS = 200_000


def numbered(df: DataFrame, out: str = "seq", each_file: bool = False) -> DataFrame:
    """df with the number of each row in input order: files by path, rows as they stand in a file.

    With each_file, every file begins at 0.  A split of a file is told by where
    it begins, and rows of a split keep their order, so the numbers do not
    depend on how splits are dealt to tasks.  Rows are counted by split first.
    Tables that are not read from files are numbered in their partitions' order.
    """
    try:
        raw = df.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__at"))
    except AnalysisException:
        return df.withColumn(out, F.monotonically_increasing_id())
    splits = raw.groupBy("__path", "__start").agg(F.min("__at").alias("__low"), F.count("*").alias("__n"))
    splits = Workspace(df.sparkSession, "splits").save(splits, "splits")
    order = (W.Window.partitionBy("__path").orderBy("__start") if each_file else W.Window.orderBy("__path", "__start")).rowsBetween(W.Window.unboundedPreceding, -1)
    first = splits.select(F.col("__path").alias("__p"), F.col("__start").alias("__s"), (F.coalesce(F.sum("__n").over(order), F.lit(0)) - F.col("__low")).alias("__add"))
    first = F.broadcast(first) if splits.count() <= SPLITS else first
    joined = raw.join(first, (F.col("__path") == F.col("__p")) & (F.col("__start") == F.col("__s")))
    return joined.withColumn(out, F.col("__at") + F.col("__add")).drop("__path", "__start", "__at", "__p", "__s", "__add")


def adapt(df: DataFrame, dataset: str, stage: str, category: str, *, id_field: str = "id", seq: str | None = None, field_map: tuple[tuple[str, str], ...] = (), hooks: tuple = ()) -> tuple[DataFrame, ColumnFields | VariantFields]:
    """Rows with seq, dataset, stage, category and source_id, and access to their fields.

    field_map (source, target) copies a field whose target key is absent.
    source_id is the id where it is true, else dataset:seq.  seq is the input
    order and decides who is first among duplicates: name a column of different
    numbers that has it, or the scan is `numbered`.  Hooks are DataFrame to DataFrame.
    """
    if stage not in V.STAGES or category not in V.CATEGORIES:
        raise ValueError(f"unknown stage or category: {stage}, {category}")
    df = df.withColumn("seq", F.col(seq).cast("bigint")) if seq else numbered(df)
    for hook in hooks:
        df = hook(df)
    fields = fields_of(df)
    for source, target in field_map:
        fields.put(target, F.when(fields.present(target), fields.string(target)).otherwise(fields.string(source)))
    own = F.coalesce(fields.shown(id_field), F.concat(F.lit(dataset + ":"), F.col("seq").cast("string")))
    names = {"dataset": dataset, "stage": stage, "category": category}
    return df.withColumns({"source_id_out": own} | {f"{k}_out": F.lit(v) for k, v in names.items()}), fields


def matches_globs(c: Column, patterns: list[str] | tuple[str, ...]) -> Column:
    """Whether a path matches any glob; `*` crosses slashes, no pattern matches all."""
    if not patterns:
        return F.lit(True)
    return F.rlike(c, F.lit("|".join(f"(?:{_java(p)})" for p in patterns)))


def _java(glob: str) -> str:
    """A glob as a Java regular expression over the whole string."""
    out = fnmatch.translate(glob)
    return "^(?s:" + re.sub(r"^\(\?s:", "", out).removesuffix(r")\Z").removesuffix(r")\z") + ")$"


def select_files(files: DataFrame, include: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    """(path, size) rows that an include glob matches and no exclude glob does."""
    keep = matches_globs(F.col("path"), include)
    return files.where(keep & ~matches_globs(F.col("path"), exclude) if exclude else keep)


def capped_prefix(files: DataFrame, cap: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Files in path order while the sum before them is below the cap; 0 is no cap.

    The file that crosses the cap is in.  `by` gives columns of sources, each
    with a cap of its own; sums run within them.
    """
    if not cap:
        return files.withColumn("before", F.lit(0).cast("bigint"))
    order = (W.Window.partitionBy(*by) if by else W.Window.partitionBy()).orderBy("path").rowsBetween(W.Window.unboundedPreceding, -1)
    return files.withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)).cast("bigint")).where(F.col("before") < cap)
