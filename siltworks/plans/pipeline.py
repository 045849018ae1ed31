"""Cleaning pipelines: one plan per category, from adapted records to released rows."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions import values as V
from ..operators import dedup
from ..operators import effects as E
from ..operators import steps as S
from ..session import Workspace, ship
from ..sources.readers import adapt

DEFAULTS = {
    "min_chars": V.MIN_CHARS, "max_chars": V.MAX_CHARS, "require_license": False, "sensitive_terms": (), "near_dedup": False, "near_dedup_threshold": 3, "near_dedup_bands": 4,
    "near_dedup_ngram": 5, "near_dedup_match": 2, "context_lengths": V.CONTEXT_LENGTHS, "code_denied_path_parts": V.DENIED_PATH_PARTS, "web_boilerplate_limit": 4, "quality_policies": None, "token_estimator": None, "materialize": True,
}


@dataclass(frozen=True)
class Pipeline:
    """The steps of a category, bound to its configuration.

    config may hold the keys of DEFAULTS; token_estimator is a function from
    the text column to a column of whole numbers.  With materialize, rows are
    written once to the shared folder after the text kernel and the row-local
    steps: text crosses to Python once, and the duplicate joins read narrow
    columns.  Without it the plan stays lazy and runs them for each join.
    """

    category: str
    config: dict

    @property
    def steps(self) -> list[str]:
        own = S.CATEGORY_STEPS[self.category]
        return [n for n, _ in (*own[:1], *S.PREFIX, *own[1:])] + list(S.SUFFIX)

    def run(self, df: DataFrame, dataset: str = "dataset", stage: str = "pretrain", *, text_fields: tuple[str, ...] = ("text",), id_field: str = "id", seq: str | None = None, field_map: tuple[tuple[str, str], ...] = (), hooks: tuple[Callable, ...] = (), keep_dropped: bool = False) -> DataFrame:
        """Cleaned rows: the columns of df, and those of `OUTPUT`.

        Dropped rows are left out unless keep_dropped.  `trace` lists the
        counters a row adds to.
        """
        ship(df.sparkSession)
        config = {**DEFAULTS, **self.config, "category": self.category, "dataset": dataset, "text_fields": text_fields}
        names = df.columns
        df, fields = adapt(df, dataset, stage, self.category, id_field=id_field, seq=seq, field_map=field_map, hooks=hooks)
        row = S.Row(fields, E.Effects(), config)
        own = S.CATEGORY_STEPS[self.category]
        for name, step in own[:1]:
            row.effects.step(name)
            step(row)
        # the parts of the text in slots, one for each field of each alternative
        row.effects.step(S.PREFIX[0][0])
        taken, slots = F.lit(False), []
        for when, parts in (*row.parts, (F.lit(True), tuple(text_fields))):
            chosen = F.coalesce(when, F.lit(False)) & ~taken
            slots += [(n, F.when(chosen, fields.string(n))) for n in parts]
            taken = taken | F.coalesce(when, F.lit(False))
        kernel = X.text_kernel_with_print(config["near_dedup_ngram"]) if config["near_dedup"] else X.text_kernel
        df = df.withColumn("__k", kernel(F.array(*(c for _, c in slots))))
        # of one slot the text is the part, so that a row has its record and one clean text
        parts = F.col("__k.parts") if len(slots) > 1 else F.array(F.when(F.get(F.col("__k.parts"), F.lit(0)).isNotNull(), True))
        df = df.select("*", F.col("__k.text").alias("text_out"), F.col("__k.text_sha256").alias("text_sha256_out"), F.col("__k.fp").alias("__fp"), parts.alias("__parts")).drop("__k")
        for k, (name, _) in enumerate(slots):
            fields.put(name, F.get(F.col("__parts"), F.lit(k)) if len(slots) > 1 else F.when(F.get(F.col("__parts"), F.lit(0)), F.col("text_out")))
        row.text = F.col("text_out")
        if config["sensitive_terms"] or self.category == "agentic":
            df = df.withColumn("__folded", X.casefold(F.col("text_out")))
            row.folded = F.col("__folded")
        for name, step in (*S.PREFIX[1:], *own[1:], (S.SUFFIX[0], S.quality_policy)):
            row.effects.step(name)
            step(row)
        df = df.withColumn("marks", E.array_of(row.effects.marks, E.MARK)).withColumn("stop_step", E.stop_step())
        if config["materialize"]:
            df = Workspace(df.sparkSession, "clean").save(df, "rows")
        df = self._duplicates(df, row, config)
        return self._finish(df, row, config, names, keep_dropped, fields)

    def _duplicates(self, df: DataFrame, row: S.Row, config: dict) -> DataFrame:
        """Marks of duplicates, from a list of (seq, step): texts stay out of the exchanges that make it."""
        row.effects.step(S.SUFFIX[1])
        exact = row.effects.at
        alive = df.where("stop_step IS NULL").select("seq", F.col("text_sha256_out").alias("text_sha256"), F.col("__fp").alias("fp"))
        judged = dedup.exact_duplicates(alive, out="again")
        ws = Workspace(df.sparkSession, "duplicates") if config["materialize"] else None
        if ws and config["near_dedup"]:
            judged = ws.save(judged, "exact")
        found = judged.where("again").select("seq", F.lit(exact).alias("at"))
        row.effects.step(S.SUFFIX[2])
        if config["near_dedup"]:
            near = dedup.near_duplicates(judged.where("NOT again"), config["near_dedup_threshold"], config["near_dedup_bands"], match=config["near_dedup_match"])
            found = found.unionByName(near.select("seq", F.lit(row.effects.at).alias("at")))
        # written, its size is known: a small list goes to the rows, a large one meets them by seq
        found = ws.save(found, "found") if ws else found
        reason = F.when(F.col("__at") == exact, "exact_duplicate").otherwise("near_duplicate")
        mark = F.array(F.struct(F.col("__at").alias("step"), F.lit(V.DROP).alias("sev"), reason.alias("reason")))
        df = df.join(found.select(F.col("seq").alias("__of"), F.col("at").alias("__at")), F.col("seq") == F.col("__of"), "left")
        hit = F.col("__at").isNotNull()
        return df.withColumns({"marks": F.when(hit, F.concat("marks", mark)).otherwise(F.col("marks")), "stop_step": F.when(hit, F.col("__at")).otherwise(F.col("stop_step"))})

    def _finish(self, df: DataFrame, row: S.Row, config: dict, names: list[str], keep_dropped: bool, fields) -> DataFrame:
        e = row.effects
        e.step(S.SUFFIX[3])
        estimator = config["token_estimator"]
        tokens = F.greatest(F.lit(1), estimator(row.text).cast("bigint")) if estimator else X.estimated_tokens(row.text)
        lengths = config["context_lengths"] or V.CONTEXT_LENGTHS
        e.metric("estimated_tokens", tokens)
        e.bucket("length", X.length_bucket(tokens, lengths))
        e.bucket("context", X.context_bucket(tokens, lengths))
        e.step(S.SUFFIX[4])
        df = df.withColumn("marks", F.filter("marks", lambda m: F.col("stop_step").isNull() | (m.step <= F.col("stop_step"))))
        sev = E.severity()
        e.bucket("quality", F.when(sev == V.REVIEW, "review").when(sev == V.DROP, "drop").otherwise("main"), keep_first=True)
        flags = F.filter(E.array_of(e.flags, "array<struct<step:int,flag:string>>"), lambda x: F.col("stop_step").isNull() | (x.step <= F.col("stop_step")))
        hashed = e.steps.index(S.SUFFIX[1])
        given = fields.string("text_sha256")
        renewed = {n: c for n, c in fields.over.items()} | e.renewed
        out = {
            "decision": E.decision_name(sev),
            "reasons": F.array_distinct(F.transform("marks", lambda m: m.reason)),
            "flags": F.array_sort(F.array_distinct(F.transform(flags, lambda x: x.flag))),
            "buckets": E.map_of(E.bucket_values(e.buckets), "string"),
            "metrics": E.map_of(E.metric_values(e.metrics), "double"),
            "clean_text": F.col("text_out"),
            "text_sha256": F.when(E.reached(hashed), F.coalesce(given, F.col("text_sha256_out"))),
            "renewed": E.map_of(renewed, "string"),
            "trace": E.trace(e.steps),
        }
        if not keep_dropped:
            df = df.where(sev < V.DROP)
        kept = [F.col(c) for c in names if c not in out and c not in ("seq", "dataset", "source_id", "stage", "category")]
        head = [F.col("seq"), *(F.col(f"{c}_out").alias(c) for c in ("dataset", "source_id", "stage", "category"))]
        return df.select(*head, *kept, *(c.alias(n) for n, c in out.items()))


OUTPUT = ("seq", "dataset", "source_id", "stage", "category", "decision", "reasons", "flags", "buckets", "metrics", "clean_text", "text_sha256", "renewed", "trace")


def build_pipeline(category: str, config: dict | None = None) -> Pipeline:
    if category not in S.CATEGORY_STEPS:
        raise ValueError(f"unknown category {category!r}")
    unknown = set(config or {}) - set(DEFAULTS)
    if unknown:
        raise ValueError(f"unknown configuration keys: {sorted(unknown)}")
    return Pipeline(category, dict(config or {}))


def read_config(path: str) -> dict:
    """A JSON or YAML file as a configuration; a missing file is an error."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith((".yaml", ".yml")):
        import yaml

        return yaml.safe_load(text) or {}
    return json.loads(text) if text.strip() else {}


def load_config(cleaning: dict | None = None, override: dict | None = None) -> dict:
    """A cleaning configuration with the quality policies of another: as they are, or wrapped.

    The wrapped form has quality_policies and may set the near-duplicate keys.
    """
    out = dict(cleaning or {})
    if override:
        if "quality_policies" in override:
            out |= {k: v for k, v in override.items() if k == "quality_policies" or k.startswith("near_dedup")}
        else:
            out["quality_policies"] = override
    out.setdefault("quality_policies", None)
    return out


@F.pandas_udf(T.StructType([T.StructField("data", T.StringType()), T.StructField("record_sha256", T.StringType())]))
def _released(base: pd.Series, renewed: pd.Series, digest: pd.Series) -> pd.DataFrame:
    rows = []
    for text, over, sha in zip(base, renewed, digest):
        data = json.loads(text)
        data.update({k: v for k, v in (over.items() if isinstance(over, dict) else over or [])})
        if sha is not None:
            data["text_sha256"] = sha
        canonical = json.dumps(data, ensure_ascii=False, sort_keys=True, default=str)
        rows.append((canonical, hashlib.sha256(canonical.encode("utf-8", "surrogatepass")).hexdigest()))
    return pd.DataFrame(rows, columns=["data", "record_sha256"])


def release(cleaned: DataFrame) -> DataFrame:
    """The release envelope: ten columns and record_sha256, data as canonical JSON.

    data is the record with its text fields normalised and text_sha256 set.
    """
    if "data" in cleaned.columns and isinstance(cleaned.schema["data"].dataType, T.VariantType):
        base = F.to_json("data")
    else:
        own = [c for c in cleaned.columns if c not in OUTPUT]
        base = F.to_json(F.struct(*own)) if own else F.lit("{}")
    df = cleaned.withColumn("__r", _released(base, F.col("renewed"), F.col("text_sha256")))
    return df.select("dataset", "source_id", "stage", "category", "decision", "reasons", "flags", "buckets", "metrics", F.col("__r.data").alias("data"), F.col("__r.record_sha256").alias("record_sha256"))


def counters(cleaned: DataFrame) -> DataFrame:
    """(counter, n) of a run with keep_dropped: input, step.S.seen, step.S.<decision>, output.<decision>."""
    return cleaned.select(F.explode("trace").alias("counter")).groupBy("counter").agg(F.count("*").alias("n"))


def manifest(released: DataFrame) -> DataFrame:
    """(decision, n): keep, review and drop are always there; a missing decision is keep."""
    domain = released.sparkSession.createDataFrame([(d,) for d in V.DECISIONS], "decision string")
    found = released.groupBy(F.coalesce("decision", F.lit("keep")).alias("decision")).agg(F.count("*").alias("n"))
    both = found.join(domain.withColumn("known", F.lit(True)), "decision", "full")
    return both.select("decision", F.coalesce("n", F.lit(0)).alias("n"))
