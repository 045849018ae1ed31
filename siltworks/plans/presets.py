"""Decoder presets as tables: layer schedules, parameter counts, attention windows, rotary frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .pipeline import read_config

# Hyper-parameters of the named presets.
COLUMNS = ("name", "layers", "hidden", "inner", "heads", "kv_heads", "vocab", "max_len", "window", "attention_every", "rope_every", "rope_base", "rope_percent", "tied")
PRESETS = (
    ("tiny", 4, 256, 512, 4, 2, 8000, 1024, 64, 1, 1, 500000.0, 0.334, True),
    ("small", 8, 512, 1024, 8, 4, 32000, 4096, 128, 4, 2, 500000.0, 0.334, True),
    ("base", 12, 768, 2048, 12, 4, 65536, 8192, 128, 4, 3, 500000.0, 0.334, False),
    ("medium", 24, 1024, 2816, 16, 8, 65536, 16384, 128, 6, 3, 500000.0, 0.334, False),
    ("large", 32, 4096, 11008, 32, 8, 65536, 262144, 127, 6, 3, 5000000.0, 0.334, False),
    ("small-full-attn", 8, 512, 1024, 8, 4, 32000, 4096, 128, 1, 1, 500000.0, 0.334, True),
    ("small-all-rope", 8, 512, 1024, 8, 4, 32000, 4096, 128, 4, 1, 500000.0, 0.334, True),
)
# The settings of a preset file that the columns above stand for, in their order after the name, and what they are where a preset leaves them out.
SETTINGS = ("num_layers", "hidden_size", "intermediate_size", "num_heads", "num_kv_heads", "vocab_size", "max_seq_len", "window_size", "attention_every", "rope_every", "rope_base", "rope_percent", "tie_word_embeddings")
LEFT_OUT = (8, 512, 1024, 8, 4, 32000, 4096, 128, 4, 2, 500000.0, 0.334, True)
# Settings of a preset that no table here uses.
OTHER_SETTINGS = ("norm_eps", "pad_token_id", "bos_token_id", "eos_token_id", "notes")
# End of the fixed values.
_DDL = "name string, layers int, hidden int, inner int, heads int, kv_heads int, vocab int, max_len int, window int, attention_every int, rope_every int, rope_base double, rope_percent double, tied boolean"


def read_presets(path: str) -> list[tuple]:
    """The presets of a YAML or JSON file with a mapping `presets`; unknown settings are errors."""
    out = []
    for name, own in (read_config(path).get("presets") or {}).items():
        if unknown := set(own) - {*SETTINGS, *OTHER_SETTINGS}:
            raise ValueError(f"unknown settings of preset {name!r}: {sorted(unknown)}")
        values = [own.get(k, v) for k, v in zip(SETTINGS, LEFT_OUT)]
        out.append((name, *(type(v)(x) for x, v in zip(values, LEFT_OUT))))
    return out


def presets(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The presets, or those of a file, each with a column for every invariant it must keep."""
    df = spark.createDataFrame(read_presets(path) if path else list(PRESETS), _DDL)
    return df.withColumns({"rope_percent_in_range": (F.col("rope_percent") > 0) & (F.col("rope_percent") <= 1), "heads_divide_hidden": F.col("hidden") % F.col("heads") == 0, "kv_divides_heads": F.col("heads") % F.col("kv_heads") == 0, "steps_positive": (F.col("attention_every") > 0) & (F.col("rope_every") > 0)})


def preset(spark: SparkSession, name: str, path: str | None = None) -> dict:
    rows = presets(spark, path).where(F.col("name") == name).collect()
    if not rows:
        raise ValueError(f"no preset {name!r}")
    return rows[0].asDict()


def layers(df: DataFrame) -> DataFrame:
    """(name, layer, attention, rope): full attention and rotary positions every so many layers."""
    rows = df.select("name", "attention_every", "rope_every", F.explode(F.sequence(F.lit(0), F.col("layers") - 1)).alias("layer"))
    return rows.select("name", "layer", F.when(F.col("layer") % F.col("attention_every") == 0, "full").otherwise("window").alias("attention"), (F.col("layer") % F.col("rope_every") == 0).alias("rope"))


def parameters(df: DataFrame) -> DataFrame:
    """(name, embedding, blocks, total, non_embedding) parameter counts."""
    h, n = F.col("hidden").cast("bigint"), F.col("layers").cast("bigint")
    head = (h / F.col("heads")).cast("bigint")
    block = 2 * h * h + 2 * h * F.col("kv_heads") * head + 3 * h * F.col("inner") + 2 * h
    emb = F.col("vocab") * h
    total = emb * F.when(F.col("tied"), 1).otherwise(2) + n * block + h
    return df.select("name", emb.alias("embedding"), (n * block).alias("blocks"), total.alias("total"), (total - emb).alias("non_embedding"))


def window_mask(spark: SparkSession, length: int, window: int) -> DataFrame:
    """(i, j) pairs a sliding window lets attend: j from i - window to i."""
    rows = spark.range(length).select(F.col("id").alias("i"))
    return rows.select("i", F.explode(F.sequence(F.greatest(F.lit(0).cast("bigint"), F.col("i") - window), F.col("i"))).alias("j"))


def rope(spark: SparkSession, positions: int, rotary: int, base: float) -> DataFrame:
    """(position, pair, cos, sin) of rotary position frequencies."""
    rows = spark.range(positions).select(F.col("id").alias("position"), F.explode(F.sequence(F.lit(0), F.lit(rotary // 2 - 1))).alias("pair"))
    angle = F.col("position") / F.pow(F.lit(base), 2 * F.col("pair") / F.lit(float(rotary)))
    return rows.select("position", "pair", F.cos(angle).alias("cos"), F.sin(angle).alias("sin"))
