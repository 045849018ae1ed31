"""Text kernels: normalisation and folding (Arrow), buckets and counts (native)."""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import values as V
from .hashing import fingerprint

_control = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_blanks = re.compile(r"[\t\f\v ]+")
_gaps = re.compile(r"\n{3,}")


def clean(text: str) -> str:
    """Line ends to LF, NFKC, no control characters, single blanks, stripped lines, one empty line at most."""
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    text = _blanks.sub(" ", _control.sub("", unicodedata.normalize("NFKC", text)))
    text = "\n".join(map(str.strip, text.split("\n")))
    return (_gaps.sub("\n\n", text) if "\n\n\n" in text else text).strip()


@F.pandas_udf(T.StringType())
def normalize_text(s: pd.Series) -> pd.Series:
    """`clean` of each string; null stays null."""
    return s.map(clean, na_action="ignore")


@F.pandas_udf(T.StringType())
def casefold(s: pd.Series) -> pd.Series:
    """Unicode case folding, which no built-in does."""
    return s.map(str.casefold, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def normalize_parts(s: pd.Series) -> pd.Series:
    """`clean` of every string of an array in one trip to Python."""
    return s.map(lambda xs: None if xs is None else [None if x is None else clean(x) for x in xs])


_KERNEL = T.StructType([T.StructField("parts", T.ArrayType(T.StringType())), T.StructField("text", T.StringType()), T.StructField("text_sha256", T.StringType()), T.StructField("fp", T.LongType())])


def _kernel(xs, width: int) -> tuple:
    parts = [None if x is None else clean(x) for x in xs]
    text = "\n".join(x for x in parts if x)
    # cleaning once more changes something only where control characters have gone
    whole = clean(text) if any(x is not None and _control.search(x) for x in xs) else text
    digest = hashlib.sha256(whole.casefold().encode("utf-8", "surrogatepass")).hexdigest()
    return parts, text, digest, fingerprint(text, width) if width else None


@F.pandas_udf(_KERNEL)
def text_kernel(s: pd.Series) -> pd.DataFrame:
    """Parts of each record cleaned, joined to its text, and hashed for exact duplicates, in one trip to Python.

    The hash is SHA-256 of the folded text after it is cleaned once more as a whole.
    """
    return pd.DataFrame([_kernel(xs, 0) for xs in s], columns=_KERNEL.names).astype({"fp": "Int64"})


def text_kernel_with_print(width: int):
    """text_kernel that also takes the SimHash fingerprint of word n-grams of this width."""

    @F.pandas_udf(_KERNEL)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_kernel(xs, max(1, width)) for xs in s], columns=_KERNEL.names)

    return run


def simple_fold(c: Column) -> Column:
    """Folding by built-ins: right for text whose only special fold is the sharp s."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def strip_py(c: Column) -> Column:
    """Strip Unicode white space at both ends."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+", ""), r"(?U)[\s\x1c-\x1f]+$", "")


_LINE_END = r"(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\u0085\u2028\u2029])"


def lines(c: Column) -> Column:
    """The lines of a text, without an empty one after the last line end; empty text has none."""
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(c, _LINE_END + r"\z", ""), _LINE_END, -1))


def join_fields(*parts: Column) -> Column:
    """Newline-join of the non-empty strings."""
    return F.concat_ws("\n", *(F.nullif(p, F.lit("")) for p in parts))


def distinct_line_ratio(c: Column) -> Column:
    """Distinct share of the non-blank lines; null without any."""
    kept = F.filter(lines(c), lambda x: F.rlike(x, F.lit(r"(?U)[^\s\x1c-\x1f]")))
    # an array of one binds the lines to a name, so that they are made once
    share = F.transform(F.filter(F.array(kept), lambda k: F.size(k) > 0), lambda k: F.size(F.array_distinct(k)) / F.size(k).cast("double"))
    return F.get(share, F.lit(0))


def estimated_tokens(c: Column) -> Column:
    return F.greatest(F.lit(1), F.floor((F.length(c) + 3) / 4)).cast("bigint")


def boundaries(lengths) -> list[int]:
    out = sorted({int(x) for x in lengths if int(x) > 0})
    if not out:
        raise ValueError("context lengths must hold a positive value")
    return out


def context_bucket(n: Column, lengths=V.CONTEXT_LENGTHS) -> Column:
    """B4K and so on by the least length that n does not exceed, else gt_."""
    b = boundaries(lengths)
    out = F.lit(f"gt_{b[-1] // 1024}K")
    for x in reversed(b):
        out = F.when(n <= x, f"B{x // 1024}K").otherwise(out)
    return out


def length_bucket(n: Column, lengths=V.CONTEXT_LENGTHS) -> Column:
    b = boundaries(lengths)
    out = F.lit(f"gt_{b[-1] // 1024}K")
    for low, x in reversed(list(zip([0, *b], b))):
        out = F.when(n <= x, f"{low + 1}_{x}").otherwise(out)
    return out


def loss_mask(targets: Column, ignore: int = V.IGNORE_INDEX) -> Column:
    return F.transform(targets, lambda t: F.when(t == ignore, 0).otherwise(1))


def chat_text(messages: Column) -> Column:
    """ChatML of array<struct<role, content>> turns."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit(V.TURN_START), m.role, F.lit("\n"), F.coalesce(m.content, F.lit("")), F.lit(V.TURN_END + "\n"))), "")


def chat_text_with_reasoning(messages: Column) -> Column:
    """As chat_text, for turns that have a reasoning_content field."""
    think = lambda m: F.when((m.role == "assistant") & (F.length(m.reasoning_content) > 0), F.concat(F.lit(V.THINK_START), m.reasoning_content, F.lit(V.THINK_END + "\n"))).otherwise("")
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit(V.TURN_START), m.role, F.lit("\n"), think(m), F.coalesce(m.content, F.lit("")), F.lit(V.TURN_END + "\n"))), "")


def chat_template() -> str:
    """The same rendering as a Jinja template, for tokenizer files."""
    think = "{% if message.role == 'assistant' and message.reasoning_content %}" + V.THINK_START + "{{ message.reasoning_content }}" + V.THINK_END + "\n{% endif %}"
    return "{% for message in messages %}" + V.TURN_START + "{{ message.role }}\n" + think + "{{ message.content }}" + V.TURN_END + "\n{% endfor %}"
