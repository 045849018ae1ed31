"""Stable hashes, SimHash fingerprints and their bands."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_token = re.compile(r"\w+")


def sha256_text(c: Column) -> Column:
    return F.sha2(c, 256)


def stable_key(c: Column, seed: str | Column, method: str = "md5") -> Column:
    """Hexadecimal sort key of (seed, NUL, key): md5 in the JVM, or BLAKE2b-128 through Arrow.

    Lower-case hexadecimal digits sort as the bytes do.
    """
    seed = F.lit(seed) if isinstance(seed, str) else seed
    joined = F.concat(seed, F.lit("\0"), c.cast("string"))
    if method == "md5":
        return F.md5(joined)
    if method == "blake2b":
        return blake2b(joined, F.lit(16))
    raise ValueError(f"unknown method {method!r}")


@F.pandas_udf(T.StringType())
def blake2b(s: pd.Series, size: pd.Series) -> pd.Series:
    """Hexadecimal BLAKE2b digest of so many bytes."""
    return pd.Series([None if x is None else hashlib.blake2b(x.encode(), digest_size=int(n)).hexdigest() for x, n in zip(s, size)])


def fingerprint(text: str, width: int = 5) -> int:
    """64-bit SimHash of a text's folded word n-grams, as a signed integer; 0 without a word.

    Every occurrence of an n-gram votes, and a tie sets the bit.
    """
    words = _token.findall(text.casefold())
    if not words:
        return 0
    width = max(1, width)
    count: dict[str, int] = {}
    for k in range(max(1, len(words) - width + 1)):
        g = " ".join(words[k : k + width])
        count[g] = count.get(g, 0) + 1
    digests = b"".join(hashlib.blake2b(g.encode("utf-8", "surrogatepass"), digest_size=8).digest() for g in count)
    bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).astype(np.int64)
    n = np.fromiter(count.values(), np.int64)
    votes = 2 * (n @ bits) - n.sum()
    return int.from_bytes(np.packbits(votes >= 0).tobytes(), "big", signed=True)


def simhash64(c: Column, width: int = 5) -> Column:
    @F.pandas_udf(T.LongType())
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else fingerprint(x, width) for x in s], dtype="Int64")

    return run(c)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def check_bands(threshold: int, bands: int) -> None:
    if 64 % bands or threshold >= bands:
        raise ValueError("bands must divide 64 and exceed the threshold")


def band_values(fp: Column, bands: int = 4) -> Column:
    """array<bigint> of the fingerprint's bit fields, low bits first."""
    width = 64 // bands
    mask = (1 << width) - 1 if width < 64 else -1
    return F.array(*(F.shiftrightunsigned(fp, k * width).bitwiseAND(F.lit(mask).cast("bigint")) for k in range(bands)))
