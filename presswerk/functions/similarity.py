"""Similarities that have no native expression: the indel ratio by bit-parallel LCS, and accent-free text keys."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, one big-integer step for each character of `b` (Hyyrö 2004)."""
    if not a or not b:
        return 0
    if len(a) < len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        hit = state & masks.get(c, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def indel_ratio(a: str | None, b: str | None) -> float:
    """2 x LCS / (length + length); 0 if either is empty."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    return 2.0 * lcs_length(a, b) / (len(a) + len(b))


def text_key(text: str | None) -> str:
    """Lower-cased letters and digits only, without accents."""
    plain = unicodedata.normalize("NFKD", text or "")
    return "".join(c for c in plain.lower() if c.isalnum() and not unicodedata.combining(c))


def ascii_text(text: str | None) -> str:
    return unicodedata.normalize("NFKD", text or "").encode("ascii", "ignore").decode("ascii")


def slug_text(text: str | None, longest: int = 120, fallback: str = "unknown_interest") -> str:
    """A file name of a text: lower-cased letters and digits without accents, the rest underscores."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", (text or "").strip().lower()) if not unicodedata.combining(c))
    return (re.sub(r"[^a-z0-9]+", "_", plain).strip("_") or fallback)[:longest]


@F.pandas_udf(DoubleType())
def indel_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([indel_ratio(x, y) for x, y in zip(a, b, strict=True)])


@F.pandas_udf(StringType())
def text_key_udf(text: pd.Series) -> pd.Series:
    return text.map(text_key)


def ratio_bound(a: Column, b: Column) -> Column:
    """The largest ratio that two lengths allow; a native filter before the ratio itself."""
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0)).otherwise(2.0 * F.least(F.length(a), F.length(b)) / (F.length(a) + F.length(b)))


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return dot / (norm(a) * norm(b) + F.lit(1e-12))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
