"""Pluggable models with deterministic offline defaults. Python workers run only here and in extract_pages."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.text import WHITE, similarity, strip

MAX_CHARS = 8000


class Embedder(Protocol):
    dim: int

    def embed(self, texts: Sequence[str]) -> list[list[float]]: ...


class HashingEmbedder:
    """Feature hashing of lower-cased words into dim signed counts, scaled to length 1."""

    def __init__(self, dim: int = 1536, max_chars: int = MAX_CHARS):
        self.dim, self.max_chars = dim, max_chars

    def embed(self, texts: Sequence[str]) -> list[list[float]]:
        import zlib

        out = []
        for text in texts:
            v = np.zeros(self.dim, np.float64)
            for word in (text or "")[: self.max_chars].lower().split():
                h = zlib.crc32(word.encode())
                v[h % self.dim] += 1.0 if h >> 31 else -1.0
            n = np.linalg.norm(v)
            out.append((v / n if n else v).astype(np.float32).tolist())
        return out

    def embed_one(self, text: str) -> list[float]:
        return self.embed([text])[0]


def embed_column(df: DataFrame, embedder: Embedder, *, text_col: str = "text", out: str = "embedding") -> DataFrame:
    """df with an embedding of text_col; each distinct text is embedded once and joined back."""

    @F.pandas_udf("array<float>")
    def embed(texts: pd.Series) -> pd.Series:
        return pd.Series(embedder.embed(list(texts)))

    texts = df.select(F.col(text_col).alias("_t")).distinct().withColumn(out, embed(F.coalesce("_t", F.lit(""))))
    return df.join(texts, df[text_col].eqNullSafe(texts["_t"]), "left").drop("_t")


def _words(x: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit(f"[^{WHITE}]+"), F.lit(0)))


def overlap_score(query: Column, text: Column) -> Column:
    """Default reranker: the share of the query's distinct words that the text holds."""
    q = _words(query)
    return F.when(F.size(q) == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(q, _words(text))) / F.size(q).cast("double"))


def entailed(claim: Column, source: Column, least: float = 0.6) -> Column:
    """Default entailment: at least that share of the claim's distinct words is in the source."""
    return overlap_score(claim, source) >= least


def sentences(x: Column) -> Column:
    """Stripped sentences: ends are . ! ? followed by white space."""
    return F.filter(F.transform(F.split(x, r"(?<=[.!?])\s+"), strip), lambda s: s != "")


def g_eval_score(completion: Column) -> Column:
    """1 to 5 from Score: n or n/5 in a judge's answer; 1.0 without one."""
    found = F.coalesce(F.nullif(F.regexp_extract(completion, r"(?i)score:\s*([1-5](?:\.\d+)?)", 1), F.lit("")), F.nullif(F.regexp_extract(completion, r"([1-5](?:\.\d+)?)\s*/\s*5", 1), F.lit("")))
    return F.least(F.lit(5.0), F.greatest(F.lit(1.0), F.coalesce(found.cast("double"), F.lit(1.0))))


def fuzzy_contains(name: Column, text: Column, least: float = 0.85) -> Column:
    """Whether the text holds the name, ignoring case, or a run of as many words that is that similar to it."""
    words = F.regexp_extract_all(F.lower(text), F.lit(f"[^{WHITE}]+"), F.lit(0))
    n = F.size(F.regexp_extract_all(name, F.lit(f"[^{WHITE}]+"), F.lit(0)))
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - n + 1)), lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.lower(text).contains(F.lower(name)) | F.coalesce(F.exists(runs, lambda r: similarity(r, name) >= least), F.lit(False))
