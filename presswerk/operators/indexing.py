"""Embeddings and the vector index: a pluggable embedder in Arrow batches and a keyed Parquet table of vectors."""

from __future__ import annotations

import hashlib
import re
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswerk.operators.retrieval import dense_topk, recent
from presswerk.operators.store import KeyedTable

_WORD = re.compile(r"\w+")


class Embedder(Protocol):
    """Turns texts into rows of a matrix, each of length one."""

    dims: int

    def encode(self, texts: list[str], batch_size: int = 32) -> np.ndarray: ...


class HashedEmbedder:
    """Offline embedder: a bag of words hashed into signed buckets, of length one."""

    def __init__(self, dims: int = 256):
        self.dims, self._known = dims, {}

    def _place(self, word: str) -> tuple[int, float]:
        if word not in self._known:
            if len(self._known) > 200_000:
                self._known.clear()
            digest = hashlib.md5(word.encode()).hexdigest()
            self._known[word] = int(digest[:8], 16) % self.dims, 1.0 if int(digest[8], 16) < 8 else -1.0
        return self._known[word]

    def encode(self, texts: list[str], batch_size: int = 32) -> np.ndarray:
        out = np.zeros((len(texts), self.dims))
        for i, text in enumerate(texts):
            for word in _WORD.findall((text or "").lower()):
                bucket, sign = self._place(word)
                out[i, bucket] += sign
        return (out / (np.linalg.norm(out, axis=1, keepdims=True) + 1e-12)).astype(np.float32)


def embed(df: DataFrame, embedder: Embedder, id_col: str = "id", text_col: str = "text", batch_size: int = 32) -> DataFrame:
    """(id, vec) of the rows with an id; a null text is an empty one. The embedder is sent once to each worker."""
    kind = "string" if dict(df.dtypes)[id_col] == "string" else "long"

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                vectors = embedder.encode([x or "" for x in part.column(1).to_pylist()], batch_size).astype(np.float32)
                flat = pa.array(np.ascontiguousarray(vectors).reshape(-1))
                offsets = pa.array(np.arange(0, vectors.size + 1, vectors.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, flat)], names=["id", "vec"])

    return df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast(kind).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, vec array<float>")


class VectorIndex:
    """Vectors by id in a keyed table: upsert, scan of ids, fetch by id, top-k search."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = KeyedTable(spark, path, ["id"])

    def recreate(self) -> VectorIndex:
        self.table.clear()
        return self

    def ids(self) -> DataFrame:
        return self.table.read().select("id")

    def fetch(self, ids: DataFrame) -> DataFrame:
        """The rows of the ids of `ids` (id)."""
        return self.table.read().join(ids.select("id").distinct(), "id", "left_semi")

    def upsert(self, vectors: DataFrame) -> None:
        self.table.write(vectors)

    def index(self, docs: DataFrame, embedder: Embedder, reindex: bool = False, resume: bool = False, id_col: str = "id", text_col: str = "text") -> int:
        """Embed docs into the index and say how many: `reindex` empties it first, `resume` takes only ids it lacks."""
        if reindex and resume:
            raise ValueError("an index is made anew or resumed, not both")
        if reindex:
            self.recreate()
        if resume and self.table.exists():
            docs = docs.join(self.ids().withColumnRenamed("id", "__id"), F.col(id_col) == F.col("__id"), "left_anti")
        return self.table.write(embed(docs, embedder, id_col, text_col))

    def search(self, specs: DataFrame, k: int, days: int = 0, as_of: str | None = None) -> DataFrame:
        """(q, id, score, rank); with `days` only vectors whose `date` is not older at `as_of`, null dates are out."""
        return dense_topk(recent(self.table.read(), days, as_of), specs, k)
