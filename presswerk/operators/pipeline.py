"""Retrieve, deduplicate, rerank, write: one plan for each stage, run ids as columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswerk.operators import dedup, rerank, retrieval, writing
from presswerk.functions.text import retrieval_fingerprint
from presswerk.session import cut_lineage


def run(docs: DataFrame, vectors: DataFrame, specs: DataFrame, config: retrieval.RetrievalConfig, scorer=None, generator=None, top_n: int = 10) -> dict[str, DataFrame]:
    """The feeds of all interests: lazy frames of hits, kept hits, reranked hits and written summaries."""
    scorer, generator = scorer or rerank.OverlapScorer(), generator or writing.LeadGenerator()
    # Hits are few and used twice; what comes after must not run the retrieval again.
    hits = cut_lineage(retrieval.retrieve(docs, vectors, retrieval.merge_specs(specs), config), "hits")
    url = F.col("url") if "url" in docs.columns else F.lit(None).cast("string")
    domain = F.coalesce("source", F.lit("")) if "source" in docs.columns else F.lit("")
    full = hits.join(docs, "id").select("interest", "rank", "score", F.col("id").cast("string").alias("id"), url.alias("url"), retrieval_fingerprint(url, F.col("title"), F.col("body")).alias("fingerprint"), "title", "body", domain.alias("domain"), "lang")
    kept = dedup.dedup_hits(dedup.prepare(full)).where("rank > 0").select("interest", F.col("rank").alias("dense_rank"), "id")
    texts = full.select("interest", "id", "title", F.col("body").alias("text"), "lang")
    scored = rerank.score_hits(kept.join(texts, ["interest", "id"]), scorer)
    best = rerank.collapse(scored, scorer, top_n)
    written = writing.write_hits(best.join(texts, ["interest", "id"]).select("interest", "rank", "id", "title", "lang", "text"), generator)
    return {"hits": hits, "kept": kept, "reranked": best, "written": written}
