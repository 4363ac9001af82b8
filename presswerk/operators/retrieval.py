"""Lexical and dense retrieval and their fusion, for all interests in one plan.

Queries are a small table of a checked size; only postings of its terms are made, vectors are scored in blocks against
the whole table of queries, and only ranked candidates travel further.
"""

from __future__ import annotations

import dataclasses
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from presswerk.functions.similarity import dot
from presswerk.functions.text import norm_text, unicode_tokens
from presswerk.session import cut_lineage, spread


@dataclasses.dataclass(frozen=True)
class RetrievalConfig:
    """Parameters of a run; `preset` gives the usual sets."""

    dense_per_anchor: int = 300
    dense_per_expansion: int = 120
    title_k: int = 80
    body_k: int = 120
    rrf_k: int = 60
    candidate_cap: int = 800
    top_k: int = 20
    min_sim: float = 0.15
    min_bm25: float = 0.05
    threshold_mode: str = "both"
    #: Only vectors dated within so many days are searched, 0 for all; lexical search takes all.
    days: int = 0

    @classmethod
    def preset(cls, name: str) -> RetrievalConfig:
        if name == "default":
            return cls()
        if name == "wide":
            return cls(600, 250, 150, 300, 60, 2500, 1300, 0.0, 0.0)
        raise ValueError(f"no preset {name}")


K1, B, EPSILON = 1.5, 0.75, 0.25
#: Bounds of one run: query specs, and their terms, which make local tables of a few MB at most.
MAX_SPECS, MAX_TERMS = 20_000, 100_000
#: Scores that a task holds at a time.
BLOCK_CELLS = 1 << 22


def _raw_idf(n: Column, df: Column) -> Column:
    return F.log(n - df + 0.5) - F.log(df + 0.5)


def corpus_size(docs: DataFrame) -> DataFrame:
    """One row (n, avgdl) of docs (id, text)."""
    return docs.select(F.size(unicode_tokens(F.col("text"))).alias("dl")).agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))


def _raw_vocabulary(docs: DataFrame, size: DataFrame) -> DataFrame:
    """(term, df, raw) of every term; a document's terms are told apart inside its row, so only counts are shuffled."""
    terms = docs.select(F.explode(F.array_distinct(unicode_tokens(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return terms.crossJoin(F.broadcast(size)).select("term", "df", _raw_idf(F.col("n"), F.col("df")).alias("raw"))  # one row


def vocabulary(docs: DataFrame, size: DataFrame) -> DataFrame:
    """(term, df, idf) of every term of docs (id, text); a negative idf is replaced by a share of the mean one."""
    raw = _raw_vocabulary(docs, size)
    return raw.crossJoin(F.broadcast(raw.agg(F.avg("raw").alias("mean")))).select("term", "df", F.when(F.col("raw") < 0, F.lit(EPSILON) * F.col("mean")).otherwise(F.col("raw")).alias("idf"))  # one row


def term_postings(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Postings (id, term, tf, dl) of docs (id, text); with `terms` only theirs, filtered before anything is shuffled."""
    words = docs.select("id", unicode_tokens(F.col("text")).alias("w"))
    words = words.select("id", F.size("w").alias("dl"), F.explode("w").alias("term"))
    if terms is not None:
        words = words.join(terms, "term", "left_semi")
    return words.groupBy("id", "dl", "term").agg(F.count("*").alias("tf"))


def query_terms(queries: DataFrame) -> DataFrame:
    """(q, term, qtf) of queries (q, text) as a local table; a run's queries are few, and too many terms are an error."""
    terms = queries.select("q", F.explode(unicode_tokens(F.col("text"))).alias("term")).groupBy("q", "term").agg(F.count("*").alias("qtf"))
    rows = terms.limit(MAX_TERMS + 1).collect()
    if len(rows) > MAX_TERMS:
        raise ValueError(f"a run has at most {MAX_TERMS} query terms")
    return terms.sparkSession.createDataFrame(rows, terms.schema)


def weigh(postings: DataFrame, weights: DataFrame, average_length: float) -> DataFrame:
    """(q, id, score), positive only, from postings, weights (q, term, weight) and the mean length of the documents."""
    hits = postings.join(F.broadcast(weights), "term")  # at most MAX_TERMS rows
    part = F.col("weight") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.lit(average_length)))
    return hits.groupBy("q", "id").agg(F.sum(part).alias("score")).where("score > 0")


def bm25_scores(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """(q, id, score) with positive scores, from docs (id, text) and queries (q, text); query words count as often as they stand.

    Only postings of the queries' terms are made, and their document frequencies come from these. The whole vocabulary
    is counted only if a term stands in more than half of the documents, as its idf is then a share of the mean one.
    """
    docs, terms = spread(docs), query_terms(queries)
    size = corpus_size(docs).first()
    if not size.n or not size.avgdl:
        return docs.limit(0).select(F.lit("").alias("q"), "id", F.lit(0.0).alias("score"))
    n, length = int(size.n), float(size.avgdl)
    wanted = terms.select("term").distinct()
    postings = cut_lineage(term_postings(docs, F.broadcast(wanted)), "postings")  # at most MAX_TERMS rows
    known = {r.term: math.log(n - r.df + 0.5) - math.log(r.df + 0.5) for r in postings.groupBy("term").agg(F.count("*").alias("df")).collect()}  # at most MAX_TERMS rows
    if any(raw < 0 for raw in known.values()):
        row = docs.sparkSession.createDataFrame([(n, length)], "n long, avgdl double")
        mean = _raw_vocabulary(docs, row).agg(F.avg("raw")).first()[0]
        known = {term: EPSILON * mean if raw < 0 else raw for term, raw in known.items()}
    weights = docs.sparkSession.createDataFrame([(r.q, r.term, r.qtf * known[r.term]) for r in terms.collect() if r.term in known], "q string, term string, weight double")
    return weigh(postings, weights, length)


class Bm25Index:
    """A written index: postings in buckets of terms, vocabulary and size; a query reads the buckets of its terms only."""

    BUCKETS = 256

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @staticmethod
    def signature(docs: DataFrame, fingerprint_col: str | None = None) -> str:
        """A hash over ids (and fingerprints) that does not depend on their order."""
        key = F.xxhash64("id", fingerprint_col) if fingerprint_col else F.xxhash64("id")
        n, total, mixed = docs.agg(F.count("*"), F.coalesce(F.sum(F.pmod(key, F.lit(1 << 31))), F.lit(0)), F.coalesce(F.bit_xor(key), F.lit(0))).first()
        return f"{n}-{total}-{mixed}"

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def build(self, docs: DataFrame, signature: str = "") -> Bm25Index:
        """Write the index of docs (id, text); the signature comes last, so a build that broke off is not taken for one."""
        docs, bucket = spread(docs), F.pmod(F.xxhash64("term"), F.lit(self.BUCKETS)).cast("int")
        corpus_size(docs).write.mode("overwrite").parquet(f"{self.path}/size")
        vocabulary(docs, self._table("size")).withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/vocabulary")
        # Frequent terms fill their bucket; several tasks share one, and rows are in order of terms for the scan's filter.
        spread_out = term_postings(docs).withColumn("bucket", bucket).repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(8)))
        spread_out.sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/postings")
        self.spark.createDataFrame([(signature,)], "signature string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/signature")
        return self

    def is_current(self, signature: str) -> bool:
        try:
            return self._table("signature").first()[0] == signature
        except Exception:  # noqa: BLE001 - no index there, or half of one
            return False

    def load_or_build(self, docs: DataFrame, fingerprint_col: str | None = None) -> Bm25Index:
        now = self.signature(docs, fingerprint_col)
        return self if self.is_current(now) else self.build(docs.select("id", "text"), now)

    def scores(self, queries: DataFrame) -> DataFrame:
        """As `bm25_scores`, from the buckets of the queries' terms."""
        terms = query_terms(queries)
        wanted = sorted({r.term for r in terms.collect()})
        buckets = [r[0] for r in terms.select(F.pmod(F.xxhash64("term"), F.lit(self.BUCKETS)).cast("int")).distinct().collect()]  # at most BUCKETS
        inside = F.col("bucket").isin(buckets) & F.col("term").isin(wanted)
        known = {r.term: r.idf for r in self._table("vocabulary").where(inside).select("term", "idf").collect()}  # at most MAX_TERMS rows
        weights = self.spark.createDataFrame([(r.q, r.term, r.qtf * known[r.term]) for r in terms.collect() if r.term in known], "q string, term string, weight double")
        size = self._table("size").first()
        return weigh(self._table("postings").where(inside).drop("bucket"), weights, float(size.avgdl or 0.0))


def rank_within(df: DataFrame, keys: list[str], score: str, id_col: str, k: int | None = None, name: str = "rank") -> DataFrame:
    """Rank by the rounded score, ties by id; the limit prunes within partitions before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.round(score, 8).desc(), F.col(id_col))
    out = df.withColumn(name, F.row_number().over(w))
    return out if k is None else out.where(F.col(name) <= k)


def bounded_specs(specs: DataFrame, *columns: str) -> list:
    """The rows of a run's query specs, which are few for each interest; too many of them are an error."""
    rows = specs.select(*columns).limit(MAX_SPECS + 1).collect()
    if len(rows) > MAX_SPECS:
        raise ValueError(f"a run has at most {MAX_SPECS} query specs")
    return rows


def dense_topk(vectors: DataFrame, specs: DataFrame, k: int, id_col: str = "id", vec_col: str = "vec") -> DataFrame:
    """(q, id, score, rank): the k most similar vectors for each row (q, vec) of the small table `specs`.

    Blocks of vectors are multiplied with all queries; a partition keeps its best k of a query and gives them once, at
    its end, so what is shuffled does not grow with the number of batches. Null vectors take no part.
    """
    rows = bounded_specs(specs, "q", "vec")
    kind = dict(vectors.dtypes)[id_col]
    if not rows or k <= 0:
        return vectors.select(F.lit("").alias("q"), F.col(id_col).alias("id"), F.lit(0.0).alias("score"), F.lit(0).alias("rank")).limit(0)
    names = [r[0] for r in rows]
    matrix = np.array([r[1] for r in rows], dtype=np.float64)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True) + 1e-12
    id_type = pa.string() if kind == "string" else pa.int64()

    def best(batches):
        kept: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0), np.empty(0, dtype=np.int64))] * len(names)
        step = max(1, BLOCK_CELLS // max(len(names), matrix.shape[1]))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                data = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(part.num_rows, matrix.shape[1])
                data /= np.linalg.norm(data, axis=1, keepdims=True) + 1e-12
                scores, ids = np.round(data @ matrix.T, 8), np.array(part.column(0).to_pylist())
                for j in range(len(names)):
                    old, names_old = kept[j]
                    near = np.flatnonzero(scores[:, j] >= old[-1]) if len(old) == k else np.arange(len(ids))
                    if len(near):
                        both, all_ids = np.concatenate([old, scores[near, j]]), np.concatenate([names_old, ids[near]]) if len(old) else ids[near]
                        order = np.lexsort((all_ids, -both))[:k]
                        kept[j] = both[order], all_ids[order]
        out = [(q, ids, scores) for q, (scores, ids) in zip(names, kept, strict=True) if len(scores)]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([q for q, ids, _ in out for _ in ids], pa.string()), pa.array(np.concatenate([x[1] for x in out]).tolist(), id_type), pa.array(np.concatenate([x[2] for x in out]))], names=["q", "id", "score"]
            )

    found = vectors.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("string" if kind == "string" else "long").alias("id"), F.col(vec_col).alias("vec"))
    return rank_within(found.mapInArrow(best, f"q string, id {'string' if kind == 'string' else 'long'}, score double"), ["q"], "score", "id", k)


def recent(vectors: DataFrame, days: int, as_of: str | None = None, date_col: str = "date") -> DataFrame:
    """The vectors dated not more than `days` before `as_of` (by default now); null dates are out. 0 days are no limit."""
    if days <= 0:
        return vectors
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return vectors.where((F.col(date_col) >= now - F.make_interval(days=F.lit(days))) & (F.col(date_col) < now))


def rrf(hits: DataFrame, keys: list[str], weight: Column | float = 1.0, rank_col: str = "rank", k: int = 60) -> DataFrame:
    """Weighted reciprocal-rank fusion: sum of weight / (k + rank) over the hits of a key."""
    return hits.where(F.col(rank_col) > 0).groupBy(*keys).agg(F.sum((weight if isinstance(weight, Column) else F.lit(weight)) / (F.lit(k) + F.col(rank_col))).alias("rrf"))


def minmax(col: str, keys: list[str]) -> Column:
    """Min-max over the positive values of a key: the least becomes 0, equal values 1, none positive 0."""
    w = Window.partitionBy(*keys)
    x = F.col(col)
    positive = F.when(x > 0, x)
    low, high = F.min(positive).over(w), F.max(positive).over(w)
    return F.when(x.isNull() | (x <= 0) | high.isNull(), F.lit(0.0)).when(high - low <= 1e-12, F.lit(1.0)).otherwise((x - low) / (high - low))


def merge_specs(specs: DataFrame) -> DataFrame:
    """One spec for each normal form of the text of an interest: anchors first with weight 1, else the heaviest; first seen order."""
    keyed = specs.withColumn("key", norm_text(F.col("text"))).where("key <> ''")
    keyed = keyed.withColumn("weight", F.when(F.col("kind") == "anchor", F.lit(1.0)).otherwise(F.col("weight")))
    best = Window.partitionBy("interest", "key").orderBy((F.col("kind") == "anchor").desc(), F.col("weight").desc(), F.col("q_pos"))
    place = Window.partitionBy("interest", "key")
    kept = keyed.withColumn("first_pos", F.min("q_pos").over(place)).withColumn("r", F.row_number().over(best)).where("r = 1")
    order = Window.partitionBy("interest").orderBy("first_pos")
    return kept.withColumn("q_pos", F.row_number().over(order)).drop("r", "first_pos", "key")


def spec_weight(anchor: Column, vec: Column) -> Column:
    """Similarity to the anchor, held between 0.15 and 0.45; 0.30 if it is not a number."""
    d = dot(anchor, vec)
    return F.when(d.isNull() | F.isnan(d), F.lit(0.30)).otherwise(F.least(F.greatest(d, F.lit(0.15)), F.lit(0.45)))


def similarity_features(candidates: DataFrame, vectors: DataFrame, specs: DataFrame) -> DataFrame:
    """(interest, id, dense_max, dense_cov): largest, and mean of the two largest, weighted similarities, held in [0, 1]."""
    queries = specs.select("interest", "q_pos", "weight", F.col("vec").alias("q_vec"))
    pairs = candidates.select("interest", "id").join(vectors, "id").join(queries, "interest")  # the optimizer knows the size of both sides
    sims = pairs.select("interest", "id", (F.col("weight") * dot(F.col("vec"), F.col("q_vec"))).alias("s")).groupBy("interest", "id").agg(F.sort_array(F.collect_list("s"), False).alias("s"))  # one value for each spec of an interest
    hold = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    return sims.select("interest", "id", hold(F.col("s")[0]).alias("dense_max"), hold(F.when(F.size("s") > 1, (F.col("s")[0] + F.col("s")[1]) / 2).otherwise(F.col("s")[0])).alias("dense_cov"))


def passes(dense_max: Column, lex_max: Column, min_sim: float, min_bm25: float, mode: str = "both") -> Column:
    """'both' drops a candidate that misses both limits, 'any' one that misses either."""
    if mode == "any":
        return (dense_max >= min_sim) & (lex_max >= min_bm25)
    return ~((dense_max < min_sim) & (lex_max < min_bm25))


def final_score(rrf_norm: Column, dense_max: Column, dense_cov: Column, lex_norm: Column) -> Column:
    return 0.45 * rrf_norm + 0.30 * dense_max + 0.15 * dense_cov + 0.10 * lex_norm


def retrieve(docs: DataFrame, vectors: DataFrame, specs: DataFrame, config: RetrievalConfig, langs: list[str] | None = None, as_of: str | None = None) -> DataFrame:
    """(interest, rank, id, score) over docs (id, title, body, lang), vectors (id, vec, and date for `days`) and merged specs, in one plan."""
    searched, vectors = recent(vectors, config.days, as_of), vectors.select("id", "vec")
    specs = specs.withColumn("q", F.concat_ws("#", "interest", F.col("q_pos").cast("string"))).select("q", "interest", "q_pos", "text", "weight", "kind", F.col("vec").cast("array<double>").alias("vec"))
    # As a local table of a checked size they are planned once, not in every branch.
    specs = specs.sparkSession.createDataFrame(bounded_specs(specs, *specs.columns), specs.schema)
    small = F.broadcast(specs.select("q", "interest", "weight"))  # at most MAX_SPECS rows
    dense = []
    for kind, k in (("anchor", config.dense_per_anchor), ("expansion", config.dense_per_expansion)):
        if k > 0:
            dense.append(dense_topk(searched, specs.where(F.col("kind") == kind), k))
    # Ranked hits are at most k for a spec; written down, they are not computed again for each of their uses.
    found = cut_lineage(dense[0] if len(dense) == 1 else dense[0].unionByName(dense[1]), "dense-hits")
    dense_rrf = rrf(found.join(small, "q"), ["interest", "id"], F.col("weight"), k=config.rrf_k).withColumnRenamed("rrf", "dense_rrf")
    lexical = []
    for field, k in (("title", config.title_k), ("body", config.body_k)):
        scored = bm25_scores(docs.select("id", F.col(field).alias("text")), specs.select("q", "text"))
        lexical.append(rank_within(scored, ["q"], "score", "id", k))
    lex = cut_lineage(lexical[0].unionByName(lexical[1]), "lexical-hits").join(small, "q")
    lexical_rrf = lex.groupBy("interest", "id").agg(F.sum(F.col("weight") / (config.rrf_k + F.col("rank"))).alias("lex_rrf"), F.max(F.col("weight") * F.col("score")).alias("lex_best"))
    both = dense_rrf.join(lexical_rrf, ["interest", "id"], "full").na.fill(0.0, ["dense_rrf", "lex_rrf", "lex_best"])
    fused = both.withColumn("fused", 0.65 * minmax("dense_rrf", ["interest"]) + 0.35 * minmax("lex_rrf", ["interest"]))
    capped = rank_within(fused, ["interest"], "fused", "id", max(1, config.candidate_cap), "place")
    kept = capped.join(docs.select("id", "lang"), "id")
    if langs:
        kept = kept.where(F.lower("lang").isin([x.lower() for x in langs]))
    features = similarity_features(kept, vectors, specs)
    scored = kept.join(features, ["interest", "id"])
    scored = scored.withColumn("again", 0.65 * minmax("dense_rrf", ["interest"]) + 0.35 * minmax("lex_rrf", ["interest"])).withColumn("lex_norm", minmax("lex_best", ["interest"]))
    scored = scored.where(passes(F.col("dense_max"), F.col("lex_norm"), config.min_sim, config.min_bm25, config.threshold_mode))
    scored = scored.withColumn("score", final_score(F.col("again"), F.col("dense_max"), F.col("dense_cov"), F.col("lex_norm")))
    return rank_within(scored, ["interest"], "score", "id", config.top_k).select("interest", "rank", "id", "score", "dense_max", "dense_cov", "lex_norm")
