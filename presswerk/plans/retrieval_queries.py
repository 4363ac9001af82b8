"""Retrieval queries over documents (title: first line) and their embeddings, with oracle statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from presswerk.functions.similarity import cosine, dot
from presswerk.operators import evaluation
from presswerk.operators import retrieval as r
from presswerk.session import read_table

QUERY = "the satellite launch and the school meal programme"


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    first = F.substring(F.split(F.coalesce("text", F.lit("")), "\n")[0], 1, 120)
    return d.select(F.col("doc_id").alias("id"), first.alias("title"), F.coalesce("text", F.lit("")).alias("body"), F.coalesce("lang", F.lit("")).alias("lang"), "source", "url", "fetched_at")


def vectors(spark, sf_dir):
    return read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")


def interest_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An anchor for each label, its mean vector and the title of its first document, and the next six as expansions."""
    v = vectors(spark, sf_dir)
    titled = v.join(corpus(spark, sf_dir).select("id", "title"), "id").where("title <> ''")
    mean = v.select("label", F.posexplode("vec").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    norm = mean.groupBy("label").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("n"))
    anchors = mean.join(norm, "label").groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", (F.col("x") / F.col("n")).alias("x")))).alias("a")).select("label", F.col("a.x").alias("anchor"))
    numbered = titled.withColumn("q_pos", F.row_number().over(Window.partitionBy("label").orderBy("id"))).where("q_pos <= 7")
    specs = numbered.join(anchors, "label")
    is_anchor = F.col("q_pos") == 1
    return specs.select(
        F.concat(F.lit("topic "), F.col("label").cast("string")).alias("interest"), "q_pos", F.col("title").alias("text"),
        F.when(is_anchor, F.lit(1.0)).otherwise(r.spec_weight(F.col("anchor"), F.col("vec"))).alias("weight"),
        F.when(is_anchor, F.lit("anchor")).otherwise(F.lit("expansion")).alias("kind"), F.when(is_anchor, F.col("anchor")).otherwise(F.col("vec").cast("array<double>")).alias("vec"),
    )


CORPUS = "c AS (SELECT doc_id AS id, substr(split_part(coalesce(text,''), chr(10), 1), 1, 120) AS title, coalesce(text,'') AS body, coalesce(lang,'') AS lang FROM documents)"
SPECS = """v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings),
t AS (SELECT v.id, v.vec, v.label, c.title FROM v JOIN c USING (id) WHERE c.title <> ''),
ev AS (SELECT label, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM v),
am AS (SELECT label, i, avg(x) AS x FROM ev GROUP BY label, i), an AS (SELECT label, sqrt(sum(x*x)) AS n FROM am GROUP BY label),
av AS (SELECT am.label, list(x/n ORDER BY i) AS anchor FROM am JOIN an USING (label) GROUP BY am.label),
s AS (SELECT 'topic '||label AS interest, q_pos, title AS text, CASE WHEN q_pos = 1 THEN 1.0::DOUBLE ELSE least(greatest(list_inner_product(anchor, vec), 0.15), 0.45) END AS weight,
 CASE WHEN q_pos = 1 THEN 'anchor' ELSE 'expansion' END AS kind, CASE WHEN q_pos = 1 THEN anchor ELSE vec END AS vec, 'topic '||label||'#'||q_pos AS q
 FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY id) AS q_pos FROM t) JOIN av USING (label) WHERE q_pos <= 7)"""


def bm25_cte(field: str, queries: str, name: str) -> str:
    """CTEs that end in `name`(q, id, score): the same formula, in SQL."""
    p = name
    return rf"""{p}_w AS (SELECT id, regexp_extract_all(lower({field}), '[\p{{L}}\p{{N}}_]+') AS w FROM c),
{p}_n AS (SELECT count(*) AS n, avg(len(w)) AS avgdl FROM {p}_w),
{p}_p AS (SELECT id, dl, term, count(*) AS tf FROM (SELECT id, len(w) AS dl, unnest(w) AS term FROM {p}_w) GROUP BY id, dl, term),
{p}_r AS (SELECT term, count(*) AS df, ln((SELECT n FROM {p}_n) - count(*) + 0.5) - ln(count(*) + 0.5) AS raw FROM {p}_p GROUP BY term),
{p}_i AS (SELECT term, df, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM {p}_r) ELSE raw END AS idf FROM {p}_r),
{p}_q AS (SELECT q, term, count(*) AS qtf FROM (SELECT q, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS term FROM {queries}) GROUP BY q, term),
{p} AS (SELECT q, id, sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM {p}_p JOIN {p}_q USING (term) JOIN {p}_i USING (term), {p}_n GROUP BY q, id HAVING sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) > 0)"""


def ranked(name: str, k: str, keys: str = "q") -> str:
    return f"SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY round(score, 8) DESC, id) AS rank FROM {name} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY round(score, 8) DESC, id) <= {k}"


def one_query(spark):
    return spark.createDataFrame([("q", QUERY)], "q string, text string")


def a6_bm25_stats(spark, sf_dir):
    docs = corpus(spark, sf_dir).select("id", F.col("body").alias("text"))
    return r.vocabulary(docs, r.corpus_size(docs)).select("term", "df", F.round("idf", 6).alias("idf"))


def r7_bm25_topk(field, k):
    def run(spark, sf_dir):
        scores = r.bm25_scores(corpus(spark, sf_dir).select("id", F.col(field).alias("text")), one_query(spark))
        return r.rank_within(scores, ["q"], "score", "id", k).select("id", "rank", F.round("score", 6).alias("score"))

    return run


def t3_bm25_weighted(spark, sf_dir):
    c = corpus(spark, sf_dir)
    a, b = (r.bm25_scores(c.select("id", F.col(f).alias("text")), one_query(spark)).select("q", "id", F.col("score").alias(f)) for f in ("title", "body"))
    both = a.join(b, ["q", "id"], "full").select("q", "id", (0.7 * F.coalesce("title", F.lit(0.0)) + 0.3 * F.coalesce("body", F.lit(0.0))).alias("score"))
    return r.rank_within(both, ["q"], "score", "id", 50).select("id", "rank", F.round("score", 6).alias("score"))


def n37_cosine(spark, sf_dir):
    v = vectors(spark, sf_dir)
    first = v.where("id = 0").select(F.col("vec").alias("w"))
    return v.crossJoin(F.broadcast(first)).select("id", F.round(cosine(F.col("vec"), F.col("w")), 6).alias("cos"), F.round(F.least(F.greatest(dot(F.col("vec"), F.col("w")), F.lit(0.15)), F.lit(0.45)), 6).alias("held"))


def t2_dense_topk(spark, sf_dir):
    s = interest_specs(spark, sf_dir).withColumn("q", F.concat_ws("#", "interest", F.col("q_pos").cast("string")))
    return r.dense_topk(vectors(spark, sf_dir), s, 20).select("q", "id", "rank", F.round("score", 4).alias("score"))


def p4_window_dense(spark, sf_dir):
    """Dense top-k among documents fetched in the 400 days before a given day, languages en and fr."""
    c = corpus(spark, sf_dir).where(F.lower("lang").isin("en", "fr")).select("id", F.col("fetched_at").alias("date"))
    v = r.recent(vectors(spark, sf_dir).join(c, "id"), 400, "2026-02-01")
    s = interest_specs(spark, sf_dir).where("kind = 'anchor'").withColumn("q", F.concat_ws("#", "interest", F.col("q_pos").cast("string")))
    return r.dense_topk(v, s, 10).select("q", "id", "rank", F.round("score", 6).alias("score"))


def r3_query_specs(spark, sf_dir):
    return interest_specs(spark, sf_dir).select("interest", "q_pos", "text", F.round("weight", 6).alias("weight"), "kind", F.round(dot(F.col("vec"), F.col("vec")), 6).alias("norm"))


def expansion_specs(spark, sf_dir):
    e = read_table(spark, sf_dir, "interest_expansions")
    items = e.select("interest", F.posexplode("items").alias("pos", "item")).where("trim(coalesce(item, '')) <> ''")
    anchors = e.select("interest", F.lit(0).alias("q_pos"), F.col("interest").alias("text"), F.lit(1.0).alias("weight"), F.lit("anchor").alias("kind"))
    return anchors.unionByName(items.select("interest", (F.col("pos") + 1).alias("q_pos"), F.col("item").alias("text"), (0.15 + 0.1 * (F.col("pos") % 4)).alias("weight"), F.lit("expansion").alias("kind"))).dropDuplicates(["interest", "q_pos"])


def r2_merge_specs(spark, sf_dir):
    return r.merge_specs(expansion_specs(spark, sf_dir)).select("interest", "q_pos", F.lower(F.trim("text")).alias("text"), F.round("weight", 4).alias("weight"), "kind")


def _spec_hits(spark, sf_dir):
    s = interest_specs(spark, sf_dir).withColumn("q", F.concat_ws("#", "interest", F.col("q_pos").cast("string")))
    return s, s.select("q", "interest", "weight")


def r8_rrf_dense(spark, sf_dir):
    s, small = _spec_hits(spark, sf_dir)
    hits = r.dense_topk(vectors(spark, sf_dir), s.where("kind = 'anchor'"), 300).unionByName(r.dense_topk(vectors(spark, sf_dir), s.where("kind = 'expansion'"), 120))
    return r.rrf(hits.join(small, "q"), ["interest", "id"], F.col("weight")).select("interest", "id", F.round("rrf", 10).alias("rrf"))


def _lexical(spark, sf_dir):
    s, small = _spec_hits(spark, sf_dir)
    c = corpus(spark, sf_dir)
    title = r.rank_within(r.bm25_scores(c.select("id", F.col("title").alias("text")), s.select("q", "text")), ["q"], "score", "id", 80)
    body = r.rank_within(r.bm25_scores(c.select("id", F.col("body").alias("text")), s.select("q", "text")), ["q"], "score", "id", 120)
    return title.unionByName(body).join(small, "q")


def r9_rrf_lexical(spark, sf_dir):
    lex = _lexical(spark, sf_dir)
    best = lex.groupBy("interest", "id").agg(F.max(F.col("weight") * F.col("score")).alias("best"))
    return r.rrf(lex, ["interest", "id"], F.col("weight")).join(best, ["interest", "id"]).select("interest", "id", F.round("rrf", 10).alias("rrf"), F.round("best", 6).alias("best"))


def _fused(spark, sf_dir):
    return r8_rrf_dense(spark, sf_dir).withColumnRenamed("rrf", "d").join(r9_rrf_lexical(spark, sf_dir).withColumnRenamed("rrf", "l"), ["interest", "id"], "full").na.fill(0.0, ["d", "l", "best"])


def r10_fused(spark, sf_dir):
    return _fused(spark, sf_dir).select("interest", "id", F.round(0.65 * r.minmax("d", ["interest"]) + 0.35 * r.minmax("l", ["interest"]), 6).alias("fused"))


def t4_candidate_cap(spark, sf_dir):
    return r.rank_within(r10_fused(spark, sf_dir).withColumnRenamed("fused", "score"), ["interest"], "score", "id", 800).select("interest", "id", "rank")


def a7_sim_features(spark, sf_dir):
    s, _ = _spec_hits(spark, sf_dir)
    candidates = t4_candidate_cap(spark, sf_dir)
    return r.similarity_features(candidates, vectors(spark, sf_dir).select("id", "vec"), s).select("interest", "id", F.round("dense_max", 6).alias("dense_max"), F.round("dense_cov", 6).alias("dense_cov"))


def r13_retrieve_feed(spark, sf_dir):
    found = r.retrieve(corpus(spark, sf_dir), vectors(spark, sf_dir).select("id", "vec"), interest_specs(spark, sf_dir), r.RetrievalConfig())
    return found.select("interest", "rank", "id", F.round("score", 6).alias("score"), F.round("dense_max", 6).alias("dense_max"), F.round("dense_cov", 6).alias("dense_cov"), F.round("lex_norm", 6).alias("lex_norm"))


def v6_label_task(spark, sf_dir):
    """Retrieval for all labels judged by the labels: which documents come out, best, under their own, and at what rank."""
    found = r.retrieve(corpus(spark, sf_dir), vectors(spark, sf_dir).select("id", "vec"), interest_specs(spark, sf_dir), r.RetrievalConfig(top_k=800))
    hits = found.select("interest", "rank", F.col("id").cast("string").alias("id"), F.lit(None).cast("string").alias("url"))
    key = F.col("id").cast("string")
    items = vectors(spark, sf_dir).select(key.alias("item_id"), key.alias("article_id"), F.lit("").alias("url"), F.array(F.concat(F.lit("topic "), F.col("label").cast("string"))).alias("expected_interests"), F.lit(20).alias("rank_target_max"))
    out = evaluation.hit_rates(evaluation.evaluate(items, hits))
    return out.select("items", F.round("hit_at_k", 6).alias("hit_at_20"), F.round("mrr", 6).alias("mrr"), F.round("any_hit_at_k", 6).alias("any_hit_at_20"))


def p5_lang_filter(spark, sf_dir):
    """The retrieval with languages chosen after the candidate cap."""
    config = r.RetrievalConfig(top_k=10, min_sim=0.0, min_bm25=0.0)
    return r.retrieve(corpus(spark, sf_dir), vectors(spark, sf_dir).select("id", "vec"), interest_specs(spark, sf_dir), config, ["en"]).select("interest", "rank", "id", F.round("score", 6).alias("score"))


_ONE = f"{CORPUS}, qs AS (SELECT 'q' AS q, '{QUERY}' AS text)"
_DENSE = """d AS (SELECT q, interest, kind, weight, v.id, round(list_cosine_similarity(v.vec, s.vec), 8) AS score FROM v, s),
dr AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, id) AS rank FROM d),
dd AS (SELECT interest, id, sum(weight / (60 + rank)) AS rrf FROM dr WHERE rank <= CASE WHEN kind = 'anchor' THEN 300 ELSE 120 END GROUP BY interest, id)"""
_LEX = f"""{bm25_cte('title', 's', 'bt')}, {bm25_cte('body', 's', 'bb')}, lr AS ({ranked('bt', '80')} UNION ALL {ranked('bb', '120')}),
ll AS (SELECT interest, id, sum(weight / (60 + rank)) AS rrf, max(weight * score) AS best FROM lr JOIN (SELECT q, interest, weight FROM s) USING (q) GROUP BY interest, id)"""


def _mm(x):
    return f"CASE WHEN {x} <= 0 OR max(CASE WHEN {x} > 0 THEN {x} END) OVER w IS NULL THEN 0 WHEN max(CASE WHEN {x} > 0 THEN {x} END) OVER w - min(CASE WHEN {x} > 0 THEN {x} END) OVER w <= 1e-12 THEN 1 ELSE ({x} - min(CASE WHEN {x} > 0 THEN {x} END) OVER w) / (max(CASE WHEN {x} > 0 THEN {x} END) OVER w - min(CASE WHEN {x} > 0 THEN {x} END) OVER w) END"


_BOTH = "b AS (SELECT coalesce(dd.interest, ll.interest) AS interest, coalesce(dd.id, ll.id) AS id, round(coalesce(dd.rrf, 0), 10) AS d, round(coalesce(ll.rrf, 0), 10) AS l, coalesce(best, 0) AS best FROM dd FULL JOIN ll ON dd.interest = ll.interest AND dd.id = ll.id)"
_EXACT = _BOTH.replace("round(coalesce(dd.rrf, 0), 10)", "coalesce(dd.rrf, 0)").replace("round(coalesce(ll.rrf, 0), 10)", "coalesce(ll.rrf, 0)")
_FUSE = f"fu AS (SELECT *, 0.65 * ({_mm('d')}) + 0.35 * ({_mm('l')}) AS fused FROM b WINDOW w AS (PARTITION BY interest))"
_CAP = "cap AS (SELECT interest, id, row_number() OVER (PARTITION BY interest ORDER BY round(round(fused, 6), 8) DESC, id) AS rank FROM fu QUALIFY row_number() OVER (PARTITION BY interest ORDER BY round(round(fused, 6), 8) DESC, id) <= 800)"
_FEAT = "fe AS (SELECT interest, id, least(greatest(x[1], 0), 1) AS dense_max, least(greatest(CASE WHEN len(x) > 1 THEN (x[1] + x[2]) / 2 ELSE x[1] END, 0), 1) AS dense_cov FROM (SELECT k.interest, k.id, list_reverse_sort(list(s.weight * list_inner_product(v.vec, s.vec))) AS x FROM cap k JOIN v ON v.id = k.id JOIN s ON s.interest = k.interest GROUP BY k.interest, k.id))"
_BASE = f"WITH {CORPUS}, {SPECS}"
_FEED = f"""{_BASE}, {_DENSE}, {_LEX}, {_EXACT}, {_FUSE},
cap AS (SELECT *, row_number() OVER (PARTITION BY interest ORDER BY round(fused, 8) DESC, id) AS place FROM fu QUALIFY row_number() OVER (PARTITION BY interest ORDER BY round(fused, 8) DESC, id) <= 800), {_FEAT},
ks AS (SELECT cap.*, dense_max, dense_cov FROM cap JOIN fe USING (interest, id) JOIN c USING (id) WHERE LANG),
ag AS (SELECT *, 0.65 * ({_mm('d')}) + 0.35 * ({_mm('l')}) AS again, {_mm('best')} AS lex_norm FROM ks WINDOW w AS (PARTITION BY interest)),
fi AS (SELECT *, 0.45 * again + 0.30 * dense_max + 0.15 * dense_cov + 0.10 * lex_norm AS score FROM ag WHERE LIMITS)"""

QUERIES = {
    "a6_bm25_stats": a6_bm25_stats, "r7_bm25_body_topk": r7_bm25_topk("body", 50), "r7_bm25_title_topk": r7_bm25_topk("title", 50), "t3_bm25_weighted": t3_bm25_weighted,
    "n37_cosine": n37_cosine, "t2_dense_topk": t2_dense_topk, "p4_dense_window": p4_window_dense, "r3_query_specs": r3_query_specs, "r2_merge_specs": r2_merge_specs,
    "r8_rrf_dense": r8_rrf_dense, "r9_rrf_lexical": r9_rrf_lexical, "r10_rrf_fused": r10_fused, "t4_candidate_cap": t4_candidate_cap, "a7_sim_features": a7_sim_features,
    "r13_retrieve_feed": r13_retrieve_feed, "r13_lang_filter": p5_lang_filter, "v6_label_task": v6_label_task,
}
QUERIES["dense_window_topk"] = QUERIES.pop("p4_dense_window")
ORACLES = {
    "a6_bm25_stats": f"WITH {_ONE}, {bm25_cte('body', 'qs', 'bb')} SELECT term, df, round(idf, 6) AS idf FROM bb_i",
    "r7_bm25_body_topk": f"WITH {_ONE}, {bm25_cte('body', 'qs', 'bb')} SELECT id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM ({ranked('bb', '50')})",
    "r7_bm25_title_topk": f"WITH {_ONE}, {bm25_cte('title', 'qs', 'bt')} SELECT id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM ({ranked('bt', '50')})",
    "t3_bm25_weighted": f"WITH {_ONE}, {bm25_cte('title', 'qs', 'bt')}, {bm25_cte('body', 'qs', 'bb')}, m AS (SELECT 'q' AS q, coalesce(bt.id, bb.id) AS id, 0.7 * coalesce(bt.score, 0) + 0.3 * coalesce(bb.score, 0) AS score FROM bt FULL JOIN bb ON bt.id = bb.id) SELECT id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM ({ranked('m', '50')})",
    "n37_cosine": "SELECT e.vec_id AS id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(f.embedding AS DOUBLE[])), 6) AS cos, round(least(greatest(list_inner_product(CAST(e.embedding AS DOUBLE[]), CAST(f.embedding AS DOUBLE[])), 0.15), 0.45), 6) AS held FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) f",
    "t2_dense_topk": f"{_BASE}, d AS (SELECT q, v.id, round(list_cosine_similarity(v.vec, s.vec), 8) AS score FROM v, s) SELECT q, id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score FROM ({ranked('d', '20')})",
    "dense_window_topk": f"{_BASE}, d AS (SELECT q, v.id, round(list_cosine_similarity(v.vec, s.vec), 8) AS score FROM v JOIN documents o ON o.doc_id = v.id, s WHERE kind = 'anchor' AND o.fetched_at >= TIMESTAMP '2026-02-01' - INTERVAL 400 DAY AND o.fetched_at < TIMESTAMP '2026-02-01' AND lower(o.lang) IN ('en','fr')) SELECT q, id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM ({ranked('d', '10')})",
    "r3_query_specs": f"{_BASE} SELECT interest, CAST(q_pos AS INTEGER) AS q_pos, text, round(weight, 6) AS weight, kind, round(list_inner_product(vec, vec), 6) AS norm FROM s",
    "r8_rrf_dense": f"{_BASE}, {_DENSE} SELECT interest, id, round(rrf, 10) AS rrf FROM dd",
    "r9_rrf_lexical": f"{_BASE}, {_LEX} SELECT interest, id, round(rrf, 10) AS rrf, round(best, 6) AS best FROM ll",
    "r10_rrf_fused": f"{_BASE}, {_DENSE}, {_LEX}, {_BOTH}, {_FUSE} SELECT interest, id, round(fused, 6) AS fused FROM fu",
    "t4_candidate_cap": f"{_BASE}, {_DENSE}, {_LEX}, {_BOTH}, {_FUSE}, {_CAP} SELECT interest, id, CAST(rank AS INTEGER) AS rank FROM cap",
    "a7_sim_features": f"{_BASE}, {_DENSE}, {_LEX}, {_BOTH}, {_FUSE}, {_CAP}, {_FEAT} SELECT interest, id, round(dense_max, 6) AS dense_max, round(dense_cov, 6) AS dense_cov FROM fe",
    "r13_retrieve_feed": _FEED.replace("LANG", "true").replace("LIMITS", "NOT (dense_max < 0.15 AND lex_norm < 0.05)") + f" SELECT interest, CAST(rank AS INTEGER) AS rank, id, round(score, 6) AS score, round(dense_max, 6) AS dense_max, round(dense_cov, 6) AS dense_cov, round(lex_norm, 6) AS lex_norm FROM ({ranked('fi', '20', 'interest')})",
    "v6_label_task": _FEED.replace("LANG", "true").replace("LIMITS", "NOT (dense_max < 0.15 AND lex_norm < 0.05)")
    + f", fr AS (SELECT interest, rank, id FROM ({ranked('fi', '800', 'interest')})), bh AS (SELECT id, min(struct_pack(rank, interest)) AS x FROM fr GROUP BY id), et AS (SELECT e.vec_id, bh.x.rank AS rank, bh.x.interest = 'topic '||e.label AS ok FROM embeddings e LEFT JOIN bh ON bh.id = e.vec_id) SELECT count(*) AS items, round(avg((coalesce(ok, false) AND rank <= 20)::INT), 6) AS hit_at_20, round(avg(CASE WHEN ok THEN 1.0 / rank ELSE 0 END), 6) AS mrr, round(avg((coalesce(rank, 99) <= 20)::INT), 6) AS any_hit_at_20 FROM et",
    "r13_lang_filter": _FEED.replace("LANG", "lower(lang) = 'en'").replace("LIMITS", "true") + f" SELECT interest, CAST(rank AS INTEGER) AS rank, id, round(score, 6) AS score FROM ({ranked('fi', '10', 'interest')})",
    "r2_merge_specs": """WITH e AS (SELECT interest, unnest(range(0, len(items))) AS pos, unnest(items) AS item FROM interest_expansions),
a AS (SELECT interest, 0 AS q_pos, interest AS text, 1.0::DOUBLE AS weight, 'anchor' AS kind FROM interest_expansions UNION ALL SELECT interest, pos + 1, item, 0.15 + 0.1 * (pos % 4), 'expansion' FROM e WHERE trim(coalesce(item, '')) <> ''),
u AS (SELECT DISTINCT ON (interest, q_pos) * FROM a), k AS (SELECT *, NORM AS key FROM u WHERE NORM <> ''),
b AS (SELECT *, min(q_pos) OVER (PARTITION BY interest, key) AS first_pos, row_number() OVER (PARTITION BY interest, key ORDER BY (kind = 'anchor') DESC, weight DESC, q_pos) AS r FROM k)
SELECT interest, CAST(row_number() OVER (PARTITION BY interest ORDER BY first_pos) AS INTEGER) AS q_pos, lower(trim(text)) AS text, round(weight, 4) AS weight, kind FROM b WHERE r = 1""".replace("NORM", __import__("presswerk.plans.text_queries", fromlist=["norm"]).norm("text")),
}
