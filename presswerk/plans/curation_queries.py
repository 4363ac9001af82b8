"""Queries over stored hits: dedup, rerank, joins of hits with articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from presswerk.functions import text as t
from presswerk.functions.similarity import indel_ratio_udf
from presswerk.operators import dedup, rerank
from presswerk.plans.text_queries import norm, strip
from presswerk.session import read_table


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = read_table(spark, sf_dir, "retrieval_hits")
    return h.select(F.concat_ws("#", F.col("retrieval_run_id").cast("string"), F.lower("interest")).alias("interest"), "rank", "score", F.col("article_id").alias("id"), F.col("payload.url").alias("url"), F.col("payload.fingerprint").alias("fingerprint"), F.col("payload.title").alias("title"), F.col("payload.canonical_text").alias("body"), F.col("payload.domain").alias("domain"))


def latest(spark, sf_dir, table="articles", wanted: DataFrame | None = None):
    """The latest delivery of each id, with `wanted` (id) of these ids only."""
    a = read_table(spark, sf_dir, table)
    a = a if wanted is None else a.join(wanted, "id", "left_semi")
    w = Window.partitionBy("id").orderBy(F.col("updated_at").desc_nulls_last(), F.coalesce("url", F.lit("")))
    return a.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


LATEST = "a AS (SELECT * FROM articles QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, coalesce(url, '')) = 1)"


def dp1_prepare(spark, sf_dir):
    p = dedup.prepare(hits(spark, sf_dir))
    return p.select("interest", "rank", "id", "url", "fingerprint", "title", F.md5("body").alias("body_md5"), "domain", F.size("title_tokens").alias("title_tokens"), F.size("body_tokens").alias("body_tokens"))


def dp2_dedup_hits(spark, sf_dir):
    return dedup.dedup_hits(dedup.prepare(hits(spark, sf_dir)))


def dp6_dedup_stories(spark, sf_dir):
    return dedup.dedup_hits(dedup.prepare(hits(spark, sf_dir)), same_story=True)


def dp7_dedup_output(spark, sf_dir):
    """Kept hits renumbered, with their lineage."""
    kept = dp2_dedup_hits(spark, sf_dir).where("rank > 0")
    return kept.select("interest", "rank", "id", F.struct(F.lit("retrieval_hits").alias("source_table"), F.split("interest", "#")[0].cast("long").alias("source_run_id"), F.split("interest", "#")[1].alias("source_interest"), F.col("source_rank")).alias("dedup_meta"))


def dp3_block_keys(spark, sf_dir):
    p = dedup.prepare(hits(spark, sf_dir))
    keys = dedup.block_key_column(F.col("title"), F.col("title_tokens"), F.coalesce("domain", F.lit("")))
    return p.select("interest", "rank", F.array_join(keys, " ").alias("keys"))


def j9_block_pairs(spark, sf_dir):
    """Votes of pairs of hits of one interest that share blocking keys, any of the four kinds."""
    return _block_pairs(dedup.prepare(hits(spark, sf_dir)))


def _block_pairs(prepared: DataFrame) -> DataFrame:
    p = prepared.select("interest", "rank", F.explode(dedup.block_key_column(F.col("title"), F.col("title_tokens"), F.coalesce("domain", F.lit("")))).alias("key"))
    pairs = p.select("interest", "key", F.col("rank").alias("a")).join(p.select("interest", "key", F.col("rank").alias("b")), ["interest", "key"]).where("a < b")
    return pairs.groupBy("interest", "a", "b").agg(F.count("*").alias("votes"))


def _title_pairs(prepared: DataFrame) -> DataFrame:
    """The pairs from blocking with both titles and their words."""
    side = lambda at: prepared.select("interest", F.col("rank").alias(at), F.col("title").alias(f"title_{at}"), F.array_distinct("title_tokens").alias(f"words_{at}"))
    return _block_pairs(prepared).join(side("a"), ["interest", "a"]).join(side("b"), ["interest", "b"])


def p12_token_jaccard(spark, sf_dir):
    return _title_pairs(dedup.prepare(hits(spark, sf_dir))).select("interest", "a", "b", F.round(t.jaccard(F.col("words_a"), F.col("words_b")), 6).alias("jaccard"))


def p13_title_ratio(spark, sf_dir):
    """Indel ratio of the titles of the pairs from blocking."""
    return _title_pairs(dedup.prepare(hits(spark, sf_dir))).select("interest", "a", "b", F.round(indel_ratio_udf("title_a", "title_b"), 6).alias("ratio"))


def a9_removal_reasons(spark, sf_dir):
    return dp2_dedup_hits(spark, sf_dir).where("reason <> ''").groupBy("reason").agg(F.count("*").alias("n"))


def w2_first_by_fingerprint(spark, sf_dir):
    a = latest(spark, sf_dir).where("fingerprint is not null")
    return a.groupBy(F.lower("fingerprint").alias("fingerprint")).agg(F.min("id").alias("id"))


def w2_first_by_url(spark, sf_dir):
    a = latest(spark, sf_dir).select("id", F.coalesce(F.nullif(t.normal_url(F.col("url")), F.lit("")), F.col("id")).alias("key"))
    return a.groupBy("key").agg(F.min("id").alias("id"))


def j2_hydrate(spark, sf_dir):
    """Hits with their article by id, else by normal url."""
    h = hits(spark, sf_dir).select("interest", "rank", "id", t.normal_url(F.col("url")).alias("nurl"))
    a = latest(spark, sf_dir).select(F.col("id").alias("aid"), "lang", t.normal_url(F.col("url")).alias("aurl"))
    by_url = a.where("aurl <> ''").groupBy("aurl").agg(F.min_by("lang", "aid").alias("url_lang"))
    joined = h.join(a.select("aid", F.col("lang").alias("id_lang")), h.id == F.col("aid"), "left").join(by_url, h.nurl == F.col("aurl"), "left")
    return joined.select("interest", "rank", "id", F.coalesce("id_lang", "url_lang", F.lit("none")).alias("lang"), F.when(F.col("aid").isNotNull(), "id").when(F.col("aurl").isNotNull(), "url").otherwise("none").alias("via"))


def j3_lookup_cascade(spark, sf_dir):
    """Evaluation items looked up in the corpus by id, url, fingerprint and title, in this order."""
    e = read_table(spark, sf_dir, "eval_articles").select("item_id", "article_id", t.normal_url(F.col("url")).alias("u"), t.ingest_fingerprint(F.col("url"), F.col("title"), F.col("content")).alias("f"), t.norm_text(F.col("title")).alias("n"))
    a = latest(spark, sf_dir).select("id", t.normal_url(F.col("url")).alias("au"), t.ingest_fingerprint(F.col("url"), F.col("title"), F.col("content")).alias("af"), t.norm_text(F.col("title")).alias("an"))
    pick = lambda key, name: a.where(f"{key} <> ''").groupBy(key).agg(F.min("id").alias(name))
    j = e.join(a.select(F.col("id").alias("by_id")), e.article_id == F.col("by_id"), "left").join(pick("au", "by_url"), e.u == F.col("au"), "left").join(pick("af", "by_print"), e.f == F.col("af"), "left").join(pick("an", "by_title"), e.n == F.col("an"), "left")
    return j.select("item_id", F.coalesce("by_id", "by_url", "by_print", "by_title", F.lit("none")).alias("id"))


def j8_resume_index(spark, sf_dir):
    d, v = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "embeddings")
    return d.join(v, d.doc_id == v.vec_id, "left_anti").select("doc_id")


def j6_candidates_with_vectors(spark, sf_dir):
    d, v = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "embeddings")
    return d.join(v, d.doc_id == v.vec_id).select("doc_id", "label", F.size("embedding").alias("dims"))


def j13_pair_in_interest(spark, sf_dir):
    """Interests and runs in which the two most retrieved articles occur together."""
    h = read_table(spark, sf_dir, "retrieval_hits").select("retrieval_run_id", "interest", "article_id")
    top = h.groupBy("article_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "article_id").limit(2).select("article_id")
    return h.join(top, "article_id", "left_semi").groupBy("retrieval_run_id", "interest").agg(F.countDistinct("article_id").alias("found")).where("found = 2")


def x3_rerank(spark, sf_dir):
    """Hits scored against their interest with the offline scorer."""
    h = hits(spark, sf_dir).select("interest", F.split("interest", "#")[1].alias("query"), F.col("rank").alias("dense_rank"), "id", F.concat_ws("\n", "title", "body").alias("text"))
    s = rerank.score_hits(h, rerank.OverlapScorer(), "query", "text")
    w = Window.partitionBy("interest").orderBy(F.round("rerank_score", 8).desc(), "dense_rank")
    return s.select("interest", "id", "dense_rank", F.round("rerank_score", 6).alias("rerank_score"), F.row_number().over(w).alias("rank"))


def x13_collapse(spark, sf_dir):
    h = hits(spark, sf_dir).select("interest", F.split("interest", "#")[1].alias("query"), F.col("rank").alias("dense_rank"), "id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("body", F.lit("")).alias("text"))
    s = rerank.score_hits(h, rerank.OverlapScorer(), "query", "text")
    return rerank.collapse(s, rerank.OverlapScorer(), 10, 80, mean=0.62, high=0.70, low=0.35).select("interest", "rank", "id", F.round("rerank_score", 6).alias("rerank_score"))


def x8_denoise(spark, sf_dir):
    from pyspark.sql.types import StringType

    udf = F.pandas_udf(lambda a, b: a.combine(b, lambda x, y: rerank.denoise_body(x or "", y or "")), StringType())
    a = latest(spark, sf_dir)
    return a.select("id", udf(F.coalesce("title", F.lit("")), F.coalesce("content", F.lit(""))).alias("text"))


def t6_pool(spark, sf_dir):
    h = hits(spark, sf_dir).select("interest", "id", F.col("rank").alias("dense_rank"), F.coalesce("score", F.lit(0.0)).alias("rerank_score"))
    return rerank.rerank_pool(h, 5).select("interest", "id", "place")


_N = norm("payload.title")
_TOK = "list_filter(regexp_extract_all({0}, '[a-z0-9][a-z0-9''_-]*'), lambda x: length(x) > 1)"
_R = r"'^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*).*$'"


def nurl(col):
    u = strip(f"coalesce({col},'')")
    return rf"regexp_replace(CASE WHEN regexp_matches({u}, {_R}) THEN lower(regexp_extract({u}, {_R}, 1))||'://'||lower(regexp_extract({u}, {_R}, 2))||regexp_extract({u}, {_R}, 3) ELSE regexp_replace({u}, '[?#].*$', '') END, '/+$', '')"


_PREP = rf"""p AS (SELECT retrieval_run_id||'#'||lower(interest) AS interest, rank, article_id AS id, {nurl('payload.url')} AS url, lower(coalesce(payload.fingerprint,'')) AS fingerprint, {_N} AS title, {norm("substr(coalesce(payload.canonical_text,''),1,4000)")} AS body,
coalesce(nullif(lower(payload.domain),''), regexp_replace(lower(regexp_extract(coalesce(payload.url,''), {_R}, 2)), '^www\.', '')) AS domain FROM retrieval_hits),
q AS (SELECT *, {_TOK.format('title')} AS tt, list_slice({_TOK.format('body')}, 1, 180) AS bt FROM p)"""
_DIST6 = "list_slice(list_filter(tt, lambda x, i: list_position(tt, x) = i), 1, 6)"
_GRAMS = "list_slice(list_filter(gr, lambda x, i: list_position(gr, x) = i), 1, 4)"
_KEYS = rf"""k0 AS (SELECT *, regexp_replace(title, '\s+', '', 'g') AS sq, {_DIST6} AS w6 FROM q), k1 AS (SELECT *, list_transform(range(1, greatest(1, length(sq) - 1)), lambda i: substr(sq, i, 3)) AS gr FROM k0),
k2 AS (SELECT *, list_concat(list_concat(list_transform(w6, lambda w: 't:'||w), CASE WHEN coalesce(domain,'') <> '' THEN list_transform(w6, lambda w: 'd:'||domain||'|'||w) ELSE [] END), list_transform({_GRAMS}, lambda g: 'g:'||g)) AS keys FROM k1),
k3 AS (SELECT interest, rank, CASE WHEN len(keys) > 0 THEN keys WHEN coalesce(domain,'') <> '' THEN ['donly:'||domain] ELSE [] END AS keys FROM k2)"""
_FP = "md5(lower({0})||'||'||lower({1})||'||'||substr(lower({2}),1,400))".format(*(strip(f"coalesce({c},'')") for c in ("url", "title", "content")))

QUERIES = {
    "dp1_prepare": dp1_prepare, "dp2_dedup_hits": dp2_dedup_hits, "dp6_dedup_stories": dp6_dedup_stories, "dp7_dedup_output": dp7_dedup_output, "dp3_block_keys": dp3_block_keys, "j9_block_pairs": j9_block_pairs,
    "jaccard_title_tokens": p12_token_jaccard, "title_ratio": p13_title_ratio, "a9_removal_reasons": a9_removal_reasons, "w2_first_by_fingerprint": w2_first_by_fingerprint, "w2_first_by_url": w2_first_by_url,
    "j2_hydrate": j2_hydrate, "j3_lookup_cascade": j3_lookup_cascade, "j8_resume_index": j8_resume_index, "j6_candidate_vectors": j6_candidates_with_vectors, "j13_pair_in_interest": j13_pair_in_interest,
    "x3_rerank": x3_rerank, "x13_collapse": x13_collapse, "x8_denoise": x8_denoise, "t6_pool": t6_pool,
}
ORACLES = {
    "dp1_prepare": f"WITH {_PREP} SELECT interest, rank, id, url, fingerprint, title, md5(body) AS body_md5, domain, CAST(len(tt) AS INTEGER) AS title_tokens, CAST(len(bt) AS INTEGER) AS body_tokens FROM q",
    "dp3_block_keys": f"WITH {_PREP}, {_KEYS} SELECT interest, rank, coalesce(array_to_string(keys, ' '), '') AS keys FROM k3",
    "j9_block_pairs": f"WITH {_PREP}, {_KEYS}, x AS (SELECT interest, rank, unnest(keys) AS key FROM k3) SELECT a.interest, a.rank AS a, b.rank AS b, count(*) AS votes FROM x a JOIN x b ON a.interest = b.interest AND a.key = b.key AND a.rank < b.rank GROUP BY ALL",
    "jaccard_title_tokens": f"WITH {_PREP}, {_KEYS}, x AS (SELECT interest, rank, unnest(keys) AS key FROM k3), b AS (SELECT DISTINCT x.interest, x.rank AS a, y.rank AS b FROM x JOIN x y ON x.interest = y.interest AND x.key = y.key AND x.rank < y.rank), d AS (SELECT interest, rank, list_distinct(tt) AS w FROM q) SELECT b.interest, a, b, round(CASE WHEN len(m.w) = 0 OR len(n.w) = 0 THEN 0 ELSE len(list_intersect(m.w, n.w)) / len(list_distinct(list_concat(m.w, n.w))) END, 6) AS jaccard FROM b JOIN d m ON m.interest = b.interest AND m.rank = a JOIN d n ON n.interest = b.interest AND n.rank = b",
    "w2_first_by_fingerprint": f"WITH {LATEST} SELECT min(id) AS id, lower(fingerprint) AS fingerprint FROM a WHERE fingerprint IS NOT NULL GROUP BY lower(fingerprint)",
    "w2_first_by_url": f"WITH {LATEST} SELECT min(id) AS id, key FROM (SELECT id, coalesce(nullif({nurl('url')}, ''), id) AS key FROM a) GROUP BY key",
    "j2_hydrate": f"WITH {LATEST}, u AS (SELECT {nurl('url')} AS aurl, arg_min(lang, id) AS url_lang FROM a GROUP BY 1 HAVING {nurl('url')} <> ''), {_PREP} SELECT p.interest, p.rank, p.id, coalesce(a.lang, url_lang, 'none') AS lang, CASE WHEN a.id IS NOT NULL THEN 'id' WHEN u.aurl IS NOT NULL THEN 'url' ELSE 'none' END AS via FROM p LEFT JOIN a ON a.id = p.id LEFT JOIN u ON u.aurl = p.url".replace("arg_min(lang, id)", "arg_min_null(lang, id)").replace("GROUP BY 1 HAVING", "GROUP BY 1 HAVING"),
    "j3_lookup_cascade": f"WITH {LATEST}, n AS (SELECT id, {nurl('url')} AS au, {_FP} AS af, {norm('title')} AS an FROM a), e AS (SELECT item_id, article_id, {nurl('url')} AS u, {_FP} AS f, {norm('title')} AS n FROM eval_articles) SELECT item_id, coalesce((SELECT id FROM a WHERE a.id = e.article_id), (SELECT min(id) FROM n WHERE au = e.u AND au <> ''), (SELECT min(id) FROM n WHERE af = e.f), (SELECT min(id) FROM n WHERE an = e.n AND an <> ''), 'none') AS id FROM e",
    "j8_resume_index": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)",
    "j6_candidate_vectors": "SELECT doc_id, label, CAST(len(embedding) AS INTEGER) AS dims FROM documents JOIN embeddings ON doc_id = vec_id",
    "j13_pair_in_interest": "WITH t AS (SELECT article_id FROM retrieval_hits GROUP BY 1 ORDER BY count(*) DESC, article_id LIMIT 2) SELECT retrieval_run_id, interest, count(DISTINCT article_id) AS found FROM retrieval_hits WHERE article_id IN (SELECT article_id FROM t) GROUP BY ALL HAVING count(DISTINCT article_id) = 2",
    "x3_rerank": r"""WITH h AS (SELECT retrieval_run_id||'#'||lower(interest) AS interest, lower(interest) AS query, rank AS dense_rank, article_id AS id, list_distinct(regexp_extract_all(lower(interest), '[\p{L}\p{N}_]+')) AS q, list_distinct(regexp_extract_all(lower(concat_ws(chr(10), payload.title, payload.canonical_text)), '[\p{L}\p{N}_]+')) AS d FROM retrieval_hits),
s AS (SELECT *, 1 / (1 + exp(-8 * (len(list_intersect(q, d)) / len(q) - 0.5))) AS score FROM h) SELECT interest, id, dense_rank, round(score, 6) AS rerank_score, CAST(row_number() OVER (PARTITION BY interest ORDER BY round(score, 8) DESC, dense_rank) AS INTEGER) AS rank FROM s""",
    "t6_pool": "SELECT interest, id, CAST(place AS INTEGER) AS place FROM (SELECT retrieval_run_id||'#'||lower(interest) AS interest, article_id AS id, row_number() OVER (PARTITION BY retrieval_run_id, lower(interest) ORDER BY round(coalesce(score, 0), 8) DESC, rank) AS place FROM retrieval_hits) WHERE place <= 5",
}
