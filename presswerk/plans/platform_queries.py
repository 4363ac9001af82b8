"""Queries of indexing, the run ledger, specs, payloads and exports, and planted cases of the operators SQL cannot state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from presswerk.functions.register import register
from presswerk.functions.similarity import indel_ratio_udf
from presswerk.operators import dedup, evaluation, profile, rerank, specs, store, writing
from presswerk.operators.indexing import HashedEmbedder, VectorIndex, embed
from presswerk.operators.retrieval import merge_specs
from presswerk.plans.curation_queries import LATEST, hits, latest
from presswerk.plans.retrieval_queries import corpus, expansion_specs
from presswerk.plans.serving_queries import _EV, _evaluated, summaries
from presswerk.plans.text_queries import norm, strip
from presswerk.session import keep_until_end, read_table, shared_folder
from presswerk.sources import html, readers, sinks


def _folder(spark, name):
    return keep_until_end(spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")


def r1_embed(spark, sf_dir):
    """Titles of documents by the offline embedder: filled buckets and the largest value."""
    v = embed(corpus(spark, sf_dir), HashedEmbedder(64), "id", "title")
    return v.select(F.col("id").alias("doc_id"), F.size(F.filter("vec", lambda x: x != 0)).alias("filled"), F.round(F.array_max(F.transform("vec", lambda x: F.abs(x))).cast("double"), 5).alias("top"))


def r18_resume_index(spark, sf_dir):
    """An index of the English documents, resumed over all of them, and what a fetch by id gives."""
    d = corpus(spark, sf_dir)
    index, embedder = VectorIndex(spark, _folder(spark, "vectors")), HashedEmbedder(64)
    index.index(d.where("lang = 'en'"), embedder, reindex=True, text_col="title")
    index.index(d, embedder, resume=True, text_col="title")
    return index.fetch(d.select("id")).select(F.col("id").alias("doc_id"), F.size("vec").alias("dims"))


def k2_run_rows(spark, sf_dir):
    """Every run of the hits written into a ledger under a number of its own, and read back with the run it came from."""
    h = read_table(spark, sf_dir, "retrieval_hits").select("retrieval_run_id", "interest", "rank", "article_id")
    ledger = store.RunLedger(spark, _folder(spark, "ledger"))
    if not ledger.add_all("dedup", h, "retrieval_run_id", {"from": "retrieval_hits"}):
        return h.select(F.col("retrieval_run_id").alias("run_id"), F.col("retrieval_run_id").alias("source_run_id"), "interest", "rank", "article_id").where(F.lit(False))
    runs = ledger.runs("dedup").select(F.col("id").alias("run_id"), "source_run_id")
    return ledger.rows("dedup").join(runs, "run_id").select("run_id", "source_run_id", "interest", "rank", "article_id")


def k5_migrate(spark, sf_dir):
    a = latest(spark, sf_dir).select("id", "lang", "updated_at")
    out = store.migrate(a, {"id": "string", "lang": "string", "first_seen": "timestamp", "views": "long"}, {"lang": "und", "first_seen": F.col("updated_at"), "views": 0})
    return out.select("id", "lang", F.unix_micros("first_seen").alias("first_us"), "views")


def r4_tag_specs(spark, sf_dir):
    """The evaluation items' tags as specs of every interest."""
    tags = sorted(r[0] for r in read_table(spark, sf_dir, "eval_articles").select(F.explode("tags")).distinct().collect())  # a fixed evaluation set
    interests = read_table(spark, sf_dir, "interest_expansions").where("interest is not null").select("interest")
    return specs.tag_specs(tags, interests, HashedEmbedder(64)).select("interest", "q_pos", "text", "weight", "kind")


def r5_aggregate_specs(spark, sf_dir):
    merged = merge_specs(expansion_specs(spark, sf_dir).where("interest is not null"))
    return specs.aggregate_specs(merged).select("interest", "q_pos", F.lower(F.trim("text")).alias("text"), F.round("weight", 4).alias("weight"), "kind")


def n12_payload(spark, sf_dir):
    h = read_table(spark, sf_dir, "retrieval_hits")
    return h.select("retrieval_run_id", "interest", "rank", readers.payload_article(F.col("payload")).alias("a")).select("retrieval_run_id", "interest", "rank", "a.id", "a.title", F.md5(F.coalesce("a.content", F.lit(""))).alias("content_md5"), "a.source", "a.lang")


def n11_full_articles(spark, sf_dir):
    """Articles as full ones: the embedded text and the host of the url."""
    a = latest(spark, sf_dir).select("id", "title", "content", "url", "source", "lang")
    return readers.full_articles(a).select("id", F.md5("canonical_text").alias("canonical_md5"), "source", "lang", "fingerprint")


def n36_article_meta(spark, sf_dir):
    h = read_table(spark, sf_dir, "retrieval_hits").select("retrieval_run_id", "interest", "rank", "article_id", "payload")
    full = latest(spark, sf_dir).select(F.col("id").alias("aid"), F.struct("id", "title", "url", "source", "published_date", "lang").alias("full"))
    meta = readers.article_meta(F.col("payload"), F.col("full"), F.col("article_id"))
    return h.join(full, h.article_id == F.col("aid"), "left").select("retrieval_run_id", "interest", "rank", meta.alias("m")).select("retrieval_run_id", "interest", "rank", "m.*")


def g16_feed_summary(spark, sf_dir):
    """Stored answers as a feed shows them: plain text, and the same text in a JSON object."""
    s = summaries(spark, sf_dir).select("id", "summary_fr")
    wrapped = F.when(F.col("id") % 2 == 0, F.to_json(F.struct(F.lit(1).alias("n"), F.col("summary_fr").alias("summary_fr")))).otherwise(F.col("summary_fr"))
    return s.select("id", F.md5(writing.feed_summary(wrapped)).alias("text_md5"))


def a16_feed_counts(spark, sf_dir):
    s = summaries(spark, sf_dir).where("coalesce(notes, '') = ''")
    return s.agg(F.countDistinct("interest").alias("topics"), F.count("*").alias("articles"))


def a12_by_interest(spark, sf_dir):
    e = evaluation.by_interest(_evaluated(spark, sf_dir))
    return e.select("interest", "score", F.round("rank_avg", 6).alias("rank_avg"))


def a11_hit_rates(spark, sf_dir):
    e = evaluation.hit_rates(_evaluated(spark, sf_dir))
    return e.select("items", F.round("hit_at_k", 6).alias("hit_at_20"), F.round("mrr", 6).alias("mrr"), F.round("any_hit_at_k", 6).alias("any_hit_at_20"))


def j10_neighbours(spark, sf_dir):
    """Neighbours of hits by language and update within three days, among the first ten of each interest's ranks."""
    a = latest(spark, sf_dir).select("id", "lang", F.col("updated_at").alias("date"), "title")
    vec = embed(a, HashedEmbedder(32), "id", "title")
    h = hits(spark, sf_dir).select("interest", "rank", "id").join(a.drop("title"), "id").join(vec, "id")
    kept = h.where("rank <= 10").select("interest", "id")
    return dedup.neighbours_among(dedup.neighbour_pairs(h.drop("rank").dropDuplicates(["interest", "id"])), kept).select("interest", "a", "b").distinct()


def k9_result_blocks(spark, sf_dir):
    h = hits(spark, sf_dir).select("interest", "rank", "id", "title")
    return sinks.result_blocks(h).select("interest", "n", F.md5(F.array_join(F.transform("articles", lambda x: F.concat_ws(":", x["rank"].cast("string"), x["id"])), ",")).alias("articles_md5"))


def x15_rerank_rows(spark, sf_dir):
    h = hits(spark, sf_dir).select(F.split("interest", "#")[1].alias("interest"), F.split("interest", "#")[0].alias("run"), "rank", "id", "title", F.col("body").alias("text"))
    one = h.select(F.concat_ws(" ", "interest", "run").alias("interest"), "rank", "id", "title", "text")
    return rerank.rerank_rows(one, rerank.OverlapScorer(), 20).select("interest", "rank", "id", F.round("rerank_score", 6).alias("rerank_score"))


def udtf_segments(spark, sf_dir):
    """Segments of the payloads' texts by the table function, those that are sentences of a story."""
    register(spark)
    texts = read_table(spark, sf_dir, "retrieval_hits").select("article_id", F.col("payload.title").alias("title"), F.col("payload.canonical_text").alias("text")).where("text is not null")
    texts.dropDuplicates(["article_id"]).createOrReplaceTempView("presswerk_texts")
    return spark.sql("SELECT article_id, count(*) AS segments, count_if(score >= 0) AS kept FROM presswerk_texts, LATERAL segments(text, title) GROUP BY article_id")


def a10_shortlist_averages(spark, sf_dir):
    out = dedup.shortlist_averages(dedup.prepare(hits(spark, sf_dir)))
    return out.select("interest", "candidates", F.round("shortlisted", 6).alias("shortlisted"), F.round("checked", 6).alias("checked"))


BODY = "the council met on monday and heard the plan for the bridge and the school meal programme of the town"
PLANTED = [
    # interest, rank, score, id, url, fingerprint, title, body, domain
    ("i", 1, 0.9, "a", "https://x.example/one?q=1", "F1", "Council hears the plan", BODY, "x.example"),
    ("i", 2, 0.8, "a", "https://x.example/other", "F2", "Another title here", "short text", "x.example"),
    ("i", 3, 0.7, "b", "HTTPS://X.example/one/", "F3", "Third title", "another text", "y.example"),
    ("i", 4, 0.6, "c", "https://x.example/four", "f1", "Fourth title", "more text", "z.example"),
    ("i", 5, 0.5, "d", "https://x.example/five", "F5", " council  HEARS the plan", BODY, "w.example"),
    ("i", 6, 0.4, "e", "https://x.example/six", "F6", "Council hears the plans", "something else that is much longer than the others were, about rain", "v.example"),
    ("i", 7, 0.3, "f", "https://x.example/seven", "F7", "Airline drops the offer to the drivers", "a text about an airline", "u.example"),
    ("i", None, 0.2, "g", None, None, None, None, None),
    ("j", 1, 0.9, "a", "https://x.example/one", "F1", "Council hears the plan", BODY, "x.example"),
]
PLANTED_SCHEMA = "interest string, rank int, score double, id string, url string, fingerprint string, title string, body string, domain string"
_DEDUPED = "(VALUES ('i','a',1,1,''), ('i','a',2,0,'same_id'), ('i','b',3,0,'same_url'), ('i','c',4,0,'same_fingerprint'), ('i','d',5,0,'same_title_body'), ('i','e',6,0,'near_title'), ('i','f',7,2,''), ('i','g',-1,3,''), ('j','a',1,1,'')) v(interest, id, source_rank, rank, reason)"


def _planted(spark):
    return dedup.dedup_hits(dedup.prepare(spark.createDataFrame(PLANTED, PLANTED_SCHEMA))).withColumn("source_rank", F.coalesce("source_rank", F.lit(-1)))


def dp2_planted(spark, sf_dir):
    return _planted(spark)


def dp7_planted(spark, sf_dir):
    return _planted(spark).where("rank > 0").select("interest", "rank", "id", "source_rank")


def a9_planted(spark, sf_dir):
    return _planted(spark).where("reason <> ''").groupBy("reason").agg(F.count("*").alias("n"))


def dp6_planted(spark, sf_dir):
    """Two tellings of one story under different titles: only the optional stage removes the second."""
    rows = [("i", 1, 0.9, "a", "", "", "Council hears plan for bridge", BODY, "x.example"), ("i", 2, 0.8, "b", "", "", "Council hears plans for a bridge", BODY[:60] + " but then the rain came and all of them went home early", "y.example"), ("i", 3, 0.7, "c", "", "", "Airline drops offer", "about an airline", "z.example")]
    p = dedup.prepare(spark.createDataFrame(rows, PLANTED_SCHEMA))
    return dedup.dedup_hits(p, same_story=True).select("id", "rank", F.col("reason").startswith("story").alias("by_story"))


def title_ratio_planted(spark, sf_dir):
    rows = [("abcd", "abcd"), ("abcd", "abxd"), ("", "x"), ("kitten", "sitting"), ("aaaa", "bbbb"), ("ab" * 100, "ba" * 100)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a string, b string")
    return df.select("i", F.round(indel_ratio_udf("a", "b"), 6).alias("ratio"))


def x8_planted(spark, sf_dir):
    page = "Home | World | Sport\nThe city announced in 2024 that the harbour was sold to Veixath Group for ninety million. Share this with all of your friends today.\nLater the council said that it had not been asked about the sale of the har-\nbour at all."
    rows = [(1, "Harbour sold", page), (2, "Nothing", "Menu > Home > News"), (3, "", "")]
    udf = F.pandas_udf(lambda a, b: a.combine(b, rerank.denoise_body), "string")
    return spark.createDataFrame(rows, "i int, title string, body string").select("i", udf("title", "body").alias("text"))


def x13_planted(spark, sf_dir):
    """Of two like stories the better one stays, and the pool ends before the last."""
    same = "The council met on Monday and heard the plan for the old bridge in the town. " * 3
    rows = [("i", "a", 1, "Council hears plan", same, 0.9), ("i", "b", 2, "Council hears plan", same, 0.8), ("i", "c", 3, "Airline drops offer", "Drivers of an airline said in 2024 that they would strike because of their wages this summer again. " * 3, 0.7), ("i", "d", 4, "Late story", "A museum was opened", 0.1)]
    df = spark.createDataFrame(rows, "interest string, id string, dense_rank int, title string, text string, rerank_score double")
    return rerank.collapse(df, rerank.OverlapScorer(), 3, 3, mean=0.05).select("interest", "rank", "id")


def g10_planted(spark, sf_dir):
    """A text long enough for a summary, one too short, and none."""
    rows = [("i", 1, "a", "Harbour sold", "en", "The city sold its harbour after a long debate. " * 12), ("i", 2, "b", "Harbour sold", "en", "Too short."), ("i", 3, "c", None, None, None)]
    return writing.write_hits(spark.createDataFrame(rows, "interest string, rank int, id string, title string, lang string, text string"), writing.LeadGenerator()).select("id", "status", F.length("summary").alias("chars"))


def r15_planted(spark, sf_dir):
    rows = [(1, 1, 1, 0.2, [1.0, 0.0]), (1, 2, 2, 1.0, [0.0, 1.0]), (2, 1, 3, 0.6, [3.0, 4.0])]
    p = profile.fold_profiles(spark.createDataFrame(rows, "user_id long, ts long, event_id long, signal double, vec array<double>"))
    return p.select("user_id", "n", F.round("weight", 6).alias("weight"), F.round(F.get("centre", F.lit(0)), 6).alias("first"), F.round(F.get("centre", F.lit(1)), 6).alias("second"))


def page_filters_planted(spark, sf_dir):
    rows = [(1, "https://x.example/story", 600, "Text/HTML; charset=x", "<html><p>x</p>"), (2, "https://x.example/TAG/a", 600, "text/html", "  <?xml version='1'?>"), (3, "https://x.example/s", 499, "text/html", "<title> Login</title>"), (4, "https://x.example/s", 5_000_001, "text/html", "a captcha"), (5, "https://x.example/s?s=1", 600, "text/html", "Access Denied"), (6, None, 500, "text/html", None), (7, "https://x.example/s", 5_000_000, "application/pdf", "x" * 3000 + "captcha")]
    df = spark.createDataFrame(rows, "i int, url string, size int, kind string, html string")
    return df.select("i", html.before_decode(F.col("url"), F.col("size"), F.col("kind")).alias("early"), html.after_decode(F.col("html")).alias("late"))


QUERIES = {
    "r1_embed": r1_embed, "r18_resume_index": r18_resume_index, "k2_run_rows": k2_run_rows, "k5_migrate": k5_migrate, "r4_tag_specs": r4_tag_specs, "r5_aggregate_specs": r5_aggregate_specs, "n12_payload": n12_payload,
    "n11_full_articles": n11_full_articles, "n36_article_meta": n36_article_meta, "g16_feed_summary": g16_feed_summary, "a16_feed_counts": a16_feed_counts, "a12_by_interest": a12_by_interest, "a11_hit_rates": a11_hit_rates, "j10_neighbours": j10_neighbours,
    "k9_result_blocks": k9_result_blocks, "x15_rerank_rows": x15_rerank_rows, "a10_shortlist_averages": a10_shortlist_averages, "udtf_segments": udtf_segments, "dp2_planted": dp2_planted, "dp7_planted": dp7_planted, "a9_planted": a9_planted, "dp6_planted": dp6_planted,
    "title_ratio_planted": title_ratio_planted, "x8_planted": x8_planted, "x13_planted": x13_planted, "g10_planted": g10_planted, "r15_planted": r15_planted, "page_filters_planted": page_filters_planted,
}

_N = lambda c: f"nullif({strip(c)}, '')"
_HOST = r"regexp_replace(lower(regexp_extract(coalesce(payload.url,''), '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*).*$', 2)), '^www\.', '')"
_TITLE = "substr(split_part(coalesce(text,''), chr(10), 1), 1, 120)"
_FIRST = lambda *c: "coalesce(" + ", ".join(f"nullif({x}, '')" for x in c) + ")"
ORACLES = {
    "r1_embed": rf"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower({_TITLE}), '[\p{{L}}\p{{N}}_]+')) AS w FROM documents), b AS (SELECT doc_id, CAST('0x'||substr(md5(w),1,8) AS UBIGINT) % 64 AS b, sum(CASE WHEN substr(md5(w),9,1) < '8' THEN 1.0 ELSE -1.0 END) AS s FROM w GROUP BY 1, 2),
n AS (SELECT doc_id, count(*) FILTER (WHERE s <> 0) AS filled, max(abs(s)) / (sqrt(sum(s * s)) + 1e-12) AS top FROM b GROUP BY 1) SELECT d.doc_id, CAST(coalesce(filled, 0) AS INTEGER) AS filled, round(coalesce(top, 0), 5) AS top FROM documents d LEFT JOIN n USING (doc_id)""",
    "r18_resume_index": "SELECT doc_id, 64 AS dims FROM documents",
    "k2_run_rows": "WITH r AS (SELECT retrieval_run_id, row_number() OVER (ORDER BY retrieval_run_id) AS run_id FROM (SELECT DISTINCT retrieval_run_id FROM retrieval_hits)) SELECT run_id, retrieval_run_id AS source_run_id, interest, rank, article_id FROM retrieval_hits JOIN r USING (retrieval_run_id)",
    "k5_migrate": f"WITH {LATEST} SELECT id, coalesce(lang, 'und') AS lang, epoch_us(updated_at) AS first_us, 0::BIGINT AS views FROM a",
    "r4_tag_specs": f"WITH t AS (SELECT DISTINCT unnest(tags) AS tag FROM eval_articles), p AS (SELECT row_number() OVER (ORDER BY tag) - 1 AS pos, {strip('tag')} AS text FROM t), f AS (SELECT {norm('text')} AS k, min(pos) AS pos, arg_min(text, pos) AS text FROM p GROUP BY 1 HAVING {norm('text')} <> '') SELECT interest, CAST(10000 + pos AS INTEGER) AS q_pos, text, 0.2::DOUBLE AS weight, 'expansion' AS kind FROM (SELECT DISTINCT interest FROM interest_expansions WHERE interest IS NOT NULL), f",
    "r5_aggregate_specs": f"""WITH e AS (SELECT interest, unnest(range(0, len(items))) AS pos, unnest(items) AS item FROM interest_expansions WHERE interest IS NOT NULL),
a AS (SELECT interest, 0 AS q_pos, interest AS text, 1.0::DOUBLE AS weight, 'anchor' AS kind FROM interest_expansions WHERE interest IS NOT NULL UNION ALL SELECT interest, pos + 1, item, 0.15 + 0.1 * (pos % 4), 'expansion' FROM e WHERE trim(coalesce(item, '')) <> ''),
u AS (SELECT DISTINCT ON (interest, q_pos) * FROM a), k AS (SELECT *, {norm('text')} AS key FROM u WHERE {norm('text')} <> ''),
b AS (SELECT *, min(q_pos) OVER (PARTITION BY interest, key) AS first_pos, row_number() OVER (PARTITION BY interest, key ORDER BY (kind = 'anchor') DESC, weight DESC, q_pos) AS r FROM k),
m AS (SELECT interest, row_number() OVER (PARTITION BY interest ORDER BY first_pos) AS q_pos, text, weight, kind, key FROM b WHERE r = 1),
l AS (SELECT string_agg(DISTINCT interest, '; ' ORDER BY interest) AS label FROM m), g AS (SELECT label, row_number() OVER (ORDER BY interest, q_pos) AS p, text, weight, kind, key FROM m, l),
h AS (SELECT *, min(p) OVER (PARTITION BY key) AS first_pos, row_number() OVER (PARTITION BY key ORDER BY (kind = 'anchor') DESC, weight DESC, p) AS r FROM g)
SELECT label AS interest, CAST(row_number() OVER (ORDER BY first_pos) AS INTEGER) AS q_pos, lower(trim(text)) AS text, round(weight, 4) AS weight, kind FROM h WHERE r = 1""",
    "n12_payload": f"SELECT retrieval_run_id, interest, rank, nullif(payload.article_id, '') AS id, nullif(payload.title, '') AS title, md5(coalesce(nullif(payload.canonical_text, ''), nullif(payload.description, ''), '')) AS content_md5, coalesce(nullif(payload.domain, ''), {_HOST}) AS source, nullif(payload.lang, '') AS lang FROM retrieval_hits",
    "n11_full_articles": f"""WITH {LATEST}, n AS (SELECT id, {_N('title')} AS title, {_N('content')} AS content, {_N('url')} AS url, {_N('source')} AS source, lower({_N('lang')}) AS lang FROM a) SELECT id, md5({strip("coalesce(title,'')||chr(10)||chr(10)||substr(coalesce(content,''),1,1200)")}) AS canonical_md5,
coalesce(nullif({_HOST.replace('payload.url', 'url')}, ''), source) AS source, lang, md5(lower(coalesce(url,''))||'||'||lower(coalesce(title,''))||'||'||substr(lower(coalesce(content,'')),1,400)) AS fingerprint FROM n""",
    "n36_article_meta": f"WITH {LATEST} SELECT retrieval_run_id, interest, rank, {_FIRST('payload.article_id', 'a.id', 'h.article_id')} AS article_id, {_FIRST('payload.title', 'a.title')} AS title, {_FIRST('payload.url', 'a.url')} AS url, {_FIRST('payload.domain', 'a.source')} AS source, {_FIRST('a.published_date', 'payload.date')} AS published_date, {_FIRST('payload.lang', 'a.lang')} AS lang FROM retrieval_hits h LEFT JOIN a ON a.id = h.article_id",
    "g16_feed_summary": f"SELECT id, md5(CASE WHEN id % 2 = 0 AND summary_fr IS NULL THEN '{{\"n\":1}}' WHEN id % 2 = 0 THEN summary_fr WHEN starts_with({strip('summary_fr')}, '{{') AND json_valid({strip('summary_fr')}) THEN coalesce(list_filter(list_transform(json_keys({strip('summary_fr')}), lambda k: CASE WHEN json_type({strip('summary_fr')}, '$.'||k) = 'VARCHAR' THEN json_extract_string({strip('summary_fr')}, '$.'||k) END), lambda v: v IS NOT NULL)[1], {strip('summary_fr')}) WHEN starts_with({strip('summary_fr')}, '{{') THEN {strip('replace(replace(' + strip('summary_fr') + chr(44) + chr(39) + '{{\"summary_fr\": \"' + chr(39) + chr(44) + chr(39) * 2 + ')' + chr(44) + chr(39) + '\"}}' + chr(39) + chr(44) + chr(39) * 2 + ')')} ELSE coalesce({strip('summary_fr')}, '') END) AS text_md5 FROM article_summaries",
    "a16_feed_counts": "SELECT count(DISTINCT interest) AS topics, count(*) AS articles FROM article_summaries WHERE coalesce(notes, '') = ''",
    "a12_by_interest": f"WITH {_EV} SELECT first_expected AS interest, sum(ok::INT)::BIGINT||'/'||count(*) AS score, round(avg(rank_points) FILTER (WHERE found), 6) AS rank_avg FROM z GROUP BY 1",
    "a11_hit_rates": f"WITH {_EV} SELECT count(*) AS items, round(avg((ok AND found_rank <= 20)::INT), 6) AS hit_at_20, round(avg(CASE WHEN ok THEN 1.0 / found_rank ELSE 0 END), 6) AS mrr, round(avg((found AND found_rank <= 20)::INT), 6) AS any_hit_at_20 FROM z",
    "j10_neighbours": f"WITH {LATEST}, h AS (SELECT DISTINCT retrieval_run_id||'#'||lower(interest) AS interest, a.id, a.lang, a.updated_at AS d FROM retrieval_hits JOIN a ON a.id = article_id), k AS (SELECT DISTINCT retrieval_run_id||'#'||lower(interest) AS interest, article_id AS id FROM retrieval_hits WHERE rank <= 10) SELECT DISTINCT x.interest, x.id AS a, y.id AS b FROM h x JOIN h y ON x.interest = y.interest AND x.id <> y.id AND (coalesce(x.lang, '') = '' OR x.lang = y.lang) AND (x.d IS NULL OR abs(epoch_us(x.d) - epoch_us(y.d)) <= 259200000000) JOIN k ON k.interest = y.interest AND k.id = y.id",
    "k9_result_blocks": "SELECT retrieval_run_id||'#'||lower(interest) AS interest, CAST(count(*) AS INTEGER) AS n, md5(string_agg(rank||':'||article_id, ',' ORDER BY rank)) AS articles_md5 FROM retrieval_hits GROUP BY retrieval_run_id, lower(interest)",
    "x15_rerank_rows": r"""WITH h AS (SELECT lower(interest)||' '||retrieval_run_id AS interest, rank AS dr, article_id AS id, list_distinct(regexp_extract_all(lower(interest)||' '||retrieval_run_id, '[\p{L}\p{N}_]+')) AS q, list_distinct(regexp_extract_all(lower(concat_ws(chr(10), payload.title, payload.canonical_text)), '[\p{L}\p{N}_]+')) AS d FROM retrieval_hits),
s AS (SELECT *, 1 / (1 + exp(-8 * (len(list_intersect(q, d)) / len(q) - 0.5))) AS score FROM h), r AS (SELECT interest, id, round(score, 6) AS rerank_score, CAST(row_number() OVER (PARTITION BY interest ORDER BY round(score, 8) DESC, dr, id) AS INTEGER) AS rank FROM s) SELECT * FROM r WHERE rank <= 20""",
    "dp2_planted": f"SELECT interest, id, CAST(source_rank AS INTEGER) AS source_rank, CAST(rank AS INTEGER) AS rank, reason FROM {_DEDUPED}",
    "dp7_planted": f"SELECT interest, CAST(rank AS INTEGER) AS rank, id, CAST(source_rank AS INTEGER) AS source_rank FROM {_DEDUPED} WHERE rank > 0",
    "a9_planted": f"SELECT reason, count(*) AS n FROM {_DEDUPED} WHERE reason <> '' GROUP BY 1",
    "dp6_planted": "SELECT * FROM (VALUES ('a', 1, false), ('b', 0, true), ('c', 2, false)) v(id, rank, by_story)",
    "title_ratio_planted": "SELECT i, CAST(r AS DOUBLE) AS ratio FROM (VALUES (0, 1.0), (1, 0.75), (2, 0.0), (3, 0.615385), (4, 0.0), (5, 0.995)) v(i, r)",
    "x8_planted": "SELECT * FROM (VALUES (1, 'Sport The city announced in 2024 that the harbour was sold to Veixath Group for ninety million. Later the council said that it had not been asked about the sale of the harbour at all.'), (2, ''), (3, '')) v(i, text)",
    "x13_planted": "SELECT * FROM (VALUES ('i', 1, 'a'), ('i', 2, 'c')) v(interest, rank, id)",
    "g10_planted": "SELECT id, status, CAST(chars AS INTEGER) AS chars FROM (VALUES ('a', 'OK', 563), ('b', 'FAIL', 0), ('c', 'FAIL', 0)) v(id, status, chars)",
    "r15_planted": "SELECT user_id::BIGINT AS user_id, n::BIGINT AS n, weight::DOUBLE AS weight, first::DOUBLE AS first, second::DOUBLE AS second FROM (VALUES (1, 2, 1.0, 0.993884, 0.110432), (2, 1, 1.0, 3.0, 4.0)) v(user_id, n, weight, first, second)",
    "page_filters_planted": "SELECT * FROM (VALUES (1, true, true), (2, false, false), (3, false, false), (4, false, false), (5, false, false), (6, true, true), (7, false, true)) v(i, early, late)",
}
