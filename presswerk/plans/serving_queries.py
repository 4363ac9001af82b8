"""Writing, serving, evaluation, ledger and profile queries, with oracle statements."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from presswerk.functions import text as t
from presswerk.operators import evaluation, profile, store, writing
from presswerk.plans.curation_queries import LATEST, latest, nurl
from presswerk.plans.text_queries import norm, strip
from presswerk.session import read_table
from presswerk.sources import readers


def summaries(spark, sf_dir):
    return read_table(spark, sf_dir, "article_summaries")


def visible(df):
    return df.where(F.coalesce("notes", F.lit("")) == "")


def v1_interests(spark, sf_dir):
    return visible(summaries(spark, sf_dir)).select("interest").distinct()


def v2_stories(spark, sf_dir):
    """Rows of the latest run of each interest without notes; the run is taken before the notes are looked at."""
    s = summaries(spark, sf_dir)
    s = s.withColumn("last", F.max("writing_run_id").over(Window.partitionBy("interest"))).where("writing_run_id = last")
    s = visible(s)
    w = Window.partitionBy("interest").orderBy(F.desc_nulls_first("published_date"), "rank")
    return s.select("interest", "rank", "article_id", F.row_number().over(w).alias("place"))


def v4_latest_writing(spark, sf_dir):
    s = summaries(spark, sf_dir)
    last = s.agg(F.max("writing_run_id").alias("last"))
    return s.join(F.broadcast(last), s.writing_run_id == F.col("last")).select("interest", "rank", "article_id")  # one row


def v5_rank_points(spark, sf_dir):
    h = read_table(spark, sf_dir, "retrieval_hits")
    return h.select("retrieval_run_id", "interest", "rank", F.expr("cast(1 + rank % 25 as int)").alias("target")).withColumn("points", evaluation.rank_points(F.col("rank"), F.col("target")))


def _evaluated(spark, sf_dir):
    h = read_table(spark, sf_dir, "retrieval_hits").select(F.lower("interest").alias("interest"), "rank", F.col("article_id").alias("id"), F.col("payload.url").alias("url"))
    return evaluation.evaluate(read_table(spark, sf_dir, "eval_articles"), h)


def v6_eval_items(spark, sf_dir):
    return _evaluated(spark, sf_dir)


def a11_eval_global(spark, sf_dir):
    e = _evaluated(spark, sf_dir)
    return e.agg(F.count("*").alias("total"), F.sum(F.col("ok").cast("long")).alias("right"), F.round(F.avg(F.col("ok").cast("double")), 6).alias("ratio"), F.round(F.coalesce(F.avg(F.when(F.col("ok"), F.col("rank_points"))), F.lit(0.0)), 6).alias("points"))


def a12_eval_by_interest(spark, sf_dir):
    e = _evaluated(spark, sf_dir).groupBy("first_expected").agg(F.count("*").alias("total"), F.sum(F.col("ok").cast("long")).alias("right"))
    return e.select("first_expected", F.concat(F.col("right").cast("string"), F.lit("/"), F.col("total").cast("string")).alias("score"))


def a1_latest_runs(spark, sf_dir):
    return store.latest_runs(read_table(spark, sf_dir, "retrieval_hits").withColumn("interest", F.lower("interest")))


def w6_latest_run_rows(spark, sf_dir):
    h = read_table(spark, sf_dir, "retrieval_hits")
    return h.withColumn("last", F.max("retrieval_run_id").over(Window.partitionBy(F.lower("interest")))).where("retrieval_run_id = last").select("retrieval_run_id", "interest", "rank", "article_id")


def s12_articles_top(spark, sf_dir):
    """A top-k report: the 100 latest updated articles."""
    return latest(spark, sf_dir).orderBy(F.desc_nulls_last("updated_at"), "id").limit(100).select("id", F.unix_micros("updated_at").alias("updated_us"))


def s13_run_blocks(spark, sf_dir):
    b = store.blocks(read_table(spark, sf_dir, "retrieval_hits"), "retrieval_run_id")
    return b.select("retrieval_run_id", "interest", F.col("n").cast("long").alias("n"), F.md5(F.array_join(F.transform("hits", lambda h: F.concat_ws(":", h["rank"].cast("string"), h["article_id"])), ",")).alias("hits_md5"))


def k1_upsert(spark, sf_dir):
    """The articles, with the evaluation items over them, keyed by id."""
    a = read_table(spark, sf_dir, "articles").select("id", "title", "url", "updated_at")
    e = read_table(spark, sf_dir, "eval_articles").select(F.col("article_id").alias("id"), "title", "url", F.lit(None).cast("timestamp").alias("updated_at"))
    return store.upsert(a, e, ["id"]).select("id", F.md5(F.coalesce("title", F.lit(""))).alias("title_md5"))


def k3_hit_upsert(spark, sf_dir):
    h = read_table(spark, sf_dir, "retrieval_hits").select("retrieval_run_id", "interest", "rank", "article_id")
    again = h.where("rank = 1").withColumn("article_id", F.upper("article_id"))
    return store.upsert(h, again, ["retrieval_run_id", "interest", "rank"])


def k4_summary_update(spark, sf_dir):
    s = summaries(spark, sf_dir).select("id", "title", "notes")
    fix = s.where("notes is null").withColumn("notes", F.lit(""))
    return store.upsert(s, fix, ["id"]).select("id", F.md5(F.coalesce("title", F.lit(""))).alias("title_md5"), F.coalesce("notes", F.lit("none")).alias("notes"))


def j1_repair_context(spark, sf_dir):
    """Summaries without title or text with the hit at the same place of the run they were written from."""
    s = summaries(spark, sf_dir)
    runs = s.select(F.col("writing_run_id").alias("id"), F.col("writing_run_id").alias("source_run_id")).distinct()
    h = read_table(spark, sf_dir, "retrieval_hits").select(F.col("retrieval_run_id").alias("run_id"), "interest", "rank", F.col("article_id").alias("id"), F.col("payload.title").alias("title"), F.col("payload.url").alias("url"), F.col("payload.canonical_text").alias("text"))
    return writing.repair_context(s, runs, h).select("id", "article_id", F.coalesce("hit_id", F.lit("none")).alias("hit_id"), F.md5(F.coalesce("hit_text", F.lit(""))).alias("hit_md5"))


def g1_group_top(spark, sf_dir):
    """Best five hits of an interest over all runs, each article once."""
    h = read_table(spark, sf_dir, "retrieval_hits").select(F.lower("interest").alias("interest"), F.col("article_id").alias("id"), "rank", "score")
    return writing.group_top(h, 5, "score").select("interest", F.col("id").alias("article_id"), "place")


def t8_interest_page(spark, sf_dir):
    h = read_table(spark, sf_dir, "retrieval_hits").select(F.lower("interest").alias("interest")).distinct()
    first = h.orderBy("interest").limit(7)  # a page: five interests behind the first two; only these are numbered
    return first.withColumn("page", F.row_number().over(Window.orderBy("interest"))).where("page >= 3")


def j12_aliases(spark, sf_dir):
    """Interests of hits in the spelling of the expansions' table."""
    e = read_table(spark, sf_dir, "interest_expansions").where("interest is not null").groupBy(F.lower(F.trim("interest")).alias("key")).agg(F.min("interest").alias("canonical"))
    h = read_table(spark, sf_dir, "retrieval_hits").select("interest").distinct()
    return h.join(e, F.lower(F.trim("interest")) == F.col("key"), "left").select("interest", F.coalesce("canonical", "interest").alias("canonical"))


def s16_expansions(spark, sf_dir):
    """Items of expansions, trimmed, first occurrence only, of each interest's latest row."""
    e = read_table(spark, sf_dir, "interest_expansions").withColumn("file", F.concat_ws("|", "generated_at", "raw_output"))
    return readers.clean_expansions(e).select("interest", F.array_join("items", "|").alias("items"))


def g7_clean_summary(spark, sf_dir):
    return summaries(spark, sf_dir).select("id", F.md5(writing.cleaned_summary(F.col("summary_fr"))).alias("clean_md5"))


def p16_usable(spark, sf_dir):
    return summaries(spark, sf_dir).select("id", writing.is_contaminated(F.col("summary_fr"), F.col("summary_fr")).alias("contaminated"), writing.is_usable_summary(F.col("summary_fr"), F.col("summary_fr")).alias("usable"))


def g5_raw_json(spark, sf_dir):
    """Keys of the objects that the parser finds in stored answers, also where text stands around them."""
    keys = F.pandas_udf(lambda raw: raw.map(lambda x: ",".join(sorted(v)) if (v := writing.json_object(x or "")) is not None else "none"), "string")
    around = F.when(F.col("id") % 2 == 0, F.concat(F.lit("Here it is: "), "raw_llm", F.lit(" That is all."))).otherwise(F.col("raw_llm"))
    return summaries(spark, sf_dir).select("id", keys(around).alias("keys"))


def g10_write(spark, sf_dir):
    """Summaries and titles of all hits of each run's interests, by the offline generator."""
    h = read_table(spark, sf_dir, "retrieval_hits").select(F.col("interest"), "rank", F.col("article_id").alias("id"), "retrieval_run_id")
    a = latest(spark, sf_dir, wanted=h.select("id").distinct()).select("id", "title", "lang", t.stable_excerpt(F.col("content"), 9000).alias("text"))
    return writing.write_hits(h.join(a, "id").select("retrieval_run_id", "interest", "rank", "id", "title", "lang", "text"), writing.LeadGenerator(), ("retrieval_run_id",))


def r15_profiles(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    signal = F.when(F.col("event_type") == "click", 0.2).when(F.col("event_type") == "view", 0.6).when(F.col("event_type") == "purchase", 1.0)
    v = read_table(spark, sf_dir, "embeddings")
    many = v.agg(F.count("*").alias("many"))
    s = e.withColumn("signal", signal).where("signal is not null").crossJoin(F.broadcast(many)).withColumn("vec_id", F.col("event_id") % F.col("many"))  # one row
    p = profile.fold_profiles(s.join(v.select("vec_id", F.col("embedding").alias("vec")), "vec_id").select("user_id", "ts", "event_id", "signal", "vec"))
    return p.select("user_id", "n", F.round("weight", 6).alias("weight"), F.round(F.get("centre", F.lit(0)), 6).alias("first"))


def a2_cache_metadata(spark, sf_dir):
    return read_table(spark, sf_dir, "articles").agg(F.count("*").alias("n"), F.max(F.unix_micros("updated_at")).alias("latest_us"))


def a13_interest_counts(spark, sf_dir):
    return summaries(spark, sf_dir).groupBy("interest").agg(F.count("*").alias("n"), F.max("writing_run_id").alias("last"))


def n13_normalise(spark, sf_dir):
    """The articles' raw JSON under its varying names, through the article reader's own normaliser."""
    names = sorted({n for some in readers.ALIASES.values() for n in some})
    raw = latest(spark, sf_dir).select(*[F.get_json_object("raw", f"$.{n}").alias(n) for n in names])
    return readers.normalise(raw).select("id", F.md5("title").alias("title_md5"), F.md5("content").alias("content_md5"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("url", F.lit("")).alias("url"))


def d7_raw_overlay(spark, sf_dir):
    """Raw JSON overlaid by the typed columns."""
    a = latest(spark, sf_dir)
    return a.select("id", F.coalesce(F.nullif("lang", F.lit("")), F.get_json_object("raw", "$.lang"), F.lit("none")).alias("lang"), F.coalesce(F.nullif("source", F.lit("")), F.get_json_object("raw", "$.source"), F.lit("none")).alias("source"))


_UUID = "substr(m,1,8)||'-'||substr(m,9,4)||'-'||substr(m,13,4)||'-'||substr(m,17,4)||'-'||substr(m,21,12)"


def _J(name):
    """A field of the raw JSON without white space around; blank, None and nan are nothing."""
    x = strip(f"json_extract_string(raw, '$.{name}')")
    return f"nullif(nullif(nullif({x}, ''), 'None'), 'nan')"


_HITN = f"h AS (SELECT lower(interest) AS interest, rank, article_id AS id, {nurl('payload.url')} AS u FROM retrieval_hits)"
_EV = f"""{_HITN}, bi AS (SELECT id, min(struct_pack(rank, interest)) AS x FROM h GROUP BY id), bu AS (SELECT u, min(struct_pack(rank, interest)) AS x FROM h WHERE u <> '' GROUP BY u),
e AS (SELECT item_id, list_transform(coalesce(expected_interests, []), lambda y: lower(trim(y))) AS ex, coalesce(rank_target_max, 20) AS tg, coalesce(bi.x, bu.x) AS hit FROM eval_articles LEFT JOIN bi ON bi.id = article_id LEFT JOIN bu ON bu.u = {nurl('url')}),
r AS (SELECT item_id, coalesce(ex[1], '') AS first_expected, hit IS NOT NULL AS found, coalesce(hit.interest, '') AS found_interest, CAST(coalesce(hit.rank, 0) AS INTEGER) AS found_rank, coalesce(list_contains(ex, lower(trim(hit.interest))), false) AS ok, tg FROM e),
z AS (SELECT item_id, first_expected, found, found_interest, found_rank, ok, CASE WHEN NOT ok THEN 0.0::DOUBLE WHEN found_rank <= 0 THEN 0 WHEN found_rank <= least(3, tg) THEN 1 WHEN found_rank <= least(10, tg) THEN 0.7 WHEN found_rank <= tg THEN 0.4 ELSE 0.1 END AS rank_points FROM r)"""
# The statements below spell the fixed phrases out, so a wrong constant in the code shows.
_LINES = r"'\r\n|[\n\x0B\f\r\x{85}\x{2028}\x{2029}]'"
_OPENING = "CASE WHEN starts_with(lower(x), 'OPENING') AND contains(x, '.') THEN " + strip(r"regexp_replace(x, '(?s)^[^.]*\.', '')") + " ELSE x END"
_CLEAN = rf"""c0 AS (SELECT id, summary_fr, {strip("coalesce(summary_fr, '')")} AS x FROM article_summaries),
c1 AS (SELECT id, summary_fr, {_OPENING.replace('OPENING', 'according to')} AS x FROM c0), c2 AS (SELECT id, summary_fr, {_OPENING.replace('OPENING', 'based on')} AS x FROM c1), c3 AS (SELECT id, summary_fr, {_OPENING.replace('OPENING', 'here is')} AS x FROM c2),
c4 AS (SELECT id, summary_fr, {_OPENING.replace('OPENING', 'this article')} AS x FROM c3), c5 AS (SELECT id, summary_fr, {_OPENING.replace('OPENING', 'i have analyzed')} AS x FROM c4),
cl AS (SELECT id, summary_fr, list_filter(list_transform(string_split_regex(x, {_LINES}), lambda y: {strip('y')}), lambda z: z <> '') AS l FROM c5),
cs AS (SELECT id, summary_fr, {strip(r"array_to_string(list_concat([" + strip(r"regexp_replace(l[1], '(?i)^(?:summary|résumé|resume)\s*:\s*', '')") + r"], l[2:]), ' ')")} AS clean FROM cl WHERE len(l) > 0 UNION ALL SELECT id, summary_fr, '' FROM cl WHERE len(l) = 0)"""
_MARKED = """len(list_filter(['constraint checklist', 'confidence score', 'drafting the title', 'drafting the summary', 'input data:', 'output plain text only', 'first line only', 'second line onward', 'no json', 'no bullet points',
'do not reveal reasoning', 'i should use a clean english news title', 'key points from text'], lambda m: contains(lower({0}), m))) > 0"""
_THOUGHT = strip(r"regexp_replace(regexp_replace(coalesce(summary_fr, ''), '(?is)<think>.*?</think>', '', 'g'), '(?i)^```(?:json)?\s*|\s*```$', '', 'g')")
_USABLE = rf"""WITH {_CLEAN}, an AS (SELECT id, clean, {_THOUGHT} AS answer, {strip("coalesce(summary_fr, '')")} AS body FROM cs),
it AS (SELECT *, len(list_filter(string_split_regex(answer, {_LINES}), lambda y: regexp_matches({strip('y')}, '^(?:[-*•]+|[0-9]+[.)])\s+'))) AS items FROM an),
ck AS (SELECT *, ({_MARKED.format('answer')} OR items >= 3) AS bad, ({_MARKED.format('body')} OR (items >= 1 AND (contains(body, '*') OR contains(body, '- ') OR contains(body, '1.')))) AS bad_body, ({_MARKED.format('clean')} OR (items >= 1 AND (contains(clean, '*') OR contains(clean, '- ') OR contains(clean, '1.')))) AS bad_clean FROM it)
SELECT id, bad OR bad_body AS contaminated, length(clean) >= 350 AND NOT (bad OR bad_clean) AS usable FROM ck"""

QUERIES = {
    "v1_feed_interests": v1_interests, "v2_feed_stories": v2_stories, "v4_latest_writing": v4_latest_writing, "v5_rank_points": v5_rank_points, "v6_eval_items": v6_eval_items, "a11_eval_global": a11_eval_global,
    "a12_eval_by_interest": a12_eval_by_interest, "a1_latest_runs": a1_latest_runs, "w6_latest_run_rows": w6_latest_run_rows, "s12_articles_top": s12_articles_top, "s13_run_blocks": s13_run_blocks, "k1_upsert_articles": k1_upsert,
    "k3_upsert_hits": k3_hit_upsert, "k4_update_summaries": k4_summary_update, "j1_repair_context": j1_repair_context, "g1_group_top": g1_group_top, "t8_interest_page": t8_interest_page, "j12_interest_aliases": j12_aliases,
    "s16_expansions": s16_expansions, "g7_clean_summary": g7_clean_summary, "g_usable_summary": p16_usable, "g5_raw_json": g5_raw_json, "g10_write": g10_write, "r15_profiles": r15_profiles, "a2_cache_metadata": a2_cache_metadata,
    "a13_interest_counts": a13_interest_counts, "n13_normalise": n13_normalise, "d7_raw_overlay": d7_raw_overlay,
}
ORACLES = {
    "v1_feed_interests": "SELECT DISTINCT interest FROM article_summaries WHERE coalesce(notes, '') = ''",
    "v2_feed_stories": "WITH s AS (SELECT * FROM article_summaries QUALIFY writing_run_id = max(writing_run_id) OVER (PARTITION BY interest)) SELECT interest, rank, article_id, CAST(row_number() OVER (PARTITION BY interest ORDER BY published_date DESC NULLS FIRST, rank) AS INTEGER) AS place FROM s WHERE coalesce(notes, '') = ''",
    "v4_latest_writing": "SELECT interest, rank, article_id FROM article_summaries WHERE writing_run_id = (SELECT max(writing_run_id) FROM article_summaries)",
    "v5_rank_points": "SELECT retrieval_run_id, interest, rank, target, CASE WHEN rank <= 0 THEN 0.0::DOUBLE WHEN rank <= least(3, target) THEN 1 WHEN rank <= least(10, target) THEN 0.7 WHEN rank <= target THEN 0.4 ELSE 0.1 END AS points FROM (SELECT retrieval_run_id, interest, rank, CAST(1 + rank % 25 AS INTEGER) AS target FROM retrieval_hits)",
    "v6_eval_items": f"WITH {_EV} SELECT * FROM z",
    "a11_eval_global": f"WITH {_EV} SELECT count(*) AS total, CAST(sum(ok::INT) AS BIGINT) AS right, round(avg(ok::INT), 6) AS ratio, round(coalesce(avg(rank_points) FILTER (WHERE ok), 0), 6) AS points FROM z".replace("AS right", 'AS "right"'),
    "a12_eval_by_interest": f"WITH {_EV} SELECT first_expected, sum(ok::INT)::BIGINT||'/'||count(*) AS score FROM z GROUP BY first_expected",
    "a1_latest_runs": "SELECT lower(interest) AS interest, max(retrieval_run_id) AS retrieval_run_id FROM retrieval_hits GROUP BY 1",
    "w6_latest_run_rows": "SELECT retrieval_run_id, interest, rank, article_id FROM retrieval_hits QUALIFY retrieval_run_id = max(retrieval_run_id) OVER (PARTITION BY lower(interest))",
    "s12_articles_top": f"WITH {LATEST} SELECT id, epoch_us(updated_at) AS updated_us FROM a ORDER BY updated_at DESC NULLS LAST, id LIMIT 100",
    "s13_run_blocks": "SELECT retrieval_run_id, interest, count(*) AS n, md5(string_agg(rank||':'||article_id, ',' ORDER BY rank)) AS hits_md5 FROM retrieval_hits GROUP BY ALL",
    "k1_upsert_articles": f"WITH {LATEST} SELECT id, md5(coalesce(title,'')) AS title_md5 FROM a WHERE id NOT IN (SELECT article_id FROM eval_articles WHERE article_id IS NOT NULL) UNION ALL SELECT article_id, md5(coalesce(title,'')) FROM eval_articles WHERE trim(coalesce(article_id,'')) <> ''",
    "k3_upsert_hits": "SELECT retrieval_run_id, interest, rank, CASE WHEN rank = 1 THEN upper(article_id) ELSE article_id END AS article_id FROM retrieval_hits",
    "k4_update_summaries": "SELECT id, md5(coalesce(title,'')) AS title_md5, coalesce(notes, '') AS notes FROM article_summaries",
    "j1_repair_context": "SELECT s.id, s.article_id, coalesce(h.article_id, 'none') AS hit_id, md5(coalesce(h.payload.canonical_text, '')) AS hit_md5 FROM article_summaries s LEFT JOIN retrieval_hits h ON h.retrieval_run_id = s.writing_run_id AND h.interest = s.interest AND h.rank = s.rank WHERE trim(coalesce(s.title, '')) = '' OR trim(coalesce(s.summary_fr, '')) = ''",
    "g1_group_top": "WITH f AS (SELECT lower(interest) AS interest, article_id, coalesce(score, -1) AS score, rank FROM retrieval_hits QUALIFY row_number() OVER (PARTITION BY lower(interest), article_id ORDER BY coalesce(score, -1) DESC, rank, retrieval_run_id) = 1) SELECT interest, article_id, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY interest ORDER BY score DESC, rank, article_id) AS place FROM f) WHERE place <= 5",
    "t8_interest_page": "SELECT interest, CAST(page AS INTEGER) AS page FROM (SELECT interest, row_number() OVER (ORDER BY interest) AS page FROM (SELECT DISTINCT lower(interest) AS interest FROM retrieval_hits)) WHERE page BETWEEN 3 AND 7",
    "j12_interest_aliases": "SELECT h.interest, coalesce(canonical, h.interest) AS canonical FROM (SELECT DISTINCT interest FROM retrieval_hits) h LEFT JOIN (SELECT lower(trim(interest)) AS key, min(interest) AS canonical FROM interest_expansions WHERE interest IS NOT NULL GROUP BY 1) e ON lower(trim(h.interest)) = key",
    "s16_expansions": f"WITH l AS (SELECT interest, items FROM interest_expansions WHERE interest IS NOT NULL AND items IS NOT NULL QUALIFY row_number() OVER (PARTITION BY interest ORDER BY concat_ws('|', generated_at, raw_output) DESC) = 1), u AS (SELECT interest, unnest(range(0, len(items))) AS pos, unnest(items) AS raw_item FROM l), i AS (SELECT interest, pos, {strip('raw_item')} AS item FROM u), f AS (SELECT interest, item, min(pos) AS pos FROM i WHERE item <> '' GROUP BY 1, 2) SELECT l.interest, coalesce(string_agg(item, '|' ORDER BY pos), '') AS items FROM l LEFT JOIN f USING (interest) GROUP BY l.interest",
    "g7_clean_summary": f"WITH {_CLEAN} SELECT id, md5(clean) AS clean_md5 FROM cs",
    "g_usable_summary": _USABLE,
    "g5_raw_json": "SELECT id, coalesce(array_to_string(list_sort(json_keys(raw_llm)), ','), 'none') AS keys FROM article_summaries",
    "r15_profiles": """WITH RECURSIVE g AS (SELECT user_id, event_id, ts, CASE event_type WHEN 'click' THEN 0.2 WHEN 'view' THEN 0.6 WHEN 'purchase' THEN 1.0 END AS signal, event_id % (SELECT count(*) FROM embeddings) AS v FROM events),
s AS (SELECT user_id, CAST(signal AS DOUBLE) AS signal, CAST(embedding AS DOUBLE[]) AS vec, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g JOIN embeddings ON vec_id = v WHERE signal IS NOT NULL AND user_id IS NOT NULL),
f AS (SELECT user_id, k, vec AS c, 1.0::DOUBLE AS w FROM s WHERE k = 1 UNION ALL
SELECT user_id, k, CASE WHEN n > 0 THEN list_transform(m, lambda x: x / n) ELSE m END, w FROM (SELECT user_id, k, w, m, sqrt(list_sum(list_transform(m, lambda x: x * x))) AS n FROM
(SELECT s.user_id, s.k, 0.95 * f.w + 0.05 * s.signal AS w, list_transform(list_zip(f.c, s.vec), lambda p: (1 - 0.1 * least(1, greatest(0.1, s.signal))) * p[1] + 0.1 * least(1, greatest(0.1, s.signal)) * p[2]) AS m FROM f JOIN s ON s.user_id = f.user_id AND s.k = f.k + 1)))
SELECT user_id, k AS n, round(w, 6) AS weight, round(c[1], 6) AS first FROM f QUALIFY k = max(k) OVER (PARTITION BY user_id)""",
    "a2_cache_metadata": "SELECT count(*) AS n, max(epoch_us(updated_at)) AS latest_us FROM articles",
    "a13_interest_counts": "SELECT interest, count(*) AS n, max(writing_run_id) AS last FROM article_summaries GROUP BY interest",
    "n13_normalise": f"""WITH {LATEST}, j AS (SELECT coalesce({_J('headline')}, {_J('title')}) AS title, coalesce({_J('text')}, {_J('article')}, {_J('description')}, {_J('content')}) AS content, coalesce({_J('source_name')}, {_J('domain')}, {_J('source')}) AS source, coalesce({_J('link')}, {_J('url')}) AS url FROM a),
k AS (SELECT *, md5(CASE WHEN coalesce(url, '') <> '' THEN url ELSE {strip("title||'||'||substr(content, 1, 400)")} END) AS m FROM j WHERE title IS NOT NULL AND content IS NOT NULL), u AS (SELECT {_UUID} AS id, title, content, source, url FROM k),
f AS (SELECT id, count(DISTINCT title||chr(31)||content||chr(31)||coalesce(source, '')||chr(31)||coalesce(url, '')) AS n FROM u GROUP BY id) SELECT DISTINCT id, md5(title) AS title_md5, md5(content) AS content_md5, coalesce(source, '') AS source, coalesce(url, '') AS url FROM u""",
    "d7_raw_overlay": f"WITH {LATEST} SELECT id, coalesce(nullif(lang,''), json_extract_string(raw, '$.lang'), 'none') AS lang, coalesce(nullif(source,''), json_extract_string(raw, '$.source'), 'none') AS source FROM a",
}
