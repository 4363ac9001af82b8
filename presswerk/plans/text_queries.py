"""Queries of the text, key, url and date scalars, with their oracle statements."""

from __future__ import annotations

from pyspark.sql import functions as F

from presswerk.functions import text as t
from presswerk.session import read_table

SPACE = r"[\s\p{Z}]"
STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
NORM = r"lower(regexp_replace(regexp_replace(coalesce({0}, ''), '[\s\p{{Z}}]+', ' ', 'g'), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'))"


def strip(x):
    return STRIP.format(x)


def norm(x):
    return NORM.format(x)


def _uuid(x):
    return f"substr({x},1,8)||'-'||substr({x},9,4)||'-'||substr({x},13,4)||'-'||substr({x},17,4)||'-'||substr({x},21,12)"


_QUERIES, _SQL = {}, {}


def _add(name, table, columns, sql):
    def run(spark, sf_dir):
        return read_table(spark, sf_dir, table).select(*[c.alias(a) for a, c in columns().items()])

    _QUERIES[name] = run
    _SQL[name] = sql


_add("n1_norm_text", "articles", lambda: {"id": F.col("id"), "norm": t.norm_text(F.col("title"))}, f"SELECT id, {norm('title')} AS norm FROM articles")
_add("n2_tokens_unicode", "documents", lambda: {"doc_id": F.col("doc_id"), "n": F.size(t.unicode_tokens(F.col("text"))), "kinds": F.size(F.array_distinct(t.unicode_tokens(F.col("text")))), "tokens_md5": F.md5(F.array_join(t.unicode_tokens(F.col("text")), " "))},
     r"SELECT doc_id, CAST(len(w) AS INTEGER) AS n, CAST(len(list_distinct(w)) AS INTEGER) AS kinds, md5(array_to_string(w, ' ')) AS tokens_md5 FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text,'')), '[\p{L}\p{N}_]+') AS w FROM documents)")
_add("n3_tokens_ascii", "documents", lambda: {"doc_id": F.col("doc_id"), "n": F.size(t.ascii_tokens(F.col("text"))), "tokens_md5": F.md5(F.array_join(t.ascii_tokens(F.col("text")), " "))},
     r"SELECT doc_id, CAST(len(w) AS INTEGER) AS n, md5(array_to_string(w, ' ')) AS tokens_md5 FROM (SELECT doc_id, list_filter(regexp_extract_all(lower(coalesce(text,'')), '[a-z0-9][a-z0-9''_-]*'), lambda x: length(x) > 1) AS w FROM documents)")
_add("n4_rerank_tokens", "articles", lambda: {"id": F.col("id"), "words": t.word_count(F.col("content")), "title_tokens": F.array_join(t.title_tokens(F.col("title")), " ")},
     r"SELECT id, CAST(len(regexp_extract_all(coalesce(content,''), '[\p{L}\p{N}_]+')) AS INTEGER) AS words, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(lower(coalesce(title,'')), '[\p{L}\p{N}_''-]*[\p{L}\p{N}_][\p{L}\p{N}_''-]*'), lambda x: length(x) >= 3))), ' ') AS title_tokens FROM articles")
_add("n5_parse_date", "articles", lambda: {"id": F.col("id"), "epoch": F.coalesce(F.unix_seconds(t.iso_instant(F.col("published_date"))).cast("string"), F.lit("none"))},
     rf"""SELECT id, coalesce(CAST(CASE WHEN regexp_full_match(d, '\d{{4}}-\d{{2}}-\d{{2}}([T ]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d{{1,9}})?)?(Z|[+-]\d{{2}}:?\d{{2}})?)?')
     THEN CAST(floor(epoch(try_cast(regexp_replace(d, '([+-]\d{{2}})(\d{{2}})$', '\1:\2') AS TIMESTAMPTZ))) AS BIGINT) END AS VARCHAR), 'none') AS epoch FROM (SELECT id, {strip('published_date')} AS d FROM articles)""")
_add("n6_parse_date_column", "articles", lambda: {"id": F.col("id"), "epoch": F.coalesce(F.unix_seconds(t.column_instant(F.col("published_date"))).cast("string"), F.lit("none"))},
     rf"""SELECT id, coalesce(CAST(CASE WHEN regexp_full_match(p, '\d{{14}}') THEN CAST(epoch(try_strptime(p, '%Y%m%d%H%M%S')) AS BIGINT) WHEN regexp_full_match(d, '\d{{4}}-\d{{2}}-\d{{2}}([T ]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d{{1,9}})?)?(Z|[+-]\d{{2}}:?\d{{2}})?)?')
     THEN CAST(floor(epoch(try_cast(regexp_replace(d, '([+-]\d{{2}})(\d{{2}})$', '\1:\2') AS TIMESTAMPTZ))) AS BIGINT) END AS VARCHAR), 'none') AS epoch FROM (SELECT id, published_date AS p, {strip('published_date')} AS d FROM articles)""")
_add("n7_wall_clock", "articles", lambda: {"id": F.col("id"), "clock": t.wall_clock(F.col("published_date"))},
     r"SELECT id, CASE WHEN regexp_matches(published_date, '^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2}).*$') THEN regexp_replace(published_date, '^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2}).*$', '\1 \2') END AS clock FROM articles")
_add("n8_hit_date", "retrieval_hits", lambda: {"article_id": F.col("article_id"), "retrieval_run_id": F.col("retrieval_run_id"), "interest": F.col("interest"), "rank": F.col("rank"), "epoch": F.coalesce(F.unix_seconds(t.iso_instant(F.col("payload.date"))).cast("string"), F.lit("none"))},
     rf"""SELECT article_id, retrieval_run_id, interest, rank, coalesce(CAST(CASE WHEN regexp_full_match(d, '\d{{4}}-\d{{2}}-\d{{2}}([T ]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d{{1,9}})?)?(Z|[+-]\d{{2}}:?\d{{2}})?)?')
     THEN CAST(floor(epoch(try_cast(regexp_replace(d, '([+-]\d{{2}})(\d{{2}})$', '\1:\2') AS TIMESTAMPTZ))) AS BIGINT) END AS VARCHAR), 'none') AS epoch FROM (SELECT *, {strip('payload.date')} AS d FROM retrieval_hits)""")
_lead = strip("coalesce(title,'')||'||'||substr(coalesce(content,''),1,400)")
_u = strip("coalesce(url,'')")
_add("n9_article_ids", "articles", lambda: {"id": F.col("id"), "key": t.article_id(F.col("url"), F.col("title"), F.col("content"))}, f"SELECT id, {_uuid('h')} AS key FROM (SELECT id, md5(CASE WHEN {_u} <> '' THEN {_u} ELSE {_lead} END) AS h FROM articles)")
_add("n10_fingerprint_ingest", "articles", lambda: {"id": F.col("id"), "print": t.ingest_fingerprint(F.col("url"), F.col("title"), F.col("content"))},
     "SELECT id, md5(lower({0})||'||'||lower({1})||'||'||substr(lower({2}),1,400)) AS print FROM articles".format(*(strip(f"coalesce({c},'')") for c in ("url", "title", "content"))))
_add("n10_fingerprint_retrieval", "articles", lambda: {"id": F.col("id"), "print": t.retrieval_fingerprint(F.col("url"), F.col("title"), F.col("content"))},
     f"SELECT id, md5({norm('title')}||'||'||{norm('url')}||'||'||substr({norm('content')},1,400)) AS print FROM articles")
_R = r"'^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*).*$'"
_add("n16_normalize_url", "articles", lambda: {"id": F.col("id"), "url": t.normal_url(F.col("url"))},
     rf"SELECT id, regexp_replace(CASE WHEN regexp_matches(u, {_R}) THEN lower(regexp_extract(u, {_R}, 1))||'://'||lower(regexp_extract(u, {_R}, 2))||regexp_extract(u, {_R}, 3) ELSE regexp_replace(u, '[?#].*$', '') END, '/+$', '') AS url FROM (SELECT id, {_u} AS u FROM articles)")
_add("n17_url_domain", "articles", lambda: {"id": F.col("id"), "domain": t.url_domain(F.col("url"))}, rf"SELECT id, regexp_replace(lower(regexp_extract(coalesce(url,''), {_R}, 2)), '^www\.', '') AS domain FROM articles")
# The twenty domains of the selection.
TOP_DOMAINS = "yahoo.com yahoo.co.jp turbopages.org naver.com qq.com msn.com news.yahoo.co.jp globo.com bbc.co.uk cnn.com news.google.com nytimes.com bbc.com dailymail.co.uk foxnews.com theguardian.com uol.com.br hindustantimes.com indiatimes.com infobae.com".split()


def in_domains(domain, domains):
    return F.exists(F.array(*[F.lit(d) for d in domains]), lambda d: (domain == d) | F.endswith(domain, F.concat(F.lit("."), d)))


_some = ["foskvillebeacon.news.example", "news.example", "grunmouthpost.example"]
_add("n18_domain_list", "articles", lambda: {"id": F.col("id"), "listed": in_domains(F.coalesce(F.col("source"), F.lit("")), [*TOP_DOMAINS, *_some])},
     f"SELECT id, len(list_filter({[*TOP_DOMAINS, *_some]!r}, lambda d: coalesce(source,'') = d OR coalesce(source,'') LIKE '%.'||d)) > 0 AS listed FROM articles")
_theme_text = lambda: F.array_join(
    F.transform(F.split(F.coalesce(F.col("title"), F.lit("")), " "), lambda x: F.concat(F.lower(x), F.lit("_x"))), ";")
_add("n19_clean_themes", "articles", lambda: {"id": F.col("id"), "themes": F.array_join(t.themes_of(_theme_text()), " ")},
     f"SELECT id, coalesce(array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(coalesce(title,''), ' '), lambda x: split_part({STRIP.format('lower(x)')}||'_x', '_', 1)), lambda y: y <> ''))), ' '), '') AS themes FROM articles")
_add("n21_charset", "documents", lambda: {"doc_id": F.col("doc_id"), "charset": t.charset_of(F.concat(F.lit("text/html; Charset="), F.coalesce(F.col("lang"), F.lit(""))))},
     r"SELECT doc_id, nullif(lower(regexp_extract('text/html; Charset='||coalesce(lang,''), '(?i)charset\s*=\s*[\x22'']?([A-Za-z0-9._-]+)', 1)), '') AS charset FROM documents")
_add("n22_tidy_lines", "documents", lambda: {"doc_id": F.col("doc_id"), "tidy_md5": F.md5(t.tidy_lines(F.col("text")))},
     rf"SELECT doc_id, md5(coalesce(array_to_string(list_filter(list_transform(string_split(regexp_replace(coalesce(text,''), '\r\n?', chr(10), 'g'), chr(10)), lambda x: {STRIP.format(chr(114)+'egexp_replace(x, '+chr(39)+'[' + chr(92)+'s' + chr(92)+'p{Z}]+'+chr(39)+', '+chr(39)+' '+chr(39)+', '+chr(39)+'g'+chr(39)+')')}), lambda y: y <> ''), chr(10)), '')) AS tidy_md5 FROM documents")
_add("n23_sanitize", "articles", lambda: {"id": F.col("id"), "url": t.strip(F.replace(F.make_valid_utf8(F.coalesce(F.col("url"), F.lit(""))), F.lit("\0"), F.lit("")))}, f"SELECT id, {_u} AS url FROM articles")
_add("n32_slug", "interest_expansions", lambda: {"interest": F.col("interest"), "slug": t.slug(F.col("interest"))},
     f"SELECT interest, substr(regexp_replace(regexp_replace(lower({strip(chr(99)+'oalesce(interest,'+chr(39)*2+')')}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 80) AS slug FROM interest_expansions")
_add("n33_payload_text", "retrieval_hits", lambda: {"retrieval_run_id": F.col("retrieval_run_id"), "interest": F.col("interest"), "rank": F.col("rank"), "text_md5": F.md5(F.coalesce(F.nullif(F.col("payload.canonical_text"), F.lit("")), F.nullif(F.col("payload.description"), F.lit("")), F.lit("")))},
     "SELECT retrieval_run_id, interest, rank, md5(coalesce(nullif(payload.canonical_text,''), nullif(payload.description,''), '')) AS text_md5 FROM retrieval_hits")
_doc_parts = lambda p: F.concat_ws("\n", F.when(t.strip(F.coalesce(p("title"), F.lit(""))) != "", F.concat(F.lit("TITLE: "), t.strip(p("title")))), F.when(t.strip(F.coalesce(p("description"), F.lit(""))) != "", F.concat(F.lit("SUMMARY: "), t.strip(p("description")))), F.when(t.strip(F.coalesce(p("canonical_text"), F.lit(""))) != "", F.concat(F.lit("BODY: "), F.substring(t.strip(p("canonical_text")), 1, 1800))))  # noqa: E731, E501
_add("n34_doc_text", "retrieval_hits", lambda: {"retrieval_run_id": F.col("retrieval_run_id"), "interest": F.col("interest"), "rank": F.col("rank"), "doc_md5": F.md5(_doc_parts(lambda c: F.col(f"payload.{c}")))},
     "SELECT retrieval_run_id, interest, rank, md5(concat_ws(chr(10), CASE WHEN t <> '' THEN 'TITLE: '||t END, CASE WHEN d <> '' THEN 'SUMMARY: '||d END, CASE WHEN c <> '' THEN 'BODY: '||substr(c,1,1800) END)) AS doc_md5 FROM (SELECT *, {0} AS t, {1} AS d, {2} AS c FROM retrieval_hits)".format(*(strip(f"coalesce(payload.{c},'')") for c in ("title", "description", "canonical_text"))))
_add("n35_stable_excerpt", "articles", lambda: {"id": F.col("id"), "excerpt_md5": F.md5(t.stable_excerpt(F.col("content"), 1000))},
     "SELECT id, md5(CASE WHEN length(c) <= 1000 THEN c ELSE substr(c,1,700)||chr(10)||'...'||chr(10)||right(c,300) END) AS excerpt_md5 FROM (SELECT id, {0} AS c FROM articles)".format(strip("coalesce(content,'')")))
_add("n38_hash_helpers", "articles", lambda: {"id": F.col("id"), "sha": F.sha1(F.concat_ws("|", F.col("id"), F.lower(F.col("fingerprint"))))}, "SELECT id, sha1(concat_ws('|', id, lower(fingerprint))) AS sha FROM articles")

QUERIES, ORACLES = _QUERIES, _SQL
