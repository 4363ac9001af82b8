"""Page extraction, archives and the pipeline, on pages made from documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from presswerk.operators import pipeline, retrieval
from presswerk.plans import retrieval_queries as rq
from presswerk.plans.text_queries import STRIP, strip
from presswerk.session import read_table, shared_folder
from presswerk.sources import files, html, readers


def pages(spark, sf_dir):
    """Each document as a web page with a menu, a head and paragraphs."""
    d = read_table(spark, sf_dir, "documents").where("text is not null")
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    escape = lambda x: F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    body = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("<p>"), escape(x), F.lit("</p>"))), "\n")
    page = F.concat(F.lit("<html><head><!-- " + "x" * 400 + " --><title>"), escape(F.coalesce(F.get(lines, F.lit(0)), F.lit(""))), F.lit("</title><meta property='article:published_time' content='2026-01-02T03:04:05+02:00'></head><body><nav><a href='/'>Home</a></nav><div class='cookie'>We use cookies</div><article>"), body, F.lit("</article><footer>Imprint</footer></body></html>"))
    url = F.concat(F.lit("https://www.page.example/story/"), F.col("doc_id").cast("string"))
    return d.select("doc_id", url.alias("url"), F.coalesce(page, F.lit("<html></html>")).alias("html"), F.lit("2026-01-01T00:00:00Z").alias("stored"))


def n28_extract(spark, sf_dir):
    out = html.extract_pages(pages(spark, sf_dir))
    return out.select(F.regexp_extract("url", r"(\d+)$", 1).cast("long").alias("doc_id"), "date", "domain", "reason", F.md5("text").alias("text_md5"))


def page_filters(spark, sf_dir):
    p = pages(spark, sf_dir)
    odd = F.when(F.col("doc_id") % 7 == 0, F.concat("url", F.lit("/comments/1"))).otherwise(F.col("url"))
    kind = F.when(F.col("doc_id") % 5 == 0, "application/pdf").otherwise("Text/HTML; charset=utf-8")
    return p.select("doc_id", html.before_decode(odd, F.length("html") + 400, kind).alias("early"), html.after_decode(F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" <?xml?>"), F.col("html"))).otherwise(F.col("html"))).alias("late"))


def s6_archive(spark, sf_dir):
    """The pages written as archive files into the shared folder and read back through the archive source."""
    import uuid

    from presswerk.session import keep_until_end

    folder = keep_until_end(spark, f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}")

    def write(batches):
        import pandas as pd

        for pdf in batches:
            if len(pdf):
                files.write_whole(f"{folder}/CC-NEWS-20260101000000-{uuid.uuid4().hex}.warc.gz", [readers.warc_bytes(list(zip(pdf["url"], pdf["stored"], pdf["html"], strict=True)))])
            yield pd.DataFrame({"n": [len(pdf)]})

    pages(spark, sf_dir).mapInPandas(write, "n long").agg(F.sum("n")).collect()  # one number
    articles, _ = readers.archive_articles(readers.read_warc(spark, folder))
    return articles.select(F.regexp_extract("url", r"(\d+)$", 1).cast("long").alias("doc_id"), F.md5("text").alias("text_md5"))


def s11_gkg(spark, sf_dir):
    """Knowledge-graph rows made from articles: short rows are skipped."""
    a = read_table(spark, sf_dir, "articles").where("source is not null")
    line = F.concat_ws("\t", F.col("id"), F.lit("20260102030405"), F.lit("1"), F.col("source"), F.coalesce("url", F.lit("")), F.lit(""), F.when(F.col("lang") == "en", F.lit("x")), F.lit("TAX_NEWS;ECON_TAX;TAX_A"))
    return readers.gkg_rows(a.select(line.alias("value"))).select("source", "url", "domain", F.array_join("themes", " ").alias("themes"), F.unix_seconds("date").alias("epoch"))


def s10_manifests(spark, sf_dir):
    s = read_table(spark, sf_dir, "documents").select(F.concat(F.lit("12 ab http://x.example/"), F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("doc_id") % 20).cast("int")), "yyyyMMdd"), F.lit("000000.gkg.csv.zip")).alias("value"))
    return readers.gkg_manifest(s.distinct(), "20260103", "20260107")


def s8_archive_manifest(spark, sf_dir):
    s = read_table(spark, sf_dir, "documents").select(F.concat(F.lit(" crawl-data/CC-NEWS-"), F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("doc_id") % 20).cast("int")), "yyyyMMdd"), F.lit("101010-00001.warc.gz")).alias("value"))
    return readers.archive_manifest(s.distinct(), "2026010")


def v8_pipeline(spark, sf_dir):
    out = pipeline.run(rq.corpus(spark, sf_dir), rq.vectors(spark, sf_dir).select("id", "vec"), rq.interest_specs(spark, sf_dir), retrieval.RetrievalConfig(), top_n=5)
    return out["written"].select("interest", "rank", "id", "status", F.length("summary").alias("chars"))


# A few function words of each language.
GUESS_WORDS = {"en": "the of and to in that for with", "fr": "le les des du et dans pour sur", "de": "der die das und im von mit für", "es": "el los las del y por con según", "it": "il gli di della nel che dopo secondo", "pt": "o os do da dos das no em com não"}


def n15_detect_lang(spark, sf_dir):
    """A stand-in for a detector's model: a guess from function words, none under twenty characters or without evidence."""
    words = GUESS_WORDS
    d = read_table(spark, sf_dir, "documents")
    tokens = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    count = lambda ws: F.size(F.filter(F.col("w"), lambda x: x.isin(ws.split())))
    scores = F.array(*[F.struct(count(ws).alias("n"), F.lit(-i).alias("i"), F.lit(c).alias("c")) for i, (c, ws) in enumerate(words.items())])
    best = F.array_max(scores)
    return d.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("chars"), tokens.alias("w")).select("doc_id", F.when((F.col("chars") >= 20) & (best["n"] > 0), best["c"]).otherwise("none").alias("lang"))


_TIDY_LINE = STRIP.format("regexp_replace(x, '[\\s\\p{Z}]+', ' ', 'g')")
_TEXT = f"array_to_string(list_filter(list_transform(string_split(regexp_replace(coalesce(text,''), '\\r\\n?', chr(10), 'g'), chr(10)), lambda x: {_TIDY_LINE}), lambda y: y <> ''), chr(10))"
_GUESS = ", ".join(f"struct_pack(n := len(list_filter(w, lambda x: x IN {tuple(ws.split())!r})), i := {-i}, c := '{c}')" for i, (c, ws) in enumerate(GUESS_WORDS.items()))
_ESC = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_PAGE = f"""l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS l FROM documents WHERE text IS NOT NULL),
h AS (SELECT doc_id, '<html><head><!-- '||repeat('x', 400)||' --><title>'||{_ESC.format("coalesce(l[1], '')")}||'</title><meta property=''article:published_time'' content=''2026-01-02T03:04:05+02:00''></head><body><nav><a href=''/''>Home</a></nav><div class=''cookie''>We use cookies</div><article>'
||coalesce(array_to_string(list_transform(l, lambda x: '<p>'||{_ESC.format('x')}||'</p>'), chr(10)), '')||'</article><footer>Imprint</footer></body></html>' AS html FROM l)"""
QUERIES = {"n28_page_extract": n28_extract, "page_filters": page_filters, "s6_archive_scan": s6_archive, "s11_gkg_scan": s11_gkg, "s10_gkg_manifest": s10_manifests, "s8_archive_manifest": s8_archive_manifest, "v8_pipeline": v8_pipeline, "n15_detect_lang": n15_detect_lang}
ORACLES = {
    "n28_page_extract": f"SELECT doc_id, '2026-01-02 03:04:05' AS date, 'page.example' AS domain, CASE WHEN length(t) >= 120 THEN '' ELSE 'short_text' END AS reason, md5(CASE WHEN length(t) >= 120 THEN t ELSE '' END) AS text_md5 FROM (SELECT doc_id, coalesce({_TEXT}, '') AS t FROM documents WHERE text IS NOT NULL)",
    "page_filters": rf"WITH {_PAGE} SELECT doc_id, doc_id % 7 <> 0 AND doc_id % 5 <> 0 AND length(html) + 400 BETWEEN 500 AND 5000000 AS early, doc_id % 3 <> 0 AND NOT regexp_matches(lower(substr(html, 1, 3000)), '<title>\s*(?:login|sign in|search|tag:|author:)|captcha|access denied') AS late FROM h",
    "s6_archive_scan": f"SELECT doc_id, md5(t) AS text_md5 FROM (SELECT doc_id, {_TEXT} AS t FROM documents WHERE text IS NOT NULL) WHERE length(t) >= 120 AND NOT regexp_matches(lower(t), '^(?:login|sign in|search|tag:|author:)') AND NOT regexp_matches(lower(substr(t, 1, 3000)), 'captcha|access denied')",
    "n15_detect_lang": rf"SELECT doc_id, CASE WHEN chars >= 20 AND b.n > 0 THEN b.c ELSE 'none' END AS lang FROM (SELECT doc_id, chars, list_max([{_GUESS}]) AS b FROM (SELECT doc_id, length(coalesce(text,'')) AS chars, regexp_extract_all(lower(coalesce(text,'')), '[\p{{L}}\p{{N}}_]+') AS w FROM documents))",
    "s11_gkg_scan": r"SELECT source, coalesce(url,'') AS url, regexp_replace(lower(regexp_extract(coalesce(url,''), '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*).*$', 2)), '^www\.', '') AS domain, 'ECON TAX' AS themes, 1767323045 AS epoch FROM articles WHERE source IS NOT NULL AND lang = 'en'",
    "s10_gkg_manifest": "SELECT DISTINCT 'http://x.example/'||strftime(d, '%Y%m%d')||'000000.gkg.csv.zip' AS url FROM (SELECT DATE '2026-01-01' + CAST(doc_id % 20 AS INTEGER) AS d FROM documents) WHERE d BETWEEN DATE '2026-01-03' AND DATE '2026-01-07'",
    "s8_archive_manifest": "SELECT DISTINCT 'crawl-data/CC-NEWS-'||strftime(d, '%Y%m%d')||'101010-00001.warc.gz' AS path FROM (SELECT DATE '2026-01-01' + CAST(doc_id % 20 AS INTEGER) AS d FROM documents) WHERE d <= DATE '2026-01-09'",
}
