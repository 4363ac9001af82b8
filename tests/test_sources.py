import gzip
import json
import time

from pyspark.sql import functions as F

from presswerk.operators.store import write_hits
from presswerk.sources import html, readers
from presswerk.streaming import ingest


def test_extract_and_filters(spark):
    body = "".join(f"<p>Sentence number {i} of the story about the harbour.</p>" for i in range(6))
    page = f"<html><head><title>Plain</title><meta property='og:title' content='Better'></head><body><nav>Home</nav><div class='share'>Share</div><article>{body}<p>end &amp; more<br>line</article><footer>F</footer></body>"
    got = html.extract("https://www.x.example/a", page, "2026-01-01T00:00:00Z")
    assert got["title"] == "Better" and got["domain"] == "x.example" and got["date"] == "2026-01-01 00:00:00" and got["reason"] == ""
    assert got["text"].startswith("Sentence number 0") and got["text"].endswith("end & more\nline") and "Home" not in got["text"] and "Share" not in got["text"]
    assert html.extract("http://x.example", "<body>" + "x" * 119)["reason"] == "short_text" and html.extract("http://x.example", "<body>" + "x" * 120)["reason"] == ""
    df = spark.createDataFrame([("http://a/x", n, "text/html") for n in (499, 500, 5_000_000, 5_000_001)] + [("http://a/tag/x", 600, "text/html"), ("http://a/x", 600, "image/png")], "u string, n int, c string")
    assert [r[0] for r in df.select(html.before_decode(F.col("u"), F.col("n"), F.col("c"))).collect()] == [False, True, True, False, False, False]
    assert html.decode_body(gzip.compress("é\x00x".encode()), "gzip", "text/html; charset=utf-8") == "éx"
    assert html.decode_body("é".encode("latin-1"), "gzip", "text/html") == "é"


def test_warc_source(spark, tmp_path):
    page = "<html><head><title>T</title></head><body><article>" + "<p>The harbour was sold on Monday.</p>" * 20 + "</article></body></html>"
    for k in range(2):
        (tmp_path / f"CC-NEWS-2026010100000{k}-00001.warc.gz").write_bytes(readers.warc_bytes([(f"http://x.example/{k}/{i}", "2026-01-01T00:00:00Z", page) for i in (0, 1, 1)]))
    raw = readers.read_warc(spark, str(tmp_path))
    assert raw.count() == 6 and raw.select("file").distinct().count() == 2
    articles, outcomes = readers.archive_articles(raw)
    assert sorted(r.url for r in articles.collect()) == [f"http://x.example/{k}/{i}" for k in range(2) for i in range(2)]
    assert sorted((r.outcome, r.n) for r in outcomes.collect()) == [("article", 2), ("article", 2), ("repeated", 1), ("repeated", 1)]


def test_article_files(spark, tmp_path):
    rows = [{"headline": "H", "title": "T", "description": "D", "link": "http://u.example/1", "date": "20260102030405"}, {"title": "T2", "content": "C2", "date": 20260102030405.0}, {"title": None, "text": "x"}, {"headline": "H", "text": "again", "link": "http://u.example/1"}]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "a.jsonl").write_text("\n\n".join(json.dumps(r) for r in rows))
    for name in ("a.json", "a.jsonl"):
        out = readers.normalise(readers.read_articles(spark, str(tmp_path / name))).orderBy("title").collect()
        assert [r.title for r in out] == ["H", "T2"] and out[0].url == "http://u.example/1"
    readers.write_articles(spark.createDataFrame([("a", "t", ["x", "y"]), ("b", None, [])], "url string, text string, themes array<string>"), str(tmp_path / "csv"), "csv")
    assert readers.read_articles(spark, str(tmp_path / "csv"), "csv").collect()[0].themes == "x;y"


def test_expansions_and_eval(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"interest": "Finance", "items": [" Bank ", "bank", "Bank", ""]}))
    (tmp_path / "b.json").write_text(json.dumps({"interest": "Finance", "items": ["tax"]}))
    (tmp_path / "c.json").write_text("{not json")
    assert [(r.interest, r["items"]) for r in readers.read_expansions(spark, str(tmp_path)).collect()] == [("Finance", ["tax"])]
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "eval.json").write_text(json.dumps({"articles": [{"article_id": "a", "title": "t", "url": "u", "expected_interests": ["x"]}, {"title": "t", "content": "c", "url": "http://u", "expected_interests": ["x", "y"], "rank_target_max": 3}]}))
    got = readers.read_eval(spark, str(tmp_path / "e" / "eval.json")).orderBy("rank_target_max").collect()
    assert [r.rank_target_max for r in got] == [3, 20] and got[1].article_id == "a"


def test_gkg(spark):
    lines = spark.createDataFrame([("\t".join(["1", "20260102030405", "1", "src", "http://www.a.example/x", "", "", "B_1;A_2;B_3", ""]),), ("a\tb",)], "value string")
    assert [(r.source, r.domain, r.themes) for r in readers.gkg_rows(lines).collect()] == [("src", "a.example", ["A", "B"])]


def test_run_partitions_overwrite(spark, tmp_path):
    path = str(tmp_path / "hits")
    write_hits(spark.createDataFrame([(1, "a"), (2, "b")], "run_id long, id string"), path)
    write_hits(spark.createDataFrame([(2, "c")], "run_id long, id string"), path)
    assert sorted((r.run_id, r.id) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "c")]


def test_stream_equals_batch(spark, tmp_path):
    folder, table = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()
    schema = "title string, text string, link string, date string"
    for k in range(2):
        (folder / f"{k}.json").write_text("\n".join(json.dumps({"title": f"T{i}", "text": f"v{k}", "link": f"http://x/{i}", "date": "20260102030405"}) for i in range(k, k + 3)))
        q = ingest.ingest_stream(spark, str(folder), schema, table, str(tmp_path / "cp"))
        q.awaitTermination(120)
        time.sleep(0.1)
    got = {r.url: r.content for r in ingest.current(spark, table).collect()}
    assert got == {"http://x/0": "v0", "http://x/1": "v1", "http://x/2": "v1", "http://x/3": "v1"}
