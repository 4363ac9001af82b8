import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from presswerk import cli
from presswerk.functions.register import register
from presswerk.operators import dedup, indexing, rerank, retrieval, specs, store, writing
from presswerk.plans import registry
from presswerk.sources import files, readers, sinks

WORDS = "council bridge harbour airline museum budget railway festival school winter energy court".split()


def articles(n=60):
    rows = []
    for i in range(n):
        a, b, c = WORDS[i % 12], WORDS[(i * 5 + 3) % 12], WORDS[(i * 7 + 1) % 12]
        body = f"The {a} of the town met the {b} on Monday and spoke of the {c} number {i}. " * 9
        rows.append({"title": f"{a.title()} and {b} story {i}", "text": body, "url": f"https://www.x.example/{i}", "lang": "en", "date": "2026-01-02T03:04:05Z"})
    return rows


def test_command_line_from_files_to_feed(spark, tmp_path):
    source, root = tmp_path / "in.jsonl", str(tmp_path / "work")
    source.write_text("\n".join(json.dumps(x) for x in articles()))
    run = lambda *argv: cli.main(["--workspace", root, *argv], spark)
    assert run("normalise", "--input", str(source), "--export-json", str(tmp_path / "all.json")) == {"articles": 60}
    assert len(json.loads((tmp_path / "all.json").read_text())) == 60
    assert run("normalise", "--input", str(source))["articles"] == 60
    assert len(run("expand", "--topic", "harbour bridge", "winter energy", "--count", "1")["files"]) == 2
    found = run("retrieve", "--tags", "court", "--topk", "8", "--out", str(tmp_path / "out.json"))
    assert found["run_id"] == 1 and found["hits"] == 16
    out = json.loads((tmp_path / "out.json").read_text())
    assert {b["interest"] for b in out["results"]} == {"harbour bridge", "winter energy"} and out["run_id"] == 1 and len(out["results"][0]["articles"]) == 8
    assert run("retrieve", "--resume-index", "--aggregate", "--topk", "3")["hits"] == 3
    kept = run("dedup", "--run-id", "1")
    assert kept["kept"] + sum(kept["removed"].values()) == 16
    assert run("rerank", "--topn", "4", "--pairwise-threshold", "1.1")["hits"] == min(8, kept["kept"])
    written = run("write", "--outdir", str(tmp_path / "stories"))
    assert written["written"] == {"OK": kept["kept"]} and (tmp_path / "stories" / "index.json").exists()
    stories = run("feed")["stories"]
    assert len(stories) == kept["kept"] and stories[0]["rank"] == 1
    w = cli.Workspace(spark, root)
    broken = w.summaries.read().where("rank = 1").withColumns({"summary": F.lit(""), "status": F.lit("FAIL")})
    w.summaries.write(broken)
    assert run("write", "--repair", str(written["run_id"])) == {"run_id": 1, "repaired": 2}
    assert all(s["summary"] for s in run("feed")["stories"])
    w.summaries.write(w.summaries.read().where("rank = 2").withColumn("status", F.lit("FAIL")))
    assert run("write", "--resume", str(written["run_id"])) == {"run_id": 1, "written": 2} and run("write", "--resume", "1")["written"] == 0
    labelled = {"articles": [{"title": "t", "content": "c", "url": "https://www.x.example/2", "expected_interests": ["Harbour"]}, {"articles": [{"url": "https://nowhere.example", "title": "n", "content": "m", "expected_interests": "winter energy"}]}], "interest_aliases": {"harbour bridge": ["Harbour"]}}
    (tmp_path / "eval.json").write_text(json.dumps(labelled))
    report = run("evaluate", "--run-id", "1", "--eval-file", str(tmp_path / "eval.json"), "--upsert-articles", "--out", str(tmp_path / "report.json"))
    assert report["items"] == 2 and len(json.loads((tmp_path / "report.json").read_text())["details"]) == 2
    ids = [r.id for r in w.articles.read().orderBy("url").limit(2).collect()]
    assert run("rerank", "--id1", ids[0], "--id2", ids[1])["verdict"] in ("same story", "different stories")
    assert run("orchestrate", "harbour bridge") == {"topic": "harbour bridge", "exists": True}
    assert run("orchestrate", "museum festival")["write"]["written"] != {}
    with pytest.raises(SystemExit):
        run("dedup", "--stage", "x")


def test_keyed_table_takes_the_last_row(spark, tmp_path):
    table = store.KeyedTable(spark, str(tmp_path / "t"), ["id"])
    assert not table.exists() and table.batches() == []
    assert table.write(spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "id string, v int")) == 2
    table.write(spark.createDataFrame([("b", 2, "x")], "id string, v int, w string"))
    table.write(spark.createDataFrame([("b", 3, "x")], "id string, v int, w string"), 1)
    want = [("a", 1, None), ("b", 3, "x")]
    assert sorted(map(tuple, table.read().select("id", "v", "w").collect())) == want
    table.compact()
    assert table.batches() == [1] and sorted(map(tuple, table.read().select("id", "v", "w").collect())) == want


def test_ledger_numbers_runs_once(spark, tmp_path):
    ledger = store.RunLedger(spark, str(tmp_path))
    assert [ledger.create("dedup", {"k": 1}) for _ in range(3)] == [1, 2, 3] and ledger.create("rerank", None, 2) == 1
    (tmp_path / "dedup_runs" / "_taken-4").write_text("")  # another writer took it
    assert ledger.create("dedup") == 5
    rows = spark.createDataFrame([("i", 1)], "interest string, rank int")
    ledger.write("dedup", 1, rows)
    ledger.write("dedup", 2, rows)
    ledger.write("dedup", 2, rows.withColumn("rank", F.lit(9)))
    assert sorted((r.run_id, r["rank"]) for r in ledger.rows("dedup").collect()) == [(1, 1), (2, 9)]
    assert ledger.representative("dedup") == 2 and json.loads(ledger.runs("dedup").where("id = 1").first().parameters) == {"k": 1}
    with pytest.raises(ValueError):
        ledger.create("other")


def test_runs_are_added_together(spark, tmp_path):
    ledger = store.RunLedger(spark, str(tmp_path))
    rows = spark.createDataFrame([(8, "i", 1), (7, "i", 1), (8, "j", 2), (None, "lost", 1)], "source long, interest string, rank int")
    assert ledger.create("rerank") == 1 and ledger.add_all("rerank", rows, "source", {"k": 1}) == [2, 3]
    assert ledger.create("rerank") == 4 and ledger.add_all("rerank", rows.where("source is null"), "source") == []
    (tmp_path / "rerank_runs" / "_taken-5-9").write_text("")  # another writer took these
    assert ledger.add_all("rerank", rows.where("source = 7"), "source") == [10]
    assert sorted((r.id, r.source_run_id) for r in ledger.runs("rerank").where("source_run_id > 0").collect()) == [(2, 7), (3, 8), (10, 7)]
    ledger.write("rerank", 4, rows.where("source = 7").drop("source"))
    ledger.write("rerank", 3, rows.where("source = 7").select("interest", F.lit(9).alias("rank"), F.lit("x").alias("note")))  # only this run is replaced
    got = sorted((r.run_id, r.interest, r["rank"], r.note) for r in ledger.rows("rerank").collect())
    assert got == [(2, "i", 1, None), (3, "i", 9, "x"), (4, "i", 1, None), (10, "i", 1, None)]
    assert [r["rank"] for r in ledger.rows("rerank", 3).collect()] == [9] and ledger.representative("rerank") == 10


def test_overlapping_markers_are_given_up(spark, tmp_path, monkeypatch):
    ledger = store.RunLedger(spark, str(tmp_path))
    folder, names, looks = tmp_path / "dedup_runs", store._names, []

    def late(spark, path, prefix):
        if prefix == "_taken-":
            looks.append(prefix)
            if len(looks) == 2:  # another writer's marker, made after the first look
                (folder / "_taken-2-3").write_text("")
        return names(spark, path, prefix)

    monkeypatch.setattr(store, "_names", late)
    rows = spark.createDataFrame([(7, "i"), (8, "i")], "source long, interest string")
    assert ledger.add_all("dedup", rows, "source") == [4, 5] and (folder / "_taken-1-2").exists()


def test_run_rows_need_no_more_jobs_for_more_runs(spark, tmp_path):
    jobs = {}
    for n in (0, 2, 12):
        hits = [(10 * r, "i", k, f"a{r}") for r in range(n) for k in (1, 2)] + [(None, "i", 1, "lost")]
        spark.createDataFrame(hits, "retrieval_run_id long, interest string, rank int, article_id string").coalesce(1).write.parquet(f"{tmp_path}/{n}/retrieval_hits.parquet")
        spark.sparkContext.setJobGroup(f"runs-{n}", "")
        got = registry.QUERIES["k2_run_rows"](spark, f"{tmp_path}/{n}").collect()
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"runs-{n}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert sorted(map(tuple, got)) == [(r + 1, 10 * r, "i", k, f"a{r}") for r in range(n) for k in (1, 2)]
    assert 0 < jobs[12] <= jobs[2] + 2, jobs


def test_index_resumes(spark, tmp_path):
    df = spark.createDataFrame([("a", "bridge"), ("b", "harbour town"), (None, "x"), ("c", None)], "id string, text string")
    index = indexing.VectorIndex(spark, str(tmp_path / "v"))
    assert index.index(df.where("id = 'a'"), indexing.HashedEmbedder(32)) == 1
    assert index.index(df, indexing.HashedEmbedder(32), resume=True) == 2 and index.ids().count() == 3
    v = {r.id: np.array(r.vec) for r in index.table.read().collect()}
    assert abs(np.linalg.norm(v["a"]) - 1) < 1e-6 and not v["c"].any()
    got = index.search(spark.createDataFrame([("q", v["b"].tolist())], "q string, vec array<double>"), 1).first()
    assert got.id == "b" and abs(got.score - 1) < 1e-6
    assert index.fetch(spark.createDataFrame([("a",), ("z",)], "id string")).count() == 1
    with pytest.raises(ValueError):
        index.index(df, indexing.HashedEmbedder(32), reindex=True, resume=True)


def test_dense_topk_over_batches_and_ties(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.integers(0, 3, 4).astype(float).tolist()) for i in range(3000)] + [(9999, None)]
    v = spark.createDataFrame(rows, "id long, vec array<double>").repartition(5)
    q = spark.createDataFrame([("x", [1.0, 0.0, 1.0, 0.0]), ("y", [0.0, 1.0, 2.0, 1.0])], "q string, vec array<double>")
    got = {}
    for r in retrieval.dense_topk(v, q, 40).orderBy("q", "rank").collect():
        got.setdefault(r.q, []).append(r.id)
    for name, vec in (("x", [1.0, 0.0, 1.0, 0.0]), ("y", [0.0, 1.0, 2.0, 1.0])):
        u = np.array(vec) / np.linalg.norm(vec)
        score = {i: round(float(np.dot(np.array(x) / (np.linalg.norm(x) + 1e-12), u)), 8) for i, x in rows if x is not None}
        assert got[name] == sorted(score, key=lambda i: (-score[i], i))[:40]
    assert retrieval.dense_topk(v, q.limit(0), 5).count() == 0


def test_bm25_index_agrees_and_is_cached(spark, tmp_path):
    docs = spark.createDataFrame([(i, x["text"] + " " + x["title"]) for i, x in enumerate(articles())], "id long, text string")
    queries = spark.createDataFrame([("q", "harbour harbour bridge"), ("r", "the winter")], "q string, text string")
    index = retrieval.Bm25Index(spark, str(tmp_path / "bm25")).load_or_build(docs)
    rows = lambda df: {(r.q, r.id): round(r.score, 9) for r in df.collect()}
    direct = rows(retrieval.bm25_scores(docs, queries))
    assert direct and rows(index.scores(queries)) == direct
    assert retrieval.bm25_scores(docs.limit(0), queries).count() == 0 and retrieval.bm25_scores(docs, queries.limit(0)).count() == 0
    now = index.signature(docs.repartition(7))
    assert index.is_current(now) and not index.is_current(index.signature(docs.where("id > 0")))
    assert not retrieval.Bm25Index(spark, str(tmp_path / "none")).is_current(now)


def test_parameters_of_a_run():
    config, most = specs.resolve_parameters({"dense_per_center": 50, "bm25_k": 30, "bm25_title_k": 7, "topk": 5, "lang": None, "max_expansions": 2})
    assert (config.dense_per_anchor, config.dense_per_expansion, config.title_k, config.body_k, config.top_k, most) == (50, 20, 7, 30, 5, 2)
    assert specs.resolve_parameters({})[0] == retrieval.RetrievalConfig() and specs.resolve_parameters({"dense_only": True})[0].body_k == 0
    assert specs.profile_config(top_k=900).candidate_cap == 900


def test_specs_of_interests(spark):
    interests = spark.createDataFrame([("Night trains",), ("Night trains",), (" ",)], "interest string")
    expansions = spark.createDataFrame([("NIGHT  trains", ["night  trains", "trains", "Trains ", "", "sleeper cars", "metro"]), ("Other", ["x"])], "interest string, items array<string>")
    got = specs.interest_specs(interests, expansions, indexing.HashedEmbedder(64), 2).orderBy("q_pos").collect()
    assert [(r.text, r.kind) for r in got] == [("Night trains", "anchor"), ("trains", "expansion"), ("sleeper cars", "expansion")]
    assert got[0].weight == 1.0 and all(0.15 <= r.weight <= 0.45 for r in got[1:]) and len(got[0].vec) == 64


def test_profile_retrieval(spark):
    docs = spark.createDataFrame([(str(i), x["title"], x["text"], "en") for i, x in enumerate(articles(24))], "id string, title string, body string, lang string")
    embedder = indexing.HashedEmbedder(64)
    vectors = indexing.embed(docs.select("id", F.concat_ws(" ", "title", "body").alias("text")), embedder)
    out = specs.retrieve_profile(docs, vectors, spark.createDataFrame([("harbour bridge",), ("winter",)], "interest string"), embedder, 5).orderBy("rank").collect()
    assert [r["rank"] for r in out] == [1, 2, 3, 4, 5] and {r.interest for r in out} == {"harbour bridge; winter"}


def test_generated_expansions(spark):
    class Some:
        def __init__(self):
            self.asked = []

        def chat(self, messages):
            self.asked.append(messages[-1]["content"])
            return {1: "1. solar power\n2) x y z w", 2: "grid, heat pump; solar power"}.get(len(self.asked), "keyword")

    g = Some()
    assert writing.generate_items(g, "energy", 3) == (["grid", "heat pump", "solar power"], "grid, heat pump; solar power")
    assert "solar power" in g.asked[1]
    assert writing.parse_items("<think>a</think>Été chaud\nété CHAUD\nx", 5) == ["Ete chaud"] and writing.valid_item("one two three") and not writing.valid_item("one two three four")

    class Fails:
        def chat(self, messages):
            raise OSError("no model")

    out = writing.expand_interests(spark.createDataFrame([("a",), ("a",), (" ",)], "interest string"), Fails()).collect()
    assert [(r.interest, r.status, r.n_items) for r in out] == [("a", "error", 0)] and "no model" in out[0].error


def test_files_formats_and_cache(spark, tmp_path):
    (tmp_path / "in").mkdir()
    one = {"title": "t", "text": "c", "url": "u1"}
    (tmp_path / "in" / "a.json").write_text(json.dumps([one, {**one, "url": "u2"}]))
    (tmp_path / "in" / "b.jsonl").write_text(json.dumps({**one, "url": "u3"}) + "\n\n")
    (tmp_path / "in" / "c.csv").write_text('title,text,url\nt,"two\nlines",u4\n')
    (tmp_path / "in" / "d.json").write_text(json.dumps({**one, "url": "u5"}) + "\n" + json.dumps({**one, "url": "u6"}) + "\n")
    (tmp_path / "in" / "x.txt").write_text("no")
    folder = str(tmp_path / "in")
    assert sorted(r.url for r in readers.read_articles(spark, [folder, folder]).collect()) == ["u1", "u2", "u3", "u4", "u5", "u6"]
    assert readers.read_articles(spark, folder, limit=2).count() == 2
    with pytest.raises(ValueError):
        readers.read_articles(spark, str(tmp_path / "in" / "x.txt"))
    with pytest.raises(FileNotFoundError):
        readers.read_articles(spark, str(tmp_path / "none"))
    cache = str(tmp_path / "cache")
    assert readers.read_cached(spark, folder, cache).count() == 6
    before = len(list((tmp_path / "cache").iterdir()))
    readers.read_cached(spark, folder, cache)
    assert len(list((tmp_path / "cache").iterdir())) == before
    (tmp_path / "in" / "b.jsonl").write_text(json.dumps({**one, "url": "u7"}) + "\n" + json.dumps({**one, "url": "u8"}))
    assert readers.read_cached(spark, folder, cache).count() == 7


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("x/a.warc.gz", "u1", "t"), ("x/a.warc.gz", "u1", "t"), ("x/b.warc", "u1", "t")], "file string, url string, text string")
    sinks.write_by_file(df, str(tmp_path / "by"))
    assert sorted(p.name for p in (tmp_path / "by").glob("input=*")) == ["input=a", "input=b"] and spark.read.json(str(tmp_path / "by")).count() == 2
    sinks.export_csv(spark.createDataFrame([("a", ["x", "y"]), (" ", ["z"])], "text string, themes array<string>"), str(tmp_path / "csv"))
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()] == [("a", "x;y")]
    blocks = spark.createDataFrame([("Été 1", 1), ("b", 2)], "interest string, n int")
    assert len(sinks.write_interest_files(blocks, str(tmp_path / "i"))) == 2 and sinks.write_interest_files(blocks, str(tmp_path / "i")) == []
    assert [x["file"] for x in json.loads((tmp_path / "i" / "index.json").read_text())] == ["b.json", "ete_1.json"]
    sinks.log_errors(df, str(tmp_path / "log"), "bad")
    sinks.log_errors(df, str(tmp_path / "log"), "bad")
    assert spark.read.json(str(tmp_path / "log")).where("note = 'bad'").count() == 6
    sinks.write_json_array(df.limit(0), str(tmp_path / "none.json"))
    assert json.loads((tmp_path / "none.json").read_text()) == []

    class Stream:
        def __init__(self):
            self.parts = [b"ab", b"c"]

        def read(self, n):
            return self.parts.pop(0) if self.parts else b""

        def __enter__(self):
            return self

        def __exit__(self, *a):
            pass

    assert files.download("u", str(tmp_path / "got"), lambda u: Stream()) and (tmp_path / "got").read_bytes() == b"abc"
    assert not files.download("u", str(tmp_path / "got"), lambda u: 1 / 0)


def test_archives_by_file_and_skip(spark, tmp_path):
    page = "<html><!--" + "x" * 500 + "--><body><article>" + "<p>The council met on Monday and heard the plan for the bridge.</p>" * 5 + "</article></body></html>"
    (tmp_path / "in").mkdir()
    for name in ("a", "b"):
        (tmp_path / "in" / f"{name}.warc.gz").write_bytes(readers.warc_bytes([(f"https://x.example/{name}", "2026-01-01T00:00:00Z", page)] * 2))
    run = lambda *argv: cli.main(["--workspace", str(tmp_path / "w"), "parse-archives", "--input", f"file://{tmp_path}/in", "--out", str(tmp_path / "out"), *argv], spark)
    assert run() == {"archives": 2} and spark.read.json(str(tmp_path / "out")).count() == 2
    assert run("--skip-existing") == {"archives": 0}


def test_neighbours(spark):
    rows = [("i", "a", "en", "2026-01-01", [1.0, 0.0]), ("i", "b", "en", "2026-01-03", [1.0, 0.1]), ("i", "c", "fr", "2026-01-01", [1.0, 0.0]), ("i", "d", "en", "2026-01-09", [1.0, 0.0]), ("i", "e", None, None, [0.0, 1.0]), ("j", "a", "en", "2026-01-01", [1.0, 0.0])]
    h = spark.createDataFrame(rows, "interest string, id string, lang string, date string, vec array<double>").withColumn("date", F.to_timestamp("date"))
    got = {(r.interest, r.a, r.b) for r in dedup.neighbour_pairs(h).collect()}
    assert {x for x in got if x[1] != "e"} == {("i", "a", "b"), ("i", "b", "a")} and {x[2] for x in got if x[1] == "e"} == {"a", "b", "c", "d"}
    assert {(r.a, r.b) for r in dedup.neighbours_among(dedup.neighbour_pairs(h, k=1), h.where("id = 'a'").select("interest", "id")).collect()} == {("b", "a")}


def test_chat_endpoint_and_prompts():
    import http.server
    import threading

    seen = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            seen.append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
            self.send_response(500 if len(seen) == 1 else 200)
            self.end_headers()
            self.wfile.write(json.dumps({"message": {"content": "hello"}}).encode())

        def log_message(self, *a):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        g = writing.HttpGenerator(f"http://127.0.0.1:{server.server_port}/chat", "m", timeout=5, temperature=0.0)
        assert g.chat([{"role": "user", "content": "x"}]) == "hello" and len(seen) == 2
        assert seen[1]["options"] == {"temperature": 0.0, "num_predict": 900, "num_ctx": 4096} and seen[1]["model"] == "m"
    finally:
        server.shutdown()
    asked = []
    scorer = rerank.PromptScorer(lambda prompts: asked.append(len(prompts)) or [0.5] * len(prompts), "Is it so?", 2)
    assert scorer.score([("q", "d")] * 3) == [0.5] * 3 and asked == [2, 1]


def test_functions_for_sql(spark):
    register(spark)
    row = spark.sql("SELECT indel_ratio('abcd', 'abxd') AS r, text_key('É t-1') AS k, html_extract(concat('<title>T</title><body>', repeat('word ', 40)), 'https://www.a.example/x') AS h").first()
    assert row.r == 0.75 and row.k == "et1" and row.h.domain == "a.example" and row.h.title == "T" and row.h.reason == ""
    got = spark.sql("SELECT * FROM segments('The city announced in 2024 that its harbour was sold. Menu', 'Harbour')").orderBy("position").collect()
    assert [r.segment for r in got] == ["The city announced in 2024 that its harbour was sold.", "Menu"] and got[0].score > 0 > got[1].score


def test_date_window_of_dense_search(spark):
    v = spark.createDataFrame([("a", "2026-01-10"), ("b", "2025-12-01"), ("c", None), ("d", "2026-01-31 12:00:00")], "id string, date string").withColumn("date", F.to_timestamp("date"))
    assert sorted(r.id for r in retrieval.recent(v, 30, "2026-01-31").collect()) == ["a"] and retrieval.recent(v, 0).count() == 4
