"""Command line: every stage over a workspace, a folder of tables that any of Spark's file systems can hold.

    articles, vectors        keyed tables        ledger      runs of the stages and their rows
    expansions               JSON files          feed        the latest written stories
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswerk.functions.text import stable_excerpt, strip
from presswerk.operators import dedup, evaluation, indexing, rerank, retrieval, specs, store, writing
from presswerk.session import build_session
from presswerk.sources import files, readers, sinks


class Workspace:
    """The tables under one root, with the back ends the stages use."""

    def __init__(self, spark: SparkSession, root: str, embedder=None, scorer=None, generator=None):
        self.spark, self.root = spark, root.rstrip("/")
        self.articles = store.KeyedTable(spark, f"{self.root}/articles", ["id"])
        self.summaries = store.KeyedTable(spark, f"{self.root}/summaries", ["run_id", "interest", "rank"])
        self.vectors = indexing.VectorIndex(spark, f"{self.root}/vectors")
        self.ledger = store.RunLedger(spark, f"{self.root}/ledger")
        self.embedder = embedder or indexing.HashedEmbedder()
        self.scorer, self.generator = scorer or rerank.OverlapScorer(), generator or writing.LeadGenerator()

    def docs(self) -> DataFrame:
        a = self.articles.read()
        return a.select("id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("content", F.lit("")).alias("body"), F.coalesce("lang", F.lit("")).alias("lang"), "url", "fingerprint", F.coalesce("source", F.lit("")).alias("source"))

    def expansions(self, folder: str | None = None) -> DataFrame:
        folder = folder or f"{self.root}/expansions"
        if not files.listing(folder, (".json",)):
            return self.spark.createDataFrame([], "interest string, items array<string>")
        return readers.read_expansions(self.spark, folder)

    def interests(self, given: list[str] | None, expansions: DataFrame) -> DataFrame:
        if given:
            return self.spark.createDataFrame([(x,) for x in given], "interest string")
        return expansions.select("interest")


def _flag(value: str) -> bool:
    return value.strip().lower() in ("1", "true", "yes", "on")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="presswerk", description="News retrieval and curation on Spark")
    p.add_argument("--workspace", default=os.environ.get("PRESSWERK_WORKSPACE", "workspace"))
    p.add_argument("--master", default=os.environ.get("PRESSWERK_MASTER"), help="Spark master; without it the session's own settings count")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, **flags) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        for flag, options in flags.items():
            c.add_argument("--" + flag.replace("_", "-"), **options)
        return c

    many, number, real = {"nargs": "*"}, {"type": int}, {"type": float}
    command("normalise", input={"nargs": "+", "required": True}, csv={}, jsonl={}, export_json={}, no_table={"action": "store_true"})
    command(
        "retrieve", interest=many, tags=many, expansions_dir={}, reindex={"action": "store_true"}, resume_index={"action": "store_true"}, lang=many, min_sim=real, min_bm25=real, dense_only={"action": "store_true"},
        aggregate={"action": "store_true"}, topk=number, dense_per_center=number, bm25_k=number, max_expansions={"type": int, "default": specs.MAX_EXPANSIONS}, dense_per_anchor=number, dense_per_expansion=number, bm25_title_k=number,
        bm25_body_k=number, rrf_k=number, candidate_cap=number, days={"type": int, "default": 0}, as_of={}, out={},
    )
    command("dedup", interest=many, run_id=number, stage2_max_candidates={"type": int, "default": 120})
    command(
        "rerank", table={"choices": ["retrieval", "dedup"], "default": "dedup"}, run_id=number, topn={"type": int, "default": 20}, diversity_scan_k={"type": int, "default": 80}, pairwise_threshold={"type": float, "default": 0.62}, smax_threshold=real,
        smin_threshold=real, id1={}, id2={}, input={}, out={},
    )
    command("write", rerank_run_id=number, repair=number, resume=number, top_n={"type": int, "default": 10}, max_chars={"type": int, "default": 9000}, offset={"type": int, "default": 0}, interest_batch_size={"type": int, "default": 10}, outdir={})
    command("evaluate", run_id=number, table={"choices": ["retrieval", "dedup", "rerank"], "default": "retrieval"}, eval_file={"required": True}, out={}, upsert_articles={"action": "store_true"})
    command("expand", topic={"nargs": "+", "required": True}, count={"type": int, "default": 10}, min_words={"type": int, "default": 1}, max_words={"type": int, "default": 2}, retries={"type": int, "default": 3}, out_dir={})
    command("parse-archives", input={"required": True}, out={"required": True}, skip_existing={"action": "store_true"})
    command("archive-manifest", input={"required": True}, day={"required": True}, out={})
    command("export-gkg", input={"required": True}, out={"required": True})
    command("feed", interest={})
    command("orchestrate").add_argument("topic", nargs="?", default="video games")
    return p


def normalise(w: Workspace, args) -> dict:
    rows = readers.normalise(readers.read_articles(w.spark, args.input))
    out = {"articles": rows.count() if args.no_table else w.articles.write(rows)}
    if args.csv:
        sinks.export_csv(rows.withColumnRenamed("content", "text"), args.csv)
    if args.jsonl:
        readers.write_articles(rows, args.jsonl)
    if args.export_json:
        sinks.write_json_array(rows, args.export_json)
    return out


def retrieve(w: Workspace, args) -> dict:
    config, most = specs.resolve_parameters(vars(args))
    expansions = w.expansions(args.expansions_dir)
    interests = w.interests(args.interest, expansions)
    docs = w.docs()
    if args.reindex or args.resume_index or not w.vectors.table.exists():
        text = docs.select("id", F.concat_ws("\n", "title", F.substring("body", 1, 1200)).alias("text"))
        w.vectors.index(text, w.embedder, reindex=args.reindex, resume=args.resume_index and not args.reindex)
    wanted = specs.interest_specs(interests, expansions, w.embedder, most)
    if args.tags:
        wanted = retrieval.merge_specs(wanted.unionByName(specs.tag_specs(args.tags, interests, w.embedder)))
    if args.aggregate:
        wanted = specs.aggregate_specs(wanted)
    vectors = w.vectors.table.read()
    if config.days > 0:
        dates = w.articles.read().select("id", F.to_timestamp(F.col("published_date")).alias("date"))
        vectors = vectors.join(dates, "id", "left")
    hits = retrieval.retrieve(docs, vectors, wanted, config, args.lang or None, args.as_of)
    run = w.ledger.create("retrieval", vars(args))
    w.ledger.write("retrieval", run, hits)
    if args.out:
        sinks.write_results(w.ledger.rows("retrieval", run).drop("run_id"), args.out, {"run_id": run})
    return {"run_id": run, "hits": w.ledger.rows("retrieval", run).count()}


def _full(w: Workspace, kind: str, run: int | None, interests: list[str] | None = None) -> tuple[int, DataFrame]:
    run = run or w.ledger.representative(kind)
    if run is None:
        raise SystemExit(f"no {kind} run in this workspace")
    rows = w.ledger.rows(kind, run)
    if interests:
        rows = rows.where(F.lower("interest").isin([x.lower() for x in interests]))
    return run, rows.drop("run_id").join(w.docs(), "id")


def dedup_run(w: Workspace, args) -> dict:
    source, hits = _full(w, "retrieval", args.run_id, args.interest)
    prepared = dedup.prepare(hits.select("interest", "rank", "score", "id", "url", "fingerprint", "title", "body", F.col("source").alias("domain")))
    run = w.ledger.create("dedup", vars(args), source)
    w.ledger.write("dedup", run, dedup.dedup_hits(prepared, args.stage2_max_candidates))
    reasons = w.ledger.rows("dedup", run).groupBy("reason").count().collect()  # one row for each reason
    return {"run_id": run, "kept": sum(r[1] for r in reasons if not r[0]), "removed": {r[0]: r[1] for r in reasons if r[0]}}


def rerank_run(w: Workspace, args) -> dict:
    limits = {"mean": args.pairwise_threshold, "high": args.smax_threshold, "low": args.smin_threshold}
    if args.input:
        rows = readers.read_articles(w.spark, args.input)
        best = rerank.rerank_rows(rows.select("interest", "rank", F.col("id").cast("string").alias("id"), "title", "text"), w.scorer, args.topn)
        sinks.write_results(best, args.out or f"{w.root}/reranked.json")
        return {"rows": best.count()}
    if args.id1 and args.id2:
        return rerank.judge_pair(w.docs().withColumnRenamed("body", "text"), args.id1, args.id2, w.scorer, **limits)
    source, hits = _full(w, args.table, args.run_id)
    hits = hits.where("rank > 0").select("interest", F.col("rank").alias("dense_rank"), "id", "title", F.col("body").alias("text"))
    scored = rerank.score_hits(hits.withColumn("text", F.concat_ws("\n", "title", "text")), w.scorer)
    run = w.ledger.create("rerank", vars(args), source)
    w.ledger.write("rerank", run, rerank.collapse(scored, w.scorer, args.topn, args.diversity_scan_k, **limits))
    return {"run_id": run, "hits": w.ledger.rows("rerank", run).count()}


def write_run(w: Workspace, args) -> dict:
    if args.repair is not None:
        return repair(w, args.repair)
    source, hits = _full(w, "rerank", args.rerank_run_id)
    names = [r[0] for r in hits.select("interest").distinct().orderBy("interest").offset(args.offset).limit(args.interest_batch_size).collect()]
    hits = hits.where(F.col("interest").isin(names) & (F.col("rank") <= args.top_n))
    text = stable_excerpt(F.col("body"), args.max_chars)
    if args.resume is not None:
        # A run that broke off: what it has written already stays as it is.
        done = w.summaries.read().where((F.col("run_id") == args.resume) & (F.col("status") != "FAIL"))
        rest = writing.pending(hits, done)
        rows = writing.write_hits(rest.select("interest", "rank", "id", "title", "lang", text.alias("text")), w.generator)
        return {"run_id": args.resume, "written": w.summaries.write(rows.withColumn("run_id", F.lit(args.resume).cast("long")))}
    run = w.ledger.create("writing", vars(args), source)
    rows = writing.write_hits(hits.select("interest", "rank", "id", "title", "lang", text.alias("text")), w.generator)
    w.ledger.write("writing", run, rows)
    written = w.ledger.rows("writing", run)
    w.summaries.write(written)
    if args.outdir:
        sinks.write_interest_files(sinks.result_blocks(written.drop("run_id")), args.outdir)
    return {"run_id": run, "written": {r[0]: r[1] for r in written.groupBy("status").count().collect()}}


def repair(w: Workspace, run: int) -> dict:
    """Write again what a writing run left without title or summary, from the reranked hit or the article."""
    rows = w.summaries.read().where(F.col("run_id") == run)
    summaries = rows.select(F.concat_ws("#", F.col("run_id").cast("string"), "interest", F.col("rank").cast("string")).alias("id"), F.col("run_id").alias("writing_run_id"), "interest", "rank", F.col("id").alias("article_id"), "title", F.lit(None).cast("string").alias("url"), F.lit("").alias("lang"), F.col("summary").alias("summary_fr"))
    source = w.ledger.runs("writing").where(F.col("id") == run)
    hits = w.ledger.rows("rerank").join(w.docs(), "id").select("run_id", "interest", "rank", "id", "title", "url", F.col("body").alias("text"))
    fixed = writing.repair_summaries(writing.repair_context(summaries, source, hits), w.articles.read().select("id", "url", "content"), w.generator)
    key = F.split("id", "#")
    again = fixed.select(key[0].cast("long").alias("run_id"), key[1].alias("interest"), key[2].cast("int").alias("rank"), "title", "summary", "status", "notes")
    w.summaries.write(again.join(rows.select("run_id", "interest", "rank", "id"), ["run_id", "interest", "rank"]))
    return {"run_id": run, "repaired": again.where("status <> 'FAIL'").count()}


def evaluate(w: Workspace, args) -> dict:
    items = readers.read_eval(w.spark, args.eval_file).withColumn("item_id", F.monotonically_increasing_id())
    if args.upsert_articles:
        rows = items.select(F.col("article_id").alias("id"), "title", "content", "url", F.to_json(F.struct(*items.columns)).alias("raw"))
        w.articles.write(rows)
    _, hits = _full(w, args.table, args.run_id)
    named = evaluation.canonical_interest(hits.where("rank > 0"), readers.read_aliases(w.spark, args.eval_file))
    done = evaluation.evaluate(items, named.select(F.lower("interest").alias("interest"), "rank", "id", "url"))
    report = {"overall": evaluation.hit_rates(done).first().asDict(), "interests": [r.asDict() for r in evaluation.by_interest(done).orderBy("interest").collect()], "details": [r.asDict() for r in done.orderBy("item_id").collect()]}
    if args.out:
        files.write_whole(args.out, [json.dumps(report, ensure_ascii=False, indent=2).encode()])
    return report["overall"]


def expand(w: Workspace, args) -> dict:
    topics = w.spark.createDataFrame([(x,) for x in args.topic], "interest string")
    made = writing.expand_interests(topics, w.generator, type(w.generator).__name__, args.count, args.min_words, args.max_words, args.retries)
    return {"files": sinks.write_interest_files(made, args.out_dir or f"{w.root}/expansions", overwrite=True)}


def parse_archives(w: Workspace, args) -> dict:
    archives = files.listing(args.input, (".warc", ".warc.gz"))
    done = {x.rsplit("/", 1)[-1] for x in _folders(args.out)}
    if args.skip_existing:
        archives = [x for x in archives if f"input={readers.archive_stem(x)}" not in done]
    if archives:
        articles, _ = readers.archive_articles(readers.read_warc(w.spark, ",".join(archives)))
        sinks.write_by_file(articles, args.out)
    return {"archives": len(archives)}


def _folders(path: str) -> list[str]:
    from pyarrow import fs

    system, name = files.resolve(path)
    if system.get_file_info(name).type != fs.FileType.Directory:
        return []
    return [x.path for x in system.get_file_info(fs.FileSelector(name)) if x.type == fs.FileType.Directory]


def archive_manifest(w: Workspace, args) -> dict:
    found = readers.archive_manifest(w.spark.read.text(args.input), args.day)
    if args.out:
        found.coalesce(1).write.mode("overwrite").text(args.out)
    return {"archives": found.count()}


def export_gkg(w: Workspace, args) -> dict:
    rows = readers.gkg_rows(w.spark.read.text(args.input))
    rows.withColumn("themes", F.array_join("themes", ";")).write.mode("overwrite").option("header", True).csv(args.out)
    return {"rows": rows.count()}


def feed(w: Workspace, args) -> dict:
    rows = w.summaries.read().where("coalesce(notes, '') = ''")
    last = rows.groupBy("interest").agg(F.max("run_id").alias("run_id"))
    rows = rows.join(last, ["interest", "run_id"])
    if args.interest:
        rows = rows.where(F.lower("interest") == args.interest.lower())
    shown = rows.select("interest", "rank", "id", "title", writing.feed_summary(strip(F.col("summary"))).alias("summary")).orderBy("interest", "rank")
    return {"stories": [r.asDict() for r in shown.collect()]}  # the latest run's best of each interest


def orchestrate(w: Workspace, args) -> dict:
    """Expand, retrieve, deduplicate, rerank and write for one topic; a topic that has a feed already is not run again."""
    topic, out = " ".join(args.topic.split()), {}
    if w.summaries.exists() and not w.summaries.read().where(F.lower("interest") == topic.lower()).isEmpty():
        return {"topic": topic, "exists": True}
    for command in ("expand", "retrieve", "dedup", "rerank", "write"):
        given = {"expand": ["--topic", topic], "retrieve": ["--interest", topic]}.get(command, [])
        out[command] = COMMANDS[command](w, parser().parse_args([command, *given]))
    return out


COMMANDS = {
    "normalise": normalise, "retrieve": retrieve, "dedup": dedup_run, "rerank": rerank_run, "write": write_run, "evaluate": evaluate, "expand": expand,
    "parse-archives": parse_archives, "archive-manifest": archive_manifest, "export-gkg": export_gkg, "feed": feed, "orchestrate": orchestrate,
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    if spark is None:
        spark = build_session(args.master) if args.master else SparkSession.builder.appName("presswerk").getOrCreate()
    result = COMMANDS[args.command](Workspace(spark, args.workspace), args)
    print(json.dumps(result, ensure_ascii=False, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
