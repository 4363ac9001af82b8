"""Exports: JSON arrays, lines by input file, CSV, nested results, one file for each interest with an index, error logs."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswerk.functions.similarity import slug_text
from presswerk.sources import files


def write_json_array(df: DataFrame, path: str) -> str:
    """One file with one array, row by row through the driver; for exports that one reader takes as a whole."""

    def chunks():
        first = True
        yield b"["
        for row in df.select(F.to_json(F.struct(*df.columns))).toLocalIterator():
            yield (b"\n" if first else b",\n") + row[0].encode()
            first = False
        yield b"\n]\n"

    return files.write_whole(path, chunks())


def write_by_file(df: DataFrame, folder: str, file_col: str = "file", url_col: str = "url") -> None:
    """JSON lines in a folder for each input file, each url of a file once; files written before are replaced, others stay."""
    name = F.regexp_extract(F.col(file_col), r"([^/]+?)(?:\.warc)?(?:\.gz)?$", 1)
    rows = df.dropDuplicates([file_col, url_col]).withColumn("input", name)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("input").json(folder)


def export_csv(df: DataFrame, path: str, text_col: str = "text") -> None:
    """Rows with text, lists joined by semicolons."""
    flat = [F.array_join(c, ";").alias(c) if kind.startswith("array") else F.col(c) for c, kind in df.dtypes]
    df.where(F.coalesce(F.trim(text_col), F.lit("")) != "").select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def result_blocks(hits: DataFrame, interest_col: str = "interest", rank_col: str = "rank") -> DataFrame:
    """(interest, n, articles): the hits of an interest in order; a run's hits are bounded by its top-k."""
    fields = [c for c in hits.columns if c != interest_col]
    ordered = F.array_sort(F.collect_list(F.struct(rank_col, *[c for c in fields if c != rank_col])))
    return hits.groupBy(interest_col).agg(F.count("*").cast("int").alias("n"), ordered.alias("articles"))


def write_results(hits: DataFrame, path: str, parameters: dict | None = None) -> str:
    """The nested result file of a run: when, how, and the articles of each interest."""
    head = {"generated_at": dt.datetime.now(dt.timezone.utc).isoformat(), **(parameters or {})}

    def chunks():
        yield json.dumps(head, ensure_ascii=False)[:-1].encode() + b', "results": ['
        first = True
        for row in result_blocks(hits).orderBy("interest").select(F.to_json(F.struct("interest", "n", "articles"))).toLocalIterator():
            yield (b"\n" if first else b",\n") + row[0].encode()
            first = False
        yield b"]}\n"

    return files.write_whole(path, chunks())


def write_interest_files(blocks: DataFrame, folder: str, overwrite: bool = False) -> list[str]:
    """One JSON file for each interest of (interest, ...), written whole or not at all, and index.json over them.

    Without `overwrite` interests whose file is there are skipped, so a run that broke off is resumed.
    """
    rest = [c for c in blocks.columns if c != "interest"]
    written, index = [], []
    for interest, body in blocks.orderBy("interest").select("interest", F.to_json(F.struct("interest", *rest))).toLocalIterator():
        path = f"{folder.rstrip('/')}/{slug_text(interest)}.json"
        index.append({"interest": interest, "file": path.rsplit("/", 1)[1]})
        if overwrite or not files.exists(path):
            written.append(files.write_whole(path, [body.encode()]))
    files.write_whole(f"{folder.rstrip('/')}/index.json", [json.dumps(index, ensure_ascii=False, indent=2).encode()])
    return written


def log_errors(rows: DataFrame, path: str, note: str) -> None:
    """Rows that failed, appended as JSON lines with a note and the time."""
    rows.withColumn("note", F.lit(note)).withColumn("logged_at", F.current_timestamp()).write.mode("append").json(path)
