"""Readers and sinks: article files, web archives, GDELT rows, expansions, evaluation sets, manifests."""

from __future__ import annotations

import gzip
import io
import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from presswerk.sources import files
from presswerk.functions.text import article_id, column_instant, ingest_fingerprint, strip, themes_of, url_domain

# Accepted column names of an article's fields, first present wins.
ALIASES = {
    "title": ("headline", "title"),
    "content": ("text", "article", "description", "content"),
    "published_date": ("date", "published_date", "published"),
    "source": ("source_name", "domain", "source"),
    "url": ("link", "url"),
    "lang": ("lang",),
}


def expand_paths(spec: str | list[str]) -> list[str]:
    """The article files of files and folders (csv, jsonl, json of a folder, sorted), each once."""
    given = [spec] if isinstance(spec, str) else spec
    found = [f for one in given for f in (files.listing(one, (".csv", ".jsonl", ".json")) if "*" not in one else [one])]
    if not found:
        raise FileNotFoundError(f"no article files: {given}")
    return list(dict.fromkeys(found))


def file_kind(path: str) -> str:
    """csv, jsonl or json by name; a .json file whose first objects stand one a line is jsonl."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind not in ("csv", "jsonl", "json"):
        raise ValueError(f"not a format of article files: {path}")
    if kind == "json" and "*" not in path:
        with files.open_read(path) as stream:
            head = stream.read(1 << 16).decode("utf-8", "ignore").lstrip("\ufeff \t\r\n")
        first, more, second = head.partition("\n")
        if head.startswith("{") and more and first.rstrip().endswith("}") and second.lstrip().startswith("{"):
            return "jsonl"
    return kind


def read_articles(spark: SparkSession, paths: str | list[str], kind: str | None = None, limit: int | None = None) -> DataFrame:
    """Article files of any of the formats as they are: csv, jsonl (one object a line) or json (an array or one object)."""
    by_kind: dict[str, list[str]] = {}
    for path in expand_paths(paths):
        by_kind.setdefault(kind or file_kind(path), []).append(path)
    out = None
    for name, some in by_kind.items():
        if name == "csv":
            one = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(some)
        elif name in ("json", "jsonl"):
            one = spark.read.option("multiLine", name == "json").json(some)
        else:
            raise ValueError(f"not a format of article files: {name}")
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out if limit is None else out.limit(limit)


def read_cached(spark: SparkSession, path: str, cache: str, limit: int | None = None) -> DataFrame:
    """Normalised articles of `path`, read from `cache` while the files' times and sizes are the same."""
    folder = f"{cache.rstrip('/')}/{files.signature(path, limit)}"
    if not files.exists(f"{folder}/_SUCCESS"):
        normalise(read_articles(spark, path, limit=limit)).write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def payload_article(payload: Column, given_id: Column | None = None) -> Column:
    """A stored payload (struct) as an article: other names for id, content and date are taken where these are blank."""
    get = lambda *names: F.coalesce(*[F.nullif(payload[n], F.lit("")) for n in names])
    key = F.coalesce(given_id, get("article_id")) if given_id is not None else get("article_id")
    return F.struct(key.alias("id"), get("title").alias("title"), get("description").alias("description"), get("canonical_text", "description").alias("content"), get("date").alias("published_date"), F.coalesce(get("domain"), url_domain(payload["url"])).alias("source"), get("url").alias("url"), get("lang").alias("lang"), get("fingerprint").alias("fingerprint"))


def article_meta(payload: Column, article: Column, hit_id: Column) -> Column:
    """What is shown of a hit: its payload first, then the full article; of the dates the article's first."""
    first = lambda *columns: F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])
    return F.struct(
        first(payload["article_id"], article["id"], hit_id).alias("article_id"), first(payload["title"], article["title"]).alias("title"), first(payload["url"], article["url"]).alias("url"),
        first(payload["domain"], article["source"]).alias("source"), first(article["published_date"], payload["date"]).alias("published_date"), first(payload["lang"], article["lang"]).alias("lang"),
    )


def normalise(df: DataFrame) -> DataFrame:
    """The one article schema, with ids and fingerprints; rows without title or content are dropped, first of a url kept."""
    columns = {}
    for field, names in ALIASES.items():
        present = [F.nullif(F.nullif(F.nullif(strip(F.col(n).cast("string")), F.lit("")), F.lit("None")), F.lit("nan")) for n in names if n in df.columns]
        columns[field] = F.coalesce(*present) if present else F.lit(None).cast("string")
    out = df.select(*[c.alias(n) for n, c in columns.items()]).where("title is not null and content is not null")
    digits = F.regexp_replace("published_date", r"^(\d{14})\.0+$", "$1")
    out = out.withColumn("published_date", column_instant(digits)).withColumn("id", article_id(F.col("url"), F.col("title"), F.col("content"))).withColumn("fingerprint", ingest_fingerprint(F.col("url"), F.col("title"), F.col("content")))
    # The first of an id's rows in an order that does not depend on how they came.
    return out.groupBy("id").agg(F.min(F.struct(*[c for c in out.columns if c != "id"])).alias("x")).select("x.*", "id")


def full_articles(df: DataFrame, detect=None) -> DataFrame:
    """Articles with description, tags and the text that is embedded: title, description and the first 1,200 characters.

    Names are taken as they come: description or summary; text, content or article; date, published_at, published_date
    or datetime; domain, the url's host, or source. `detect(text)` may give the language of rows without one.
    """
    get = lambda *names: F.coalesce(*[F.nullif(strip(F.col(n).cast("string")), F.lit("")) for n in names if n in df.columns], F.lit(None).cast("string"))
    title, about, text, url = get("title"), get("description", "summary"), get("text", "content", "article"), get("url")
    domain = F.coalesce(get("domain"), F.nullif(url_domain(F.coalesce(url, F.lit(""))), F.lit("")), get("source"))
    lead = F.substring(F.coalesce(text, F.lit("")), 1, 1200)
    canonical = strip(F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(about, F.lit("")), lead))
    lang = F.lower(get("lang", "language"))
    if detect is not None:
        lang = F.coalesce(lang, detect(canonical))
    tags = F.col("tags") if dict(df.dtypes).get("tags", "").startswith("array") else F.array().cast("array<string>")
    return df.select(
        F.coalesce(get("id"), article_id(url, title, text)).alias("id"), title.alias("title"), about.alias("description"), text.alias("content"), column_instant(get("date", "published_at", "published_date", "datetime")).alias("published_date"),
        domain.alias("source"), url.alias("url"), lang.alias("lang"), tags.alias("tags"), canonical.alias("canonical_text"), ingest_fingerprint(url, title, text).alias("fingerprint"),
    )


def write_articles(df: DataFrame, path: str, kind: str = "json") -> None:
    if kind == "csv":
        flat = df.select(*[F.array_join(c, ";").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])
        flat.where("coalesce(text, '') <> ''").write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        df.write.mode("overwrite").json(path)


def archive_manifest(lines: DataFrame, day: str) -> DataFrame:
    """Archive paths of one day (yyyymmdd or a prefix of it) from the lines of a listing."""
    name = F.regexp_extract("value", r"CC-NEWS-(\d{14})-\d{5}\.warc\.gz", 1)
    return lines.where((name != "") & F.startswith(name, F.lit(day))).select(F.trim("value").alias("path")).distinct().orderBy("path")


def gkg_manifest(lines: DataFrame, first: str, last: str) -> DataFrame:
    """Urls of knowledge-graph files between two days, both included."""
    url = F.element_at(F.split(F.trim("value"), r"\s+"), -1)
    day = F.substring(F.element_at(F.split(url, "/"), -1), 1, 8)
    return lines.where(F.contains("value", F.lit(".gkg.csv.zip")) & day.between(first, last)).select(url.alias("url"))


def gkg_rows(lines: DataFrame) -> DataFrame:
    """(date, source, url, domain, themes) of tab-separated lines with at least eight fields."""
    f = F.split("value", "\t")
    return lines.where(F.size(f) >= 8).select(column_instant(f[1]).alias("date"), f[3].alias("source"), f[4].alias("url"), url_domain(f[4]).alias("domain"), themes_of(f[7]).alias("themes"))


def read_expansions(spark: SparkSession, path: str) -> DataFrame:
    """Expansion files, one object each; unreadable ones are skipped."""
    raw = spark.read.option("multiLine", True).option("mode", "DROPMALFORMED").schema("interest string, model string, generated_at string, status string, n_items int, items array<string>, raw_output string").json(path)
    return clean_expansions(raw.withColumn("file", F.input_file_name()))


def clean_expansions(raw: DataFrame) -> DataFrame:
    """(interest, items) of expansions (interest, items, file): items trimmed, blanks and repeats out, an interest's last file wins."""
    last = raw.where("interest is not null and items is not null").groupBy("interest").agg(F.max_by("items", "file").alias("items"))
    return last.select("interest", F.array_distinct(F.filter(F.transform("items", lambda x: strip(x)), lambda x: x != "")).alias("items"))


def _labelled_set(path: str) -> tuple[list[dict], dict]:
    """The articles of a labelled set, nested at any depth, and its interests' aliases; one small file, read whole."""
    with files.open_read(path) as stream:
        data = json.loads(stream.read())

    def flat(node):
        if isinstance(node, list):
            for x in node:
                yield from flat(x)
        elif isinstance(node, dict) and isinstance(node.get("articles"), list):
            yield from flat(node["articles"])
        elif isinstance(node, dict):
            yield node

    return list(flat(data)), data.get("interest_aliases", {}) if isinstance(data, dict) else {}


def read_eval(spark: SparkSession, path: str) -> DataFrame:
    """A labelled set; the expected interest may be one string, the target is 20 by default, missing ids are made."""
    rows = []
    for a in _labelled_set(path)[0]:
        expected = a.get("expected_interests", a.get("expected_interest"))
        expected = [str(x) for x in expected] if isinstance(expected, list) else [str(expected)] if expected else []
        fields = [None if (x := a.get(n)) is None else str(x) for n in ("article_id", "title", "content", "url")]
        rows.append((*fields, expected, int(a.get("rank_target_max") or 20)))
    out = spark.createDataFrame(rows, "article_id string, title string, content string, url string, expected_interests array<string>, rank_target_max int")
    return out.withColumn("article_id", F.coalesce("article_id", article_id(F.col("url"), F.col("title"), F.col("content"))))


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """(alias, canonical) of a labelled set's interests, lower-cased; a name that stands twice belongs to the first."""
    pairs: dict[str, str] = {}
    for canonical, names in _labelled_set(path)[1].items():
        for name in [canonical, *(names if isinstance(names, list) else [names])]:
            pairs.setdefault(str(name).strip().lower(), canonical)
    return spark.createDataFrame(list(pairs.items()), "alias string, canonical string")


def warc_records(stream: io.BufferedIOBase) -> Iterator[tuple[str, str, str, str, bytes]]:
    """(url, date, content type, content encoding, body) of the response records of an uncompressed stream."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        head: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        body = stream.read(int(head.get("content-length", "0") or 0))
        if head.get("warc-type") != "response":
            continue
        top, _, payload = body.partition(b"\r\n\r\n")
        http = {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in top.decode("latin-1").split("\r\n")[1:])}
        yield head.get("warc-target-uri", "").strip("<>"), head.get("warc-date", ""), http.get("content-type", ""), http.get("content-encoding", ""), payload


class WarcSource(DataSource):
    """spark.read.format("warc").load(folder or files): one partition for each archive file."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return "file string, url string, stored string, content_type string, content_encoding string, body binary"

    def reader(self, schema) -> DataSourceReader:
        return _WarcReader(self.options["path"])


class _WarcReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return [InputPartition(f) for f in sorted(f for p in self.path.split(",") for f in files.listing(p, (".warc", ".warc.gz")))]

    def read(self, partition):
        with files.open_read(partition.value) as raw:
            stream = gzip.GzipFile(fileobj=raw) if partition.value.endswith(".gz") else io.BufferedReader(raw)
            for record in warc_records(stream):
                yield (partition.value, *record)


def archive_stem(path: str) -> str:
    """An archive's file name without its endings, by which its output is named."""
    name = path.rsplit("/", 1)[-1]
    return name.removesuffix(".gz").removesuffix(".warc")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").load(path)


def warc_bytes(records: list[tuple[str, str, str]]) -> bytes:
    """Response records (url, date, html), each its own gzip member."""
    out = io.BytesIO()
    for url, date, html in records:
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + html.encode()
        head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {url}\r\nWARC-Date: {date}\r\nContent-Length: {len(http)}\r\n\r\n".encode()
        out.write(gzip.compress(head + http + b"\r\n\r\n"))
    return out.getvalue()


def archive_articles(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(articles, outcomes) of archive records: filters, decoding, extraction, one article for a url of a file.

    Outcomes are (file, outcome, n): `early` and `late` are responses that the filters left out before and after decoding,
    `repeated` further responses of a url, `short_text` pages without an article, `article` the rest.
    """
    import pandas as pd

    from presswerk.sources import html as h

    def decode(batches):
        for pdf in batches:
            pdf["html"] = [h.decode_body(b, e, c) for b, e, c in zip(pdf["body"], pdf["content_encoding"], pdf["content_type"], strict=True)]
            yield pdf[["file", "url", "stored", "html"]]

    checked = raw.withColumn("early", h.before_decode(F.col("url"), F.length("body"), F.col("content_type")))
    decoded = checked.where("early").mapInPandas(decode, "file string, url string, stored string, html string").withColumn("late", h.after_decode(F.col("html")))
    fine = decoded.where("late").dropDuplicates(["file", "url"])
    pages = h.extract_pages(fine)
    count = lambda df, outcome: df.groupBy("file").agg(F.count("*").alias("n")).select("file", (F.lit(outcome) if isinstance(outcome, str) else outcome).alias("outcome"), "n")
    repeated = decoded.where("late").groupBy("file").agg((F.count("*") - F.countDistinct("url")).alias("n")).where("n > 0").select("file", F.lit("repeated").alias("outcome"), "n")
    kept = pages.groupBy("file", F.when(F.col("reason") == "", F.lit("article")).otherwise(F.col("reason")).alias("outcome")).agg(F.count("*").alias("n"))
    outcomes = count(checked.where("not early"), "early").union(count(decoded.where("not late"), "late")).union(repeated).union(kept)
    return pages.where("reason = ''"), outcomes
