"""Lines repeated across one source's documents (problem 1), by compressed bitmaps of documents.

Each document gets a number whose upper bits name a block of 65,536 documents. For every line of a source a block
holds one container: a sorted list of 16-bit positions, or a bitmap of 65,536 bits once that is smaller. Containers
of the spellings of a line (case, digits, white space) are united, cardinalities are exact sums over blocks, and
lines are deleted by looking the document's bit up in the containers of its block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswerk.session import cut_lineage, read_table

BLOCK_BITS = 16
LIST_LIMIT = 4096  # positions of two bytes each; beyond that a bitmap of 8 KB is smaller

#: Lines that are looked up together, about; one document's lines are never parted.
LOOK_UP_LINES = 2_000_000

MIN_DOCS = 8
MIN_SHARE = 0.04


def pack(positions: np.ndarray) -> bytes:
    """A container of sorted distinct positions below 65,536."""
    if len(positions) <= LIST_LIMIT:
        return b"L" + positions.astype("<u2").tobytes()
    bits = np.zeros(1 << BLOCK_BITS, dtype=bool)
    bits[positions] = True
    return b"B" + np.packbits(bits).tobytes()


def unpack(container: bytes) -> np.ndarray:
    if container[:1] == b"L":
        return np.frombuffer(container, dtype="<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(container, dtype=np.uint8, offset=1)))


def unite(containers: list[bytes]) -> bytes:
    """The union of containers of one block."""
    if len(containers) == 1:
        return containers[0]
    bits = np.zeros(1 << BLOCK_BITS, dtype=bool)
    for container in containers:
        bits[unpack(container)] = True
    return pack(np.flatnonzero(bits))


def line_key(line):
    """What is left of a line when letter case, digits and white space do not count."""
    return F.regexp_replace(F.lower(F.upper(line)), r"(?U)[\s\p{Z}\p{Nd}]+", "")


def _numbered(df: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """(id, src, doc, line_nos, spellings, keys), one row for each id of a source, numbered once and for all."""
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    no_text = F.col(text_col).isNull() | F.trim(F.lower(text_col)).isin("", "none", "nan")
    blank = lambda x: F.regexp_replace(x, r"(?U)[\s\p{Z}]+", "") == ""
    rows = df.where(F.col(id_col).isNotNull() & F.col(source_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.xxhash64(F.col(source_col)).alias("src"),
        F.filter(F.transform(F.when(no_text, F.array().cast("array<string>")).otherwise(lines), lambda x, i: F.struct(i.alias("no"), x.alias("line"))), lambda s: ~blank(s["line"])).alias("lines"),
    )
    rows = rows.select(
        "id", "src",
        F.struct(
            F.transform("lines", lambda s: s["no"]).alias("line_nos"),
            F.transform("lines", lambda s: F.xxhash64(s["line"])).alias("spellings"),
            F.transform("lines", lambda s: F.xxhash64(line_key(s["line"]))).alias("keys"),
        ).alias("x"),
    )
    rows = rows.groupBy("id", "src").agg(F.first("x").alias("x")).select("id", "src", "x.*")
    return cut_lineage(rows.withColumn("doc", F.monotonically_increasing_id()), "line-docs")


def _containers(batches):
    """Batches sorted by (src, key, block, spelling) -> one container for each (src, key, block)."""
    schema = pa.schema([("src", pa.int64()), ("key", pa.int64()), ("block", pa.int64()), ("n", pa.int32()), ("container", pa.binary())])
    held = None
    for batch in batches:
        part = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("src", "key", "block", "spelling", "position")]
        part = part if held is None else [np.concatenate(x) for x in zip(held, part, strict=True)]
        src, key, block = part[:3]
        if not len(src):
            continue
        new = np.flatnonzero((src[1:] != src[:-1]) | (key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
        last = int(new[-1]) if len(new) else 0
        held = [x[last:] for x in part]
        if last:
            yield _pack_groups([x[:last] for x in part], new[:-1], schema)
    if held is not None and len(held[0]):
        yield _pack_groups(held, np.empty(0, dtype=np.int64), schema)


def _pack_groups(part, inner, schema):
    src, key, block, spelling, position = part
    starts = np.concatenate([[0], inner]).astype(np.int64)
    ends = np.append(inner, len(src))
    counts, containers = np.ones(len(starts), dtype=np.int32), []
    single = position.astype("<u2").tobytes()
    for g, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        if b - a == 1:
            containers.append(b"L" + single[2 * a : 2 * b])
            continue
        cuts = np.flatnonzero(spelling[a + 1 : b] != spelling[a : b - 1]) + 1
        container = unite([pack(np.unique(x)) for x in np.split(position[a:b], cuts)])
        counts[g] = len(unpack(container))
        containers.append(container)
    return pa.RecordBatch.from_arrays([pa.array(src[starts]), pa.array(key[starts]), pa.array(block[starts]), pa.array(counts), pa.array(containers, pa.binary())], schema=schema)


def _look_up(docs: pa.Table, containers: pa.Table) -> pa.Table:
    """The lines of one block's documents that stand in a container of the block."""
    out = pa.schema([("id", pa.string()), ("line_no", pa.int32())])
    if not docs.num_rows or not containers.num_rows:
        return out.empty_table()
    lists = docs.column("keys").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    keys = lists.flatten().to_numpy(zero_copy_only=False)
    line_nos = docs.column("line_nos").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(docs.num_rows), lengths)
    src = docs.column("src").to_numpy()[row]
    position = docs.column("position").to_numpy()[row]
    mix = lambda s, k: (s.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ k.astype(np.uint64)
    wanted_src, wanted_key = containers.column("src").to_numpy(), containers.column("key").to_numpy()
    wanted = mix(wanted_src, wanted_key)
    order = np.argsort(wanted, kind="stable")
    code = mix(src, keys)
    at = np.minimum(np.searchsorted(wanted[order], code), len(order) - 1)
    which = order[at]
    hit = np.flatnonzero((wanted_src[which] == src) & (wanted_key[which] == keys))
    if not len(hit):
        return out.empty_table()
    hit = hit[np.argsort(which[hit], kind="stable")]
    keep = []
    for one in np.split(hit, np.flatnonzero(np.diff(which[hit])) + 1):
        bits = np.zeros(1 << BLOCK_BITS, dtype=bool)
        bits[unpack(containers.column("container")[int(which[one[0]])].as_py())] = True
        keep.append(one[bits[position[one]]])
    keep = np.concatenate(keep)
    return pa.table([docs.column("id").take(pa.array(row[keep])), pa.array(line_nos[keep].astype(np.int32))], schema=out)


def find_repeated_lines(
    df: DataFrame,
    id_col: str = "id",
    source_col: str = "source",
    text_col: str = "content",
    min_docs: int = MIN_DOCS,
    min_share: float = MIN_SHARE,
    look_up_lines: int = LOOK_UP_LINES,
) -> DataFrame:
    """Rows (id, line_no): every place where a line repeated excessively within its source stands.

    A line counts once for an id. Rows without id or source take no part; null, empty, None / nan texts have no
    lines but their ids count among the source's. Repeated rows count once, ties at either threshold are in, extra
    columns are ignored, an empty table gives an empty result.
    """
    docs = _numbered(df, id_col, source_col, text_col)
    totals = docs.groupBy("src").agg(F.count("*").alias("docs"))
    rows = docs.select("src", (F.shiftright("doc", BLOCK_BITS)).alias("block"), F.col("doc").bitwiseAND((1 << BLOCK_BITS) - 1).cast("int").alias("position"), F.explode(F.arrays_zip("keys", "spellings")).alias("x"))
    rows = rows.select("src", F.col("x.keys").alias("key"), "block", F.col("x.spellings").alias("spelling"), "position")
    # A block has at most 65,536 documents, so no line makes a hot group, however many documents hold it.
    rows = rows.repartition("src", "key", "block").sortWithinPartitions("src", "key", "block", "spelling", "position")
    containers = rows.mapInArrow(_containers, "src long, key long, block long, n int, container binary")
    from pyspark.sql import Window

    containers = containers.withColumn("total", F.sum("n").over(Window.partitionBy("src", "key"))).where(F.col("total") >= min_docs)
    frequent = containers.join(totals, "src").where(F.col("total") >= F.col("docs") * F.lit(min_share) - 1e-9).select("src", "key", "block", "container")
    blocks = docs.select("id", "src", "line_nos", "keys", F.shiftright("doc", BLOCK_BITS).alias("block"), F.col("doc").bitwiseAND((1 << BLOCK_BITS) - 1).cast("int").alias("position"))
    # A block is looked up in as many parts as its lines ask for, each with the block's containers.
    parts = blocks.groupBy("block").agg(F.ceil(F.sum(F.size("keys")) / look_up_lines).cast("int").alias("parts")).where("parts > 0")
    blocks = blocks.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("position"), F.col("parts")).cast("int")).drop("parts")
    frequent = frequent.join(parts, "block").select("src", "key", "block", "container", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    found = blocks.groupBy("block", "part").cogroup(frequent.groupBy("block", "part")).applyInArrow(_look_up, "id string, line_no int")
    return found.distinct()


def remove_lines(df: DataFrame, places: DataFrame, id_col: str = "id", text_col: str = "content") -> DataFrame:
    """`df` with the lines at `places` (id, line_no) taken out of `text_col`; other columns and rows stay."""
    drop = places.groupBy(F.col("id").alias("__id")).agg(F.collect_set("line_no").alias("__drop"))
    kept = F.filter(F.transform(F.split(F.col(text_col), "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: ~F.array_contains("__drop", s["i"]))
    joined = df.join(drop, F.col(id_col).cast("string") == F.col("__id"), "left")
    text = F.when(F.col("__drop").isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(kept, lambda s: s["x"]), "\n"))
    return joined.withColumn(text_col, text).drop("__id", "__drop")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_repeated_lines(read_table(spark, sf_dir, "articles"))


def p1_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = read_table(spark, sf_dir, "articles").select("id", "content")
    return remove_lines(articles.groupBy("id").agg(F.min("content").alias("content")), find_repeated_lines(read_table(spark, sf_dir, "articles")))
