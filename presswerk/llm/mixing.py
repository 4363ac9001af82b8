"""Mixing sources to target weights (problem 9), by entropy balancing.

Each document gets a rate, the expected number of its copies. Among all rates that give every source its share of
the tokens, entropy balancing takes those closest to one per document: rate = min(cap, exp(lambda x tokens)), with one
multiplier for each source from the convex dual. Newton iterations for the multipliers need only sums over documents,
and as documents of one source and length have one rate, they run over a small written table of counts. The rates are
then rounded along the cumulative sum, so a source's tokens are off by less than about one document.
"""

from __future__ import annotations

import base64
import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from presswerk.session import cut_lineage, read_table, release

TOKENIZER_ENV = "PRESSWERK_TOKENIZER"
TOKENIZER_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The usual pre-tokenisation of byte-level BPE: contractions, letters, numbers, other marks, white space.
TOKEN_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NEWTON_ROUNDS = 60
TOLERANCE = 1e-10
#: Documents of one source and length are rounded in parts of about so many, so that copies of one text make no hot group.
PART_DOCS = 20_000


def _token_batches(path: str):
    def run(batches):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("mixing", pat_str=TOKEN_PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            counts = [len(encoding.encode_ordinary(x)) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "source", "tokens"])

    return run


def token_counts(df: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, tokens) for documents with id, source and text."""
    path = tokenizer or os.environ.get(TOKENIZER_ENV, TOKENIZER_FILE)
    rows = df.where(F.col(id_col).isNotNull() & F.col(source_col).isNotNull() & (F.col(text_col) != ""))
    return rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text")).mapInArrow(_token_batches(path), "doc_id long, source string, tokens long")


def balance(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, scale, lambda, cap, target_tokens) from cells (source, tokens, n) and targets; one Newton step a round.

    The total is the largest that all caps allow, so at least one source uses its cap in full. Sources without tokens
    cannot take part. Multipliers that have not settled within the rounds are an error.
    """
    stats = cells.groupBy("source").agg(F.sum(F.col("tokens") * F.col("n")).cast("double").alias("have"), F.max("tokens").cast("double").alias("scale"))
    goals = targets.groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").cast("double").alias("cap")).where("share > 0 and cap > 0")
    state = goals.join(stats.where("have > 0"), "source")
    total = state.agg(F.min(F.col("have") * F.col("cap") / F.col("share")).alias("total")).first()[0] or 0.0
    if total <= 0:
        return state.limit(0).select("source", "scale", F.lit(0.0).alias("lambda"), "cap", F.lit(0.0).alias("target_tokens"))
    state = state.select("source", "scale", "cap", (F.col("share") * F.lit(total)).alias("target_tokens"), (F.col("share") * F.lit(total) >= F.col("have") * F.col("cap") * (1 - 1e-9)).alias("full"))
    # From the second side the search knows both an upper and a lower multiplier and halves when Newton leaves them.
    state = state.select("*", F.lit(0.0).alias("lambda"), F.lit(-1e4).alias("low"), F.lit(1e4).alias("high"))
    state = previous = cut_lineage(state, "multipliers")
    for _ in range(NEWTON_ROUNDS):
        x = F.col("tokens") / F.col("scale")
        raw = F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("lambda") * x)))
        rate = F.least(F.col("cap"), raw)
        sums = (
            cells.join(state, "source").where("not full").groupBy("source")
            .agg(F.sum(F.col("n") * F.col("tokens") * rate).alias("value"), F.sum(F.when(raw < F.col("cap"), F.col("n") * F.col("tokens") * x * rate).otherwise(0.0)).alias("slope"))
        )
        moved = state.join(sums, "source", "left").withColumn("gap", F.coalesce(F.col("value") - F.col("target_tokens"), F.lit(0.0)))
        moved = moved.withColumn("low", F.when(F.col("gap") < 0, F.col("lambda")).otherwise(F.col("low"))).withColumn("high", F.when(F.col("gap") > 0, F.col("lambda")).otherwise(F.col("high")))
        newton = F.when(F.col("slope") > 1e-9, F.col("lambda") - F.col("gap") / F.col("slope"))
        middle = F.when((F.col("low") > -1e4) & (F.col("high") < 1e4), (F.col("low") + F.col("high")) / 2).otherwise(F.when(F.col("gap") < 0, F.col("lambda") * 2 + 1).otherwise(F.col("lambda") * 2 - 1))
        inside = newton.isNotNull() & (newton > F.col("low")) & (newton < F.col("high")) & (F.abs(newton - F.col("lambda")) < 50)
        done = F.abs(F.col("gap")) <= TOLERANCE * F.col("target_tokens")
        moved = moved.withColumn("lambda", F.when(done | F.col("full"), F.col("lambda")).when(inside, newton).otherwise(middle)).withColumn("open", ~done & ~F.col("full"))
        state = cut_lineage(moved.select("source", "scale", "cap", "target_tokens", "full", "lambda", "low", "high", "open"), "multipliers")
        release(previous)
        previous = state
        if state.where("open").isEmpty():
            break
    else:
        raise ArithmeticError(f"the multipliers have not settled in {NEWTON_ROUNDS} rounds")
    return state.select("source", "scale", F.when(F.col("full"), F.lit(1e9)).otherwise(F.col("lambda")).alias("lambda"), "cap", "target_tokens")


def mix(df: DataFrame, targets: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", part_docs: int = PART_DOCS) -> DataFrame:
    """Rows (doc_id, source, tokens, copies): the mixed set, documents with at least one copy.

    Documents of other sources, without source or id, and null or empty texts are not in it. Repeated rows of an id
    count once, ties are broken by the hash of the id, extra columns are ignored; an empty table gives an empty mix. A
    target source without any tokens cannot reach its share; the others are mixed in proportion, `reached_shares` shows it.
    """
    named = targets.select("source").where("source is not null").distinct()
    wanted = df.join(named.withColumnRenamed("source", "__source"), F.col(source_col) == F.col("__source"), "left_semi")
    docs = token_counts(wanted, tokenizer, id_col, text_col, source_col).groupBy("doc_id").agg(F.max(F.struct("source", "tokens")).alias("x"))
    docs = cut_lineage(docs.select("doc_id", "x.source", "x.tokens").where("tokens > 0"), "token-counts")
    cells = cut_lineage(docs.groupBy("source", "tokens").agg(F.count("*").alias("n")), "cells")
    state = balance(cells, targets)
    rate = F.least(F.col("cap"), F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("lambda") * F.col("tokens") / F.col("scale")))))
    parts = cells.where(F.col("n") > part_docs).select("source", "tokens", F.ceil(F.col("n") / part_docs).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("doc_id"), F.coalesce("parts", F.lit(1))).cast("int")
    docs = docs.join(parts, ["source", "tokens"], "left").select("doc_id", "source", "tokens", part.alias("part"))
    fine = cut_lineage(docs.groupBy("source", "tokens", "part").agg(F.count("*").alias("n")), "token-cells")
    # Rounding along the cumulative sum over cells (source, tokens, part): as many as a source has lengths, and thousands of documents.
    order = Window.partitionBy("source").orderBy("tokens", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rated = fine.join(state, "source").withColumn("rate", rate)
    rated = rated.withColumn("upto", F.sum(F.col("n") * F.col("rate")).over(order))
    copies = F.floor(F.col("upto") + 0.5) - F.floor(F.col("upto") - F.col("n") * F.col("rate") + 0.5)
    rated = rated.select("source", "tokens", "part", "n", F.least(F.greatest(copies, F.lit(0)), (F.col("n") * F.col("cap")).cast("long")).alias("copies"))
    ranked = docs.withColumn("rank", F.row_number().over(Window.partitionBy("source", "tokens", "part").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")))
    out = ranked.join(rated, ["source", "tokens", "part"]).withColumn("copies", F.floor(F.col("copies") / F.col("n")) + F.when(F.col("rank") <= F.col("copies") % F.col("n"), 1).otherwise(0))
    return out.where("copies > 0").select("doc_id", "source", "tokens", F.col("copies").cast("int").alias("copies"))


def reached_shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, share, tokens, documents, most_copies): what a mix actually reached."""
    by = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("documents"), F.max("copies").alias("most_copies"))
    total = by.agg(F.sum("tokens").alias("all_tokens"))
    joined = targets.select("source", "target_share").join(by, "source", "left").crossJoin(F.broadcast(total))  # one row
    return joined.select("source", "target_share", (F.coalesce("tokens", F.lit(0)) / F.col("all_tokens")).alias("share"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reached_shares(cut_lineage(p9_mix(spark, sf_dir), "mix"), read_table(spark, sf_dir, "mix_targets"))
