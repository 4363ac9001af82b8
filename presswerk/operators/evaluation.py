"""Evaluation of hits against a labelled set: match by id, else by url; best rank; rank points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswerk.functions.text import normal_url


def rank_points(rank: Column, target: Column) -> Column:
    return F.when(rank <= 0, 0.0).when(rank <= F.least(F.lit(3), target), 1.0).when(rank <= F.least(F.lit(10), target), 0.7).when(rank <= target, 0.4).otherwise(0.1)


def canonical_interest(df: DataFrame, aliases: DataFrame, col: str = "interest") -> DataFrame:
    """`df` with the interest under its canonical name where (alias, canonical) knows it; the aliases are one set's."""
    named = aliases.select(F.col("alias").alias("__alias"), F.col("canonical").alias("__canonical"))
    return df.join(named, F.lower(F.trim(col)) == F.col("__alias"), "left").withColumn(col, F.coalesce("__canonical", col)).drop("__alias", "__canonical")


def by_interest(evaluated: DataFrame) -> DataFrame:
    """(interest, total, right, score, rank_avg) by the first expected interest; the average is over found items."""
    found = F.when(F.col("found"), F.col("rank_points"))
    out = evaluated.groupBy(F.col("first_expected").alias("interest")).agg(F.count("*").alias("total"), F.sum(F.col("ok").cast("long")).alias("right"), F.avg(found).alias("rank_avg"))
    return out.withColumn("score", F.concat_ws("/", F.col("right").cast("string"), F.col("total").cast("string")))


def hit_rates(evaluated: DataFrame, k: int = 20) -> DataFrame:
    """One row (items, hit_at_k, mrr, any_hit_at_k): share of items found right within k, mean reciprocal rank, share found at all."""
    rank, any_rank = F.when(F.col("ok"), F.col("found_rank")), F.when(F.col("found"), F.col("found_rank"))
    return evaluated.agg(F.avg(F.coalesce((any_rank <= k).cast("double"), F.lit(0.0))).alias("any_hit_at_k"), F.count("*").alias("items"), F.avg(F.coalesce((rank <= k).cast("double"), F.lit(0.0))).alias("hit_at_k"), F.avg(F.coalesce(1.0 / rank, F.lit(0.0))).alias("mrr"))


def evaluate(items: DataFrame, hits: DataFrame) -> DataFrame:
    """One row for each item: found, found_interest, found_rank, ok, rank_points, first expected interest.

    items (item_id, article_id, url, expected_interests, rank_target_max), hits (interest, rank, id, url). The
    best-ranked hit counts; if it is another interest's, the item is wrong although found.
    """
    best = F.min(F.struct("rank", "interest"))
    by_id = hits.groupBy("id").agg(best.alias("by_id"))
    by_url = hits.withColumn("nurl", normal_url(F.col("url"))).where("nurl <> ''").groupBy("nurl").agg(best.alias("by_url"))
    e = items.withColumn("nurl", normal_url(F.col("url"))).join(by_id, items.article_id == F.col("id"), "left").join(by_url, "nurl", "left")
    hit = F.coalesce("by_id", "by_url")
    expected = F.transform(F.coalesce("expected_interests", F.array().cast("array<string>")), lambda x: F.lower(F.trim(x)))
    target = F.coalesce("rank_target_max", F.lit(20))
    e = e.withColumns({"hit": hit, "expected": expected, "target": target})
    ok = F.col("hit").isNotNull() & F.array_contains("expected", F.lower(F.trim("hit.interest")))
    return e.select(
        "item_id", F.coalesce(F.get("expected", F.lit(0)), F.lit("")).alias("first_expected"), F.col("hit").isNotNull().alias("found"), F.coalesce("hit.interest", F.lit("")).alias("found_interest"),
        F.coalesce("hit.rank", F.lit(0)).alias("found_rank"), F.coalesce(ok, F.lit(False)).alias("ok"), F.when(ok, rank_points(F.col("hit.rank"), F.col("target"))).otherwise(0.0).alias("rank_points"),
    )
