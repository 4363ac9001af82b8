"""Query specs from interests, expansions, tags and profiles, and the parameters of a run."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from presswerk.functions.similarity import dot
from presswerk.functions.text import norm_text, strip
from presswerk.operators.indexing import Embedder, embed
from presswerk.operators.retrieval import RetrievalConfig, merge_specs, retrieve, spec_weight

MAX_EXPANSIONS = 6
TAG_WEIGHT = 0.20
#: Just under the weight of an anchor.
MOST_WEIGHT = 0.999999


def resolve_parameters(given: dict) -> tuple[RetrievalConfig, int]:
    """A run's config and expansions an interest, from what a user gave; two older names stand for several lists.

    `dense_per_center` is the anchors' list and, times 0.4, the expansions'; `bm25_k` is both lexical lists. The
    precise names come first, then these, then the defaults; a None counts as not given.
    """
    have = {k: v for k, v in given.items() if v is not None}
    base = RetrievalConfig()
    center, lexical = have.get("dense_per_center"), have.get("bm25_k")
    derived = {"dense_per_anchor": center, "dense_per_expansion": None if center is None else max(1, round(center * 0.4)), "title_k": lexical, "body_k": lexical}
    aliases = {"title_k": "bm25_title_k", "body_k": "bm25_body_k", "top_k": "topk"}
    values = {}
    for field in dataclasses.fields(RetrievalConfig):
        name = field.name
        values[name] = next((x for x in (have.get(name), have.get(aliases.get(name, name)), derived.get(name)) if x is not None), getattr(base, name))
    if have.get("dense_only"):
        values["title_k"] = values["body_k"] = 0
    return RetrievalConfig(**values), int(have.get("max_expansions", MAX_EXPANSIONS))


def profile_config(dense_per_center: int = 250, bm25_k: int = 250, top_k: int = 20) -> RetrievalConfig:
    """The preset of a profile's retrieval: all interests are anchors, the cap grows with the list asked for."""
    config, _ = resolve_parameters({"dense_per_center": dense_per_center, "bm25_k": bm25_k, "top_k": top_k, "min_sim": 0.0, "min_bm25": 0.0})
    return dataclasses.replace(config, candidate_cap=max(800, top_k))


def _embedded(specs: DataFrame, embedder: Embedder) -> DataFrame:
    keyed = specs.withColumn("__key", F.concat_ws("\u001f", "interest", F.col("q_pos").cast("string")))
    return keyed.join(embed(keyed, embedder, "__key", "text").withColumnRenamed("id", "__key"), "__key").drop("__key")


def interest_specs(interests: DataFrame, expansions: DataFrame, embedder: Embedder, max_expansions: int = MAX_EXPANSIONS) -> DataFrame:
    """Merged specs (interest, q_pos, text, weight, kind, vec): an anchor and its first different expansions.

    interests (interest), expansions (interest, items); an expansion's weight is its similarity to the anchor, held in bounds.
    """
    anchors = interests.select(strip(F.col("interest")).alias("interest")).where("interest <> ''").distinct()
    anchors = _embedded(anchors.select("interest", F.lit(0).alias("q_pos"), F.col("interest").alias("text"), F.lit(1.0).alias("weight"), F.lit("anchor").alias("kind")), embedder)
    # Expansions are found whatever the case and spacing of their interest; of several notations all items count.
    names = anchors.select("interest", norm_text(F.col("interest")).alias("name"))
    items = expansions.select(norm_text(F.col("interest")).alias("name"), F.posexplode("items").alias("pos", "item")).join(names, "name").select("interest", "pos", strip(F.col("item")).alias("text"))
    items = items.withColumn("key", norm_text(F.col("text"))).where((F.col("key") != "") & (F.col("key") != norm_text(F.col("interest"))))
    first = items.groupBy("interest", "key").agg(F.min(F.struct("pos", "text")).alias("x")).select("interest", "x.pos", "x.text")
    place = F.row_number().over(Window.partitionBy("interest").orderBy("pos", "text"))
    chosen = first.withColumn("q_pos", place).where(F.col("q_pos") <= max_expansions).select("interest", "q_pos", "text")
    chosen = _embedded(chosen.withColumn("kind", F.lit("expansion")), embedder).join(anchors.select("interest", F.col("vec").alias("anchor")), "interest")
    weighed = chosen.select("interest", "q_pos", "text", F.least(spec_weight(F.col("anchor"), F.col("vec")), F.lit(MOST_WEIGHT)).alias("weight"), "kind", "vec")
    return merge_specs(anchors.select(*weighed.columns).unionByName(weighed))


def tag_specs(tags: list[str], interests: DataFrame, embedder: Embedder, weight: float = TAG_WEIGHT) -> DataFrame:
    """The different tags as expansions of every interest, with one weight held in bounds."""
    spark = interests.sparkSession
    listed = spark.createDataFrame([(i, t) for i, t in enumerate(tags)], "pos int, text string").withColumn("text", strip(F.col("text")))
    first = listed.groupBy(norm_text(F.col("text")).alias("key")).agg(F.min(F.struct("pos", "text")).alias("x")).where("key <> ''").select("x.pos", "x.text")
    specs = interests.select("interest").distinct().crossJoin(F.broadcast(first))  # the tags of one command
    held = min(0.45, max(0.15, float(weight)))
    return _embedded(specs.select("interest", (F.lit(10_000) + F.col("pos")).alias("q_pos"), "text", F.lit(held).alias("weight"), F.lit("expansion").alias("kind")), embedder)


def aggregate_specs(specs: DataFrame) -> DataFrame:
    """The specs of all interests under one label, their names joined, merged again."""
    named = specs.agg(F.array_join(F.array_sort(F.collect_set("interest")), "; ").alias("label"))  # the interests of one run
    place = F.row_number().over(Window.partitionBy("label").orderBy("interest", "q_pos"))
    one = specs.crossJoin(F.broadcast(named)).withColumn("place", place)
    return merge_specs(one.select(F.col("label").alias("interest"), F.col("place").alias("q_pos"), *[c for c in specs.columns if c not in ("interest", "q_pos")]))


def retrieve_profile(docs: DataFrame, vectors: DataFrame, phrases: DataFrame, embedder: Embedder, top_k: int = 20, langs: list[str] | None = None) -> DataFrame:
    """A user's feed from their phrases (interest) alone: each is an anchor of one list, as `profile_config` says."""
    empty = phrases.select("interest", F.array().cast("array<string>").alias("items")).limit(0)
    merged = aggregate_specs(interest_specs(phrases, empty, embedder))
    return retrieve(docs, vectors, merged, profile_config(top_k=top_k), langs)
