"""Best representative of each duplicate group (problem 5), by currency reasoning.

From rows with timestamps the operator learns, for each attribute, which values usually follow which: value a precedes
b if a came before b clearly more often than after it. The precedences of an attribute are kept acyclic by their
values' net number of followers and closed transitively, so two values are ordered only if one leads to the other.
In a group these orders, with the instants of the rows that have one, make a partial order of the members. A field
of the survivor comes from the members with the best value of it (longest, latest, most trusted); where several have
it, or none has a timestamp, the topologically latest of them is taken. All of it is aggregation and joins on values;
no group is gathered anywhere, and no pairs of its members are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from presswerk.operators.timestamps import normalise_timestamps
from presswerk.session import cut_lineage, read_table, release

#: Rows of one group are compared in blocks of about so many, so that a huge group is spread over many tasks.
BLOCK_ROWS = 1000
MIN_SUPPORT = 5
MIN_MAJORITY = 0.6


def learn_precedence(values: DataFrame, min_support: int = MIN_SUPPORT, min_majority: float = MIN_MAJORITY) -> DataFrame:
    """(attribute, earlier, later), closed transitively, from rows (attribute, group_key, id, value, epoch_us)."""
    dated = values.where("epoch_us is not null and value is not null")
    sizes = dated.groupBy("attribute", "group_key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = dated.join(sizes, ["attribute", "group_key"]).withColumn("block", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BLOCK_ROWS)))
    order = Window.partitionBy("attribute", "group_key", "block").orderBy("epoch_us", "id")
    steps = blocks.select("attribute", F.lag("value").over(order).alias("earlier"), F.col("value").alias("later"), (F.lag("epoch_us").over(order) < F.col("epoch_us")).alias("apart"))
    counts = steps.where("apart and earlier <> later").groupBy("attribute", "earlier", "later").agg(F.count("*").alias("n"))
    # Both directions of a pair in one row: how often each came first.
    low, high, upward = F.least("earlier", "later").alias("low"), F.greatest("earlier", "later").alias("high"), F.col("earlier") < F.col("later")
    both = counts.groupBy("attribute", low, high).agg(F.sum(F.when(upward, F.col("n")).otherwise(0)).alias("up"), F.sum(F.when(upward, 0).otherwise(F.col("n"))).alias("down"))
    most = F.greatest("up", "down")
    clear = both.where((most >= min_support) & (most >= min_majority * (F.col("up") + F.col("down"))) & (F.col("up") != F.col("down")))
    edges = clear.select("attribute", F.when(F.col("up") > F.col("down"), F.col("low")).otherwise(F.col("high")).alias("earlier"), F.when(F.col("up") > F.col("down"), F.col("high")).otherwise(F.col("low")).alias("later"))
    net = edges.select("attribute", F.col("earlier").alias("value"), F.lit(-1).alias("x")).union(edges.select("attribute", "later", F.lit(1))).groupBy("attribute", "value").agg(F.sum("x").alias("net"))
    ends = edges.join(net.select("attribute", F.col("value").alias("earlier"), F.col("net").alias("a")), ["attribute", "earlier"]).join(net.select("attribute", F.col("value").alias("later"), F.col("net").alias("b")), ["attribute", "later"])
    reach = cut_lineage(ends.where("a < b").select("attribute", "earlier", "later"), "precedence")
    size = reach.count()
    while size:
        # Paths double in length every round, so a chain of values of any length needs few of them.
        further = reach.select("attribute", "earlier", F.col("later").alias("middle")).join(reach.select("attribute", F.col("earlier").alias("middle"), "later"), ["attribute", "middle"]).select("attribute", "earlier", "later")
        following = cut_lineage(reach.union(further).distinct(), "precedence")
        before, size = size, following.count()
        release(reach)
        reach = following
        if size == before:
            break
    return reach


def overtaken(candidates: DataFrame, values: DataFrame, reach: DataFrame) -> DataFrame:
    """(group_key, field, id, behind): in how many attributes another candidate of the field has a later value.

    Works on the different values of a group's candidates and what they lead to, never on pairs of members.
    """
    held = candidates.select("group_key", "field", "id").join(values.where("value is not null").select("group_key", "id", "attribute", "value"), ["group_key", "id"])
    present = held.select("group_key", "field", "attribute", "value").distinct()
    leads = present.join(reach.withColumnRenamed("earlier", "value"), ["attribute", "value"])
    behind = leads.join(present.withColumnRenamed("value", "later"), ["group_key", "field", "attribute", "later"], "left_semi").select("group_key", "field", "attribute", "value").distinct()
    return held.join(behind, ["group_key", "field", "attribute", "value"], "left_semi").groupBy("group_key", "field", "id").agg(F.count("*").alias("behind"))


def best_representatives(
    df: DataFrame,
    sources: DataFrame,
    id_col: str = "id",
    group_col: str = "fingerprint",
    text_col: str = "content",
    date_col: str = "published_date",
    source_col: str = "source",
    attributes: tuple[str, ...] = ("source", "lang"),
    min_support: int = MIN_SUPPORT,
) -> DataFrame:
    """One row for each group of two or more different ids: the member that gives each field of the survivor.

    Columns: fingerprint (lower-cased), content_id (longest text), date_id (latest instant), source_id (most trusted
    source) and current_id (topologically latest member, also without timestamps). A member without a value cannot
    be chosen for it; a field that no member has is NULL. Among members equal in a field, those overtaken by another
    one's value in fewest `attributes` come first, then those with an instant, then the larger id; values of which
    neither leads to the other do not order their members. Null or blank groups and null ids take no part, repeated
    rows count once (of different values of one id the largest; of different instants none), attributes that the table
    lacks are left out, extra columns are ignored, an empty table gives an empty result.
    """
    text: Column = F.col(text_col)
    no_text = text.isNull() | F.trim(F.lower(text)).isin("", "none", "nan")
    known = [a for a in attributes if a in df.columns]
    rows = df.where(F.col(id_col).isNotNull() & (F.trim(group_col) != "")).select(
        F.col(id_col).cast("string").alias("id"), F.lower(F.trim(group_col)).alias("group_key"), F.when(~no_text, F.length(text)).alias("chars"),
        F.col(source_col).alias("source"), F.col(date_col).alias("published"), *[F.nullif(F.trim(F.col(a).cast("string")), F.lit("")).alias(f"value_{i}") for i, a in enumerate(known)],
    )
    rows = rows.groupBy("id", "group_key", "published", "source").agg(F.max("chars").alias("chars"), *[F.max(f"value_{i}").alias(f"value_{i}") for i in range(len(known))])
    # Two different ids differ in the smallest and the largest one, so no set of ids is kept.
    groups = rows.groupBy("group_key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select("group_key")
    rows = cut_lineage(rows.join(groups, "group_key", "left_semi"), "members")
    instants = normalise_timestamps(rows, sources, "id", "published", "source")
    trust = sources.where("source is not null").groupBy("source").agg(F.max("trust").alias("trust"))
    members = rows.join(trust, "source", "left").groupBy("group_key", "id").agg(F.max("chars").alias("chars"), F.max("trust").alias("trust"), *[F.max(f"value_{i}").alias(f"value_{i}") for i in range(len(known))])
    members = cut_lineage(members.join(instants, "id", "left"), "members")
    release(rows)
    long = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(f"value_{i}").alias("value")) for i, a in enumerate(known)]) if known else F.array().cast("array<struct<attribute:string,value:string>>")
    values = members.select("group_key", "id", "epoch_us", F.explode(long).alias("x")).select("group_key", "id", "epoch_us", "x.attribute", "x.value")
    reach = learn_precedence(values, min_support)

    top = members.groupBy("group_key").agg(F.max("chars").alias("top_chars"), F.max("epoch_us").alias("top_epoch"), F.max("trust").alias("top_trust"))
    joined = members.join(top, "group_key")
    # Of the dated members only the latest can be current; an undated one can, unless a value of the others follows its own.
    fields = {"content": F.col("chars") == F.col("top_chars"), "date": F.col("epoch_us") == F.col("top_epoch"), "source": F.col("trust") == F.col("top_trust"), "current": F.col("epoch_us").isNull() | (F.col("epoch_us") == F.col("top_epoch"))}
    named = F.filter(F.array(*[F.when(test, F.lit(name)) for name, test in fields.items()]), lambda x: x.isNotNull())
    candidates = cut_lineage(joined.select("group_key", "id", F.col("epoch_us").isNotNull().alias("dated"), F.explode(named).alias("field")), "candidates")
    ranked = candidates.join(overtaken(candidates, values, reach), ["group_key", "field", "id"], "left")
    place = F.struct(-F.coalesce("behind", F.lit(0)), F.col("dated"), F.col("id"))
    return ranked.groupBy(F.col("group_key").alias("fingerprint")).agg(*[F.max_by("id", F.when(F.col("field") == name, place)).alias(f"{name}_id") for name in fields])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = best_representatives(read_table(spark, sf_dir, "articles"), read_table(spark, sf_dir, "sources"))
    return found.select("fingerprint", "content_id", "date_id", "source_id")


def p5_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topologically latest member of each group, also where timestamps are missing."""
    return best_representatives(read_table(spark, sf_dir, "articles"), read_table(spark, sf_dir, "sources")).select("fingerprint", "current_id")
