"""User profiles: centres from signals, updated by an exponential moving average in order of time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswerk.operators.indexing import embed

ALPHA = 0.9


def ema_step(centre: np.ndarray, weight: float, vec: np.ndarray, signal: float, alpha: float = ALPHA) -> tuple[np.ndarray, float]:
    """The centre moves by 1 - (1 - alpha) x signal held in [0.1, 1]; its weight decays by five per cent."""
    s = min(1.0, max(0.1, signal))
    beta = 1 - (1 - alpha) * s
    moved = beta * centre + (1 - beta) * vec
    norm = np.linalg.norm(moved)
    return (moved / norm if norm > 0 else moved), 0.95 * weight + 0.05 * signal


def fold_profiles(signals: DataFrame) -> DataFrame:
    """(user_id, n, weight, centre) from signals (user_id, ts, event_id, signal, vec), each user's in order of time.

    A step mixes the normalised centre with the next vector, so the steps of one user follow one another; users are
    streamed in order, one state at a time, and no user's history is held in memory.
    """

    def fold(batches):
        user, n, centre, weight = None, 0, None, 1.0

        def row():
            return pa.RecordBatch.from_arrays([pa.array([user], pa.int64()), pa.array([n], pa.int64()), pa.array([weight]), pa.array([centre.tolist()], pa.list_(pa.float64()))], names=["user_id", "n", "weight", "centre"])

        for batch in batches:
            users, strengths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            lists = batch.column(2)
            flat, offsets = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            for k, (who, strength) in enumerate(zip(users, strengths, strict=True)):
                vec = flat[offsets[k] : offsets[k + 1]]
                if who != user:
                    if user is not None:
                        yield row()
                    user, n, centre, weight = who, 1, vec, 1.0
                else:
                    n += 1
                    centre, weight = ema_step(centre, weight, vec, strength)
        if user is not None:
            yield row()

    rows = signals.where("user_id is not null and vec is not null").repartition("user_id").sortWithinPartitions("user_id", "ts", "event_id")
    return rows.select(F.col("user_id").cast("long"), F.col("signal").cast("double"), "vec").mapInArrow(fold, "user_id long, n long, weight double, centre array<double>")


def onboarding(interests: DataFrame, embedder, k_max: int = 5) -> DataFrame:
    """(user_id, centre_no, text, weight, vec): a centre for each of a user's first `k_max` phrases, or for a general one.

    interests (user_id, phrases): blank phrases are left out; a user without any gets "general news".
    """
    phrases = F.slice(F.filter(F.transform(F.coalesce("phrases", F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != ""), 1, k_max)
    named = interests.select("user_id", F.when(F.size(phrases) > 0, phrases).otherwise(F.array(F.lit("general news"))).alias("p"))
    rows = named.select("user_id", F.posexplode("p").alias("centre_no", "text")).withColumn("key", F.concat_ws("#", F.col("user_id").cast("string"), F.col("centre_no").cast("string")))
    return rows.join(embed(rows, embedder, "key", "text").withColumnRenamed("id", "key"), "key").select("user_id", "centre_no", "text", F.lit(1.0).alias("weight"), "vec")


def query_text(interests: DataFrame) -> DataFrame:
    """(user_id, text): a user's phrases and tags in one query, interests (user_id, phrases, tags)."""
    joined = F.concat_ws(" ; ", F.array_join("phrases", " ; "), F.array_join("tags", " ; "))
    return interests.select("user_id", joined.alias("text"))
