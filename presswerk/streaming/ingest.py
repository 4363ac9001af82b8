"""Incremental ingest and profiles as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswerk.operators.store import KeyedTable
from presswerk.sources.readers import normalise


def ingest_stream(spark: SparkSession, folder: str, schema: str, table: str, checkpoint: str):
    """Files of articles that arrive in `folder` are normalised and added to the keyed table at `table`.

    A micro-batch writes its own rows as a batch of the table and nothing else, so one that is run again replaces
    itself; the table is compacted from time to time by `KeyedTable.compact`, when no stream runs.
    """
    keyed = KeyedTable(spark, table, ["id"])

    def batch(df: DataFrame, number: int) -> None:
        keyed.write(normalise(df), number)

    stream = spark.readStream.schema(schema).json(folder)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, table: str) -> DataFrame:
    return KeyedTable(spark, table, ["id"]).read()


def signal_counts(events: DataFrame, late: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Signals of users by type and event-time window, with late events up to `late`."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return timed.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
