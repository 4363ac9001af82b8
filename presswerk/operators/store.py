"""Keyed tables and the run ledger as plans: last write wins, runs are partitions."""

from __future__ import annotations

import json
import random
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from presswerk.session import file_system


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """`existing` with the rows of `incoming` over it; rows with a blank key are left out, the last row of a key wins."""
    ok = None
    for k in keys:
        this = F.col(k).isNotNull() & (F.trim(F.col(k).cast("string")) != "")
        ok = this if ok is None else ok & this
    both = existing.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)), allowMissingColumns=True).where(ok)
    order = [F.col("__new").desc()] + ([F.col("updated_at").desc_nulls_last()] if "updated_at" in both.columns else [])
    w = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*[c for c in both.columns if not c.startswith("__")]))
    return both.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__new", "__r")


def _names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows the prefix in the names of a folder that begin with it."""
    system, target = file_system(spark, path)
    if not system.exists(target):
        return []
    names = [status.getPath().getName() for status in system.listStatus(target)]
    return [n.removeprefix(prefix) for n in names if n.startswith(prefix)]


class KeyedTable:
    """A Parquet table keyed by columns: a write adds one batch of its rows only, a read takes the last row of each key.

    Batches are folders `batch=n`. Writing a batch again replaces it and no other, so a job that is repeated changes
    nothing. `compact` merges them into one; nothing is rewritten before.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys

    def batches(self) -> list[int]:
        return sorted(int(n) for n in _names(self.spark, self.path, "batch="))

    def exists(self) -> bool:
        return bool(self.batches())

    def clear(self) -> None:
        system, target = file_system(self.spark, self.path)
        system.delete(target, True)

    def write(self, rows: DataFrame, number: int | None = None) -> int:
        """Write rows as batch `number`, by default the next one; the number of rows. Rows with a null key are left out."""
        number = max(self.batches(), default=-1) + 1 if number is None else number
        path = f"{self.path}/batch={number}"
        for k in self.keys:
            rows = rows.where(F.col(k).isNotNull())
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path).count()

    def read(self) -> DataFrame:
        found = self.batches()
        rows = self.spark.read.option("mergeSchema", True).option("basePath", self.path).parquet(*[f"{self.path}/batch={n}" for n in found])
        last = Window.partitionBy(*self.keys).orderBy(F.desc("batch"), F.xxhash64(*[c for c in rows.columns if c != "batch"]))
        return rows.withColumn("__r", F.row_number().over(last)).where("__r = 1").drop("__r", "batch")

    def compact(self) -> None:
        """Merge all batches into the last one; no other write may run meanwhile."""
        found = self.batches()
        if len(found) < 2:
            return
        merged = f"{self.path}/_compact-{uuid.uuid4().hex}"  # readers pass over names that begin with an underscore
        self.read().write.parquet(merged)
        system, _ = file_system(self.spark, self.path)
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        last = path(f"{self.path}/batch={found[-1]}")
        system.delete(last, True)
        system.rename(path(merged), last)
        for n in found[:-1]:
            system.delete(path(f"{self.path}/batch={n}"), True)


class RunLedger:
    """Runs of the stages: numbered rows with parameters, and their detail rows.

    Rows written for one run are a partition of their own, those of runs added together share a batch of files; so a run
    costs a folder, and many at once cost no more files than their plan has tasks. Of both the partition counts.
    """

    KINDS = ("retrieval", "dedup", "rerank", "writing")
    RUNS = "id long, kind string, source_run_id long, parameters string, created_at timestamp"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _table(self, kind: str) -> KeyedTable:
        if kind not in self.KINDS:
            raise ValueError(f"no such run: {kind}")
        return KeyedTable(self.spark, f"{self.root}/{kind}_runs", ["id"])

    def _take(self, table: KeyedTable, count: int) -> list[int]:
        """Numbers in a row that no other writer has, taken by one marker file that names the first and the last.

        Only one of several writers can make a marker of a name. Markers that overlap under different names are both
        given up: the later of two is made before its writer looks at the others, so it can't miss the earlier one.
        """
        system, _ = file_system(self.spark, table.path)
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        while True:
            first = max([int(n.split("-")[-1]) for n in _names(self.spark, table.path, "_taken-")] + table.batches(), default=0) + 1
            last = first + count - 1
            name = f"{first}" if count == 1 else f"{first}-{last}"
            if system.createNewFile(path(f"{table.path}/_taken-{name}")):
                others = [n.split("-") for n in _names(self.spark, table.path, "_taken-") if n != name]
                if not any(int(o[0]) <= last and int(o[-1]) >= first for o in others):
                    return list(range(first, last + 1))
            time.sleep(random.random())

    def _put(self, kind: str, sources: list[int | None], parameters: dict | None) -> list[int]:
        """New runs, one for each source in its order, as one batch under the last number."""
        table = self._table(kind)
        numbers = self._take(table, len(sources))
        said = json.dumps(parameters or {}, sort_keys=True, default=str)
        rows = self.spark.createDataFrame([(n, kind, source, said) for n, source in zip(numbers, sources)], self.RUNS.rsplit(",", 1)[0])
        table.write(rows.withColumn("created_at", F.current_timestamp()), numbers[-1])
        return numbers

    def create(self, kind: str, parameters: dict | None = None, source_run_id: int | None = None) -> int:
        """A new run; no other writer gets its number."""
        return self._put(kind, [source_run_id], parameters)[0]

    def add_all(self, kind: str, rows: DataFrame, source_col: str, parameters: dict | None = None) -> list[int]:
        """New runs with their detail rows, one for each value of `source_col` in its order; the numbers of the runs.

        The number of jobs does not depend on the number of runs. Rows without a source are left out.
        """
        sources = sorted(r[0] for r in rows.where(F.col(source_col).isNotNull()).select(source_col).distinct().collect())  # the runs, not their rows
        if not sources:
            return []
        numbers = self._put(kind, sources, parameters)
        runs = self.spark.read.parquet(f"{self._table(kind).path}/batch={numbers[-1]}").select(F.col("id").alias("run_id"), F.col("source_run_id").alias(source_col))
        rows.join(runs, source_col).drop(source_col).write.mode("overwrite").parquet(f"{self.root}/{kind}_batches/batch={numbers[-1]}")
        return numbers

    def runs(self, kind: str) -> DataFrame:
        table = self._table(kind)
        return table.read() if table.exists() else self.spark.createDataFrame([], self.RUNS)

    def write(self, kind: str, run_id: int, rows: DataFrame) -> None:
        """The detail rows of a run; writing them again replaces them."""
        write_hits(rows.withColumn("run_id", F.lit(run_id).cast("long")), f"{self.root}/{kind}_rows", "run_id")

    def rows(self, kind: str, run_id: int | None = None) -> DataFrame:
        alone, together = f"{self.root}/{kind}_rows", f"{self.root}/{kind}_batches"
        own, batches, found = _names(self.spark, alone, "run_id="), _names(self.spark, together, "batch="), []
        if own or not batches:
            found.append(self.spark.read.option("mergeSchema", True).parquet(alone).withColumn("run_id", F.col("run_id").cast("long")))
        if batches:
            added = self.spark.read.option("mergeSchema", True).parquet(together).drop("batch")
            if own:  # written again since
                added = added.join(self.spark.createDataFrame([(int(n),) for n in own], "run_id long"), "run_id", "left_anti")
            found.append(added)
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
        return rows if run_id is None else rows.where(F.col("run_id") == run_id)

    def representative(self, kind: str) -> int | None:
        """The largest of the latest runs of all interests, by which several are quoted together."""
        return latest_runs(self.rows(kind), "run_id").agg(F.max("run_id")).first()[0]


def migrate(df: DataFrame, columns: dict[str, str], defaults: dict[str, object] | None = None) -> DataFrame:
    """`df` with the `columns` (name to type) it lacks added, types cast, and nulls filled by `defaults` (values or columns)."""
    defaults = defaults or {}
    out = []
    for name, kind in columns.items():
        value = F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)
        if name in defaults:
            fill = defaults[name]
            value = F.coalesce(value, (fill if hasattr(fill, "cast") else F.lit(fill)).cast(kind))
        out.append(value.alias(name))
    return df.select(*out, *[c for c in df.columns if c not in columns])


def write_hits(hits: DataFrame, path: str, run_col: str = "run_id") -> None:
    """Hits of runs, one partition each; writing a run again replaces it and no other."""
    hits.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run_col).parquet(path)


def latest_runs(hits: DataFrame, run_col: str = "retrieval_run_id", interest_col: str = "interest") -> DataFrame:
    return hits.groupBy(interest_col).agg(F.max(run_col).alias(run_col))


def blocks(hits: DataFrame, run_col: str, interest_col: str = "interest") -> DataFrame:
    """Nested rendering of a run, one row for each interest with its hits in order; for export only."""
    return hits.groupBy(run_col, interest_col).agg(F.array_sort(F.collect_list(F.struct("rank", "article_id", "score"))).alias("hits")).withColumn("n", F.size("hits"))
