"""Session helpers: table loading and lineage cuts in the shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, SparkSession] = {}
_own_folder: list[str] = []


def build_session(master: str = "local[4]", shuffle_partitions: int = 8, memory: str = "4g") -> SparkSession:
    """A session with the settings the engine is tested under (UTC, AQE, Arrow)."""
    return (
        SparkSession.builder.master(master)
        .appName("presswerk")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); only a local session may go without and gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _own_folder:
            _own_folder.append("file://" + tempfile.mkdtemp(prefix="presswerk-"))
        folder = _own_folder[0]
    return folder.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of `path`, and the path as it takes it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back.

    The table survives lost executors and is columnar, so later reads are pruned to the columns they use.
    It is removed by `release`, or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(keep_until_end(spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def keep_until_end(spark: SparkSession, path: str) -> str:
    """The path of a table or folder in the shared folder that goes when the driver ends."""
    if not _written:
        atexit.register(_remove_written)
    _written[path] = spark
    return path


def release(*tables: DataFrame) -> None:
    """Remove tables written by `cut_lineage` that nothing reads any more."""
    for table in tables:
        _remove(table._written_path)


def _remove(path: str) -> None:
    spark = _written.pop(path, None)
    if spark is None:
        return
    try:
        system, target = file_system(spark, path)
        system.delete(target, True)
    except Exception:  # noqa: BLE001 - the session may be gone by now
        local = path.removeprefix("file://")
        if local.startswith("/"):
            shutil.rmtree(local, ignore_errors=True)


def _remove_written() -> None:
    for path in list(_written):
        _remove(path)


def spread(df: DataFrame) -> DataFrame:
    """`df` over all cores, if its files give fewer tasks than there are; large inputs are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
