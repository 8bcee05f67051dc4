"""Session options, the shared scratch folder, staging and caching."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Collection, Iterator, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tallyfold.sources.curated import read_bucketed, save_buckets

SESSION_OPTIONS = {
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join keys also where a later step then has to shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def set_options(spark: SparkSession, options: Mapping[str, str] = SESSION_OPTIONS) -> None:
    for key, value in options.items():
        spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without
    that setting gets a folder of its own.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="tallyfold-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared)
    return shared.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame to the shared folder once and read it back.

    For results with several consumers: each one then scans only the columns it
    needs, and a lost executor costs a re-read instead of the whole lineage.
    """
    return _written(df, scratch_path(df.sparkSession, name))


def remove_path(spark: SparkSession, path: str, keep: Collection[str] = ()) -> list[str]:
    """Delete a folder of whatever store Spark reaches; with `keep` only its other children.

    Returns the paths that were deleted.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    gone = [folder]
    if keep:
        gone = [x.getPath() for x in files.listStatus(folder) if x.getPath().getName() not in keep]
    return [x.toString() for x in gone if files.delete(x, True)]


class Staged:
    """Stages tables and deletes them together once their readers are done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.tables = spark, [], []

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        return _written(df, path)

    def stage_by(self, df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
        """Stage in buckets of `key`; groups by it and by other columns then need no exchange.

        A `df` that was repartitioned by the key to that number is not shuffled again.
        """
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        table = path.rpartition("/")[2].replace("-", "_")
        self.tables.append(table)
        save_buckets(df, path, table, key, buckets)
        return read_bucketed(self.spark, table)

    def release(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS `{table}`")
        self.tables.clear()
        for path in self.paths:
            remove_path(self.spark, path)
        self.paths.clear()


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    scratch_root(df.sparkSession)
    return df.checkpoint()


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a DataFrame for the consumers inside the block, then release it."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def release_all(spark: SparkSession) -> None:
    spark.catalog.clearCache()
