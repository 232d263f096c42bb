"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listenhouse.session import scratch_path


#: Whether shuffle files go at the end of an execution.
_CLEANS = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    That cuts the lineage and survives lost executors. The shuffle files of the write go when it has ended: nothing
    reads them again. The table goes with ``drop``, or when the
    driver's file system closes, as results that are not yet computed read it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    cleans = spark.conf.get(_CLEANS)
    spark.conf.set(_CLEANS, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANS, cleans)
    delete_on_exit(spark, path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def drop(*staged: DataFrame) -> None:
    """Delete what ``stage`` has written; nothing that is still to be computed may read it."""
    for df in staged:
        path, system = _located(df.sparkSession, df._staged_at)
        system.delete(path, True)
        system.cancelDeleteOnExit(path)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """A folder that goes when the driver's file system closes."""
    target, system = _located(spark, path)
    system.deleteOnExit(target)


def _located(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session sets them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
