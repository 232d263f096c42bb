"""Fewer, larger files in the partitions of a Parquet table.

Streams land a file per task, hour and micro-batch. Compaction looks at the sizes of the files, packs those
of a partition into as few as their bytes need, and swaps each partition that gets fewer. Only its rows are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from listenhouse.session import located, staging

TARGET_BYTES = 256 << 20


def file_sizes(spark: SparkSession, path: str, partition_by: Sequence[str]) -> DataFrame:
    """(partition columns as text, file, bytes) of every data file; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    value = lambda c: F.url_decode(F.regexp_extract("path", f"/{c}=([^/]*)/", 1)).alias(c)
    return files.select(*[value(c) for c in partition_by], F.col("path").alias("file"), F.col("length").alias("bytes"))


def plan(sizes: DataFrame, partition_by: Sequence[str], target: int) -> DataFrame:
    """Partitions that can do with fewer files: their columns, files now and bins then."""
    bins = F.ceil(F.sum("bytes") / target).cast("int")
    return sizes.groupBy(*partition_by).agg(F.count("*").alias("files"), F.greatest(bins, F.lit(1)).alias("bins")).where("files > bins")


def compact(spark: SparkSession, path: str, partition_by: Sequence[str], target: int = TARGET_BYTES, only: Column | None = None) -> int:
    """Compact a table partitioned by ``partition_by``; the number of partitions that were swapped.

    ``only``: which partitions (as text columns) may be touched, such as hours that are closed. The rows of a partition go to its
    bins at random, so that files are of equal size; a task writes one bin. A folder that a stream still writes keeps a log of its files, which a swap would make wrong: such a
    folder is refused.
    """
    log, system = located(spark, f"{path}/_spark_metadata")
    if system.exists(log):
        raise ValueError(f"{path} belongs to a stream; copy closed partitions to a table first")
    todo = plan(file_sizes(spark, path, partition_by), partition_by, target)
    todo = todo if only is None else todo.where(only)
    with staging(spark) as stage:
        todo = stage(todo, "compact")
        n, total = todo.agg(F.count("*"), F.sum("bins")).first()
        if not n:
            return 0
        table = spark.read.parquet(path)
        text = lambda c: F.when(F.col(c).isNull(), "__HIVE_DEFAULT_PARTITION__").otherwise(F.col(c).cast("string"))
        same = F.lit(True)
        for c in partition_by:
            same &= text(c) == F.col(f"__todo.{c}")
        # Bins are numbered through; there is a row per partition to be swapped.
        first = F.sum("bins").over(Window.orderBy(*partition_by).rowsBetween(Window.unboundedPreceding, -1))
        chosen = stage(todo.withColumn("first", F.coalesce(first, F.lit(0)).cast("int")), "bins")
        chosen = chosen.select(F.struct(*partition_by).alias("__todo"), F.col("bins").alias("__bins"), F.col("first").alias("__first"))
        bin_of = (F.col("__first") + F.floor(F.rand(7) * F.col("__bins"))).cast("int")
        rows = table.join(chosen, same).withColumn("__bin", bin_of).repartitionById(int(total), "__bin")
        # The old files are read until the new ones are complete, and go when these are put in place.
        swapped = rows.drop("__todo", "__bins", "__first", "__bin").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        swapped.partitionBy(*partition_by).parquet(path)
    return n
