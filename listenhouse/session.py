"""Session factory and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants, whatever the cluster size. Partition counts and
# memory belong to the cluster and are left to spark-submit.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(app_name: str, master: str | None = "yarn", **conf: str) -> SparkSession:
    """Get or create a session; ``master=None`` leaves it to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app_name: str = "listenhouse", cores: int | str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    local = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **conf,
    }
    spark = get_session(app_name, f"local[{cores}]", **local)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@lru_cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="run-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder; on a cluster
    a machine-local folder would lose data, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder(context.applicationId)


_SCRATCH: set[str] = set()


def _scratch_folder(spark: SparkSession) -> str:
    """One folder per application, which goes when the driver ends."""
    path = f"{shared_dir(spark)}/scratch-{spark.sparkContext.applicationId}"
    if path not in _SCRATCH:
        target, system = located(spark, path)
        system.mkdirs(target)
        system.deleteOnExit(target)
        _SCRATCH.add(path)
    return path


def located(spark: SparkSession, path: str):
    """A path and its file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, for a table that is not needed once the application has ended."""
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function that writes a table to the shared folder and reads it back; all of them go at the end of the block."""
    paths = []

    def stage(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch_path(spark, name))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield stage
    finally:
        for path in paths:
            target, system = located(spark, path)
            system.delete(target, True)
