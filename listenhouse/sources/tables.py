"""Batch scans of landed events and warehouse tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from listenhouse.schemas import landed_schema, project_schema


def read_events(
    spark: SparkSession, path: str, topic: str = "listen_events",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Landed Parquet events; ``columns`` limits the read schema."""
    schema = landed_schema(topic)
    if columns is not None:
        schema = project_schema(schema, columns)
    # Partition columns come in addition to the read schema; leave them out.
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_table(spark: SparkSession, name: str, format: str | None = None, **options: str) -> DataFrame:
    """A warehouse table: a catalog name, a path, or any installed connector.

    ``read_table(spark, "dim_user")``, ``read_table(spark, "/wh/dim_user",
    format="parquet")``, ``read_table(spark, "ds.dim_user",
    format="<connector>", option=...)``.
    """
    if format is None:
        return spark.table(name)
    if format in ("parquet", "orc", "json", "csv"):
        return spark.read.format(format).options(**options).load(name)
    return spark.read.format(format).options(table=name, **options).load()


def table_exists(spark: SparkSession, name: str, format: str | None = None, missing: str = "", **options: str) -> bool:
    """Whether a target is there. Only 'not found' means no; any other error
    (rights, network) is raised rather than taken for a missing table. ``missing``: a pattern
    of the message by which a connector says it."""
    if format is None:
        return spark.catalog.tableExists(name)
    try:
        read_table(spark, name, format, **options)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND",
                                    "UNABLE_TO_INFER_SCHEMA"):
            return False
        if missing and re.search(missing, str(error)):
            return False
        raise
    return True


def register(frames: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Name frames as views, so SQL models can refer to sources and to each other."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
