"""A stream of events into the warehouse, one load per micro-batch.

Every micro-batch is landed in a folder of its own id, and then the warehouse jobs run for the days of
the batch. A batch that is delivered again, after a crash or by a replay, replaces its own folder, and
the jobs bring the tables to the state of what is landed: the result is that of one load of everything.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import LongType

from listenhouse.plans.jobs import days_of, load_dimensions, load_fact, with_row_hash
from listenhouse.schemas import landed_schema
from listenhouse.sinks.store import Store

BATCH = "batch"
_PARTS = ("year", "month", "day")


def landed_batches(spark: SparkSession, landed: str) -> DataFrame:
    """All events of the batches landed so far."""
    schema = landed_schema("listen_events")
    rows = spark.read.schema(schema.add(BATCH, LongType())).option("basePath", landed).parquet(f"{landed}/{BATCH}=*")
    return with_row_hash(rows.drop(BATCH))


def load_batch(events: DataFrame, batch_id: int, landed: str, store: Store, **options) -> dict[str, int]:
    """Land one batch and load it; rows written by table. Loading a batch again changes nothing."""
    spark = events.sparkSession
    path = f"{landed}/{BATCH}={batch_id}"
    events.write.mode("overwrite").partitionBy(*_PARTS).parquet(path)
    batch = spark.read.schema(landed_schema("listen_events")).parquet(path)
    days = days_of(batch)
    if not days:
        return {}
    algo = options.pop("algo", "exact")
    known = landed_batches(spark, landed)
    written = load_dimensions(spark, with_row_hash(batch), store, algo, landed=known)
    written["fact_streams"] = load_fact(spark, known, store, days=days, algo=algo, **options)
    return written


def load_stream(
    events: DataFrame, landed: str, store: Store, checkpoint: str, trigger: str | None = "120 seconds",
    loaded: Callable[[int, dict[str, int]], None] | None = None, **options,
) -> DataStreamWriter:
    """Load a stream of parsed listen events; ``trigger=None`` reads all there is and stops. ``loaded`` is told of each batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        written = load_batch(batch, batch_id, landed, store, **options)
        if loaded:
            loaded(batch_id, written)

    writer = events.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
