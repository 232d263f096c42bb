"""Bounded export of several topics to one CSV folder per topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from listenhouse.schemas import TOPICS, message_schema
from listenhouse.session import scratch_path

BUCKETS = 10_000         # counts per pass that reach the driver
SMALL_RANGE = 1_000_000  # rows that may be sorted at the end


def read_kafka_batch(
    spark: SparkSession, address: str, port: int | str, topics: Sequence[str] = tuple(TOPICS),
    starting_offsets: str = "earliest", ending_offsets: str = "latest",
) -> DataFrame:
    """What several topics hold now, as a batch."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", f"{address}:{port}")
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
        .option("endingOffsets", ending_offsets)
        .load()
    )


def bounded(
    messages: DataFrame, order: Sequence[str], listens: int,
    buckets: int = BUCKETS, small: int = SMALL_RANGE,
) -> DataFrame:
    """All messages up to the ``listens``-th listen event in ``order``.

    The bound is the operator's purpose. Its place is found by counting: each
    pass counts the listens in equal ranges of the first order column, and the
    range that holds the wanted one is counted again, finer. Only counts, at
    most ``buckets`` per pass, reach the driver; rows are sorted only in the
    last, small range. With fewer listens than asked for, all messages stay.
    """
    first = F.unix_micros(order[0]) if _is_time(messages, order[0]) else F.col(order[0])
    rows = messages.where(F.col("topic") == "listen_events").select(
        first.cast("bigint").alias("at"), F.struct(*order).alias("position")
    )
    low, high, count = rows.agg(F.min("at"), F.max("at"), F.count("at")).first()
    if count < listens:
        return messages
    missing = listens
    while low < high and count > small:
        width = -(-(high - low + 1) // buckets)
        ranges = rows.where(F.col("at").between(low, high)).groupBy(
            F.floor((F.col("at") - low) / width).alias("bucket")
        ).count().orderBy("bucket").collect()
        for bucket, count in ranges:  # noqa: B007 - the last values are used
            if missing <= count:
                break
            missing -= count
        low += bucket * width
        high = min(high, low + width - 1)
    stop = (
        rows.where(F.col("at").between(low, high))
        .orderBy("position").limit(missing).agg(F.max("position"))
    ).scalar()
    return messages.where(F.struct(*order) <= stop)


def _is_time(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.TimestampType)


def export_topics(
    messages: DataFrame, out_dir: str, order: Sequence[str],
    listens: int | None = None, topics: Sequence[str] = tuple(TOPICS),
) -> None:
    """One CSV folder per topic, as sent: `ts` stays in milliseconds.

    All messages, or those up to the ``listens``-th listen event.

    The messages are read once, into a staging table by topic. The counting
    passes and the topics then all see the same messages, and each topic reads
    only its own folder.
    """
    spark = messages.sparkSession
    stage = scratch_path(spark, "messages")
    text = F.col("value").cast("string")
    messages.select("topic", *order, text.alias("value")).write.partitionBy("topic").parquet(stage)
    staged = spark.read.parquet(stage)
    kept = staged if listens is None else bounded(staged, order, listens)
    for topic in topics:
        rows = kept.where(F.col("topic") == topic)
        parsed = rows.select(F.from_json("value", message_schema(topic)).alias("d")).select("d.*")
        parsed.write.mode("overwrite").option("header", True).csv(f"{out_dir}/{topic}")
