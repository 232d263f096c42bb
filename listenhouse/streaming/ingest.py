"""Topics to partitioned files.

``parse_events`` is one DataFrame function; it runs unchanged on a batch read
and on a stream, and over any source that delivers a ``value`` column.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from listenhouse.functions.text import repair_text
from listenhouse.functions.time import from_epoch_millis, time_parts
from listenhouse.schemas import REPAIRED, TIME_PARTS, TOPICS, message_schema

RAW = "_raw"


def read_kafka_stream(
    spark: SparkSession, address: str, port: int | str, topic: str,
    starting_offsets: str = "earliest", fail_on_data_loss: bool = True, **options: str,
) -> DataFrame:
    """A topic as a stream (needs the public Kafka connector on the class path)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", f"{address}:{port}")
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .options(**options)
        .load()
    )


def read_file_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A folder of JSON-lines files as a stream of ``value``."""
    return spark.readStream.format("text").options(**options).load(path)


def parse_events(messages: DataFrame, topic: str, on_bad: str = "null") -> DataFrame:
    """Messages to typed events with time parts and repaired names.

    A message that is no JSON object gives a row of nulls (``null``), no row
    (``drop``), or a row of nulls with the text in ``_raw`` (``quarantine``).
    A field of the wrong type is null; the others are kept.
    """
    if on_bad not in ("null", "drop", "quarantine"):
        raise ValueError(f"unknown on_bad: {on_bad}")
    schema = message_schema(topic)
    text = F.col("value").cast("string")
    rows = messages.select(F.from_json(text, schema).alias("data"), text.alias(RAW))
    bad = F.coalesce(*[F.col(f"data.{f.name}").cast("string") for f in schema]).isNull()
    if on_bad == "drop":
        rows = rows.where(~bad)
    raw = [F.when(bad, F.col(RAW)).alias(RAW)] if on_bad == "quarantine" else []
    events = rows.select("data.*", *raw).withColumn("ts", from_epoch_millis("ts"))
    repaired = {c: repair_text(c) for c in REPAIRED.get(topic, ())}
    return events.withColumns({**time_parts("ts"), **repaired})


def write_files(
    stream: DataFrame, path: str, checkpoint: str, trigger: str | None = "120 seconds",
    output_mode: str = "append", format: str = "parquet",
    partition_by: Iterable[str] = TIME_PARTS,
) -> DataStreamWriter:
    """File sink; ``trigger=None`` reads all there is and stops.

    Rows land in folders by time part unless ``partition_by`` is empty.
    """
    writer = (
        stream.writeStream.format(format)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
    )
    columns = list(partition_by)
    if columns:
        writer = writer.partitionBy(*columns)
    if trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def start_ingest(
    streams: Mapping[str, DataFrame], out_dir: str, trigger: str | None = "120 seconds",
    on_bad: str = "null", partition_by: Iterable[str] = TIME_PARTS,
) -> dict[str, StreamingQuery]:
    """One query per topic: parse, repair, land under ``out_dir/<topic>``."""
    unknown = set(streams) - set(TOPICS)
    if unknown:
        raise ValueError(f"unknown topics: {sorted(unknown)}")
    queries = {}
    try:
        for topic, messages in streams.items():
            events = parse_events(messages, topic, on_bad)
            writer = write_files(
                events, f"{out_dir}/{topic}", f"{out_dir}/checkpoint/{topic}", trigger,
                partition_by=partition_by,
            )
            queries[topic] = writer.queryName(topic).start()
    except BaseException:
        _stop(queries)
        raise
    return queries


def supervise(spark: SparkSession, queries: Mapping[str, StreamingQuery]) -> None:
    """Wait until one query ends. If it failed, stop the others and raise."""
    spark.streams.resetTerminated()
    try:
        if all(q.isActive for q in queries.values()):
            spark.streams.awaitAnyTermination()
        for q in queries.values():
            if q.exception():
                raise q.exception()
    except BaseException:
        _stop(queries)
        raise


def drain(queries: Mapping[str, StreamingQuery]) -> None:
    """Wait for queries that stop by themselves (``trigger=None``); if one fails, stop the others and raise."""
    try:
        for q in queries.values():
            q.awaitTermination()
    except BaseException:
        _stop(queries)
        raise


def _stop(queries: Mapping[str, StreamingQuery]) -> None:
    for q in queries.values():
        q.stop()
