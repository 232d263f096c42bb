"""Parsing, streaming over files, restart, and the bounded export."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from listenhouse.schemas import TOPICS, message_schema
from listenhouse.sources import testdata
from listenhouse.sources.tables import read_events
from listenhouse.streaming.export import bounded, export_topics
from listenhouse.streaming.ingest import (
    drain, parse_events, read_file_stream, start_ingest, supervise,
)

SF_DIR = "/root/testdata/sf0.001"
GOOD = {"ts": 1640995200123, "userId": 7, "song": "Bj\\303\\266rk", "artist": '"q"', "level": "free"}


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_parse(spark):
    row = parse_events(messages(spark, json.dumps(GOOD)), "listen_events").first()
    assert (row.song, row.artist, row.userId) == ("Björk", "q", 7)
    assert (row.year, row.month, row.day, row.hour) == (2022, 1, 1, 0)
    assert row.ts.microsecond == 123000


def test_only_listen_and_page_topics_are_repaired(spark):
    text = json.dumps({"ts": 0, "firstName": "BjÃ¶rk"})
    assert parse_events(messages(spark, text), "auth_events").first().firstName == "BjÃ¶rk"


def test_bytes_parse_like_text(spark):
    raw = messages(spark, json.dumps(GOOD)).select(F.encode("value", "UTF-8").alias("value"))
    assert parse_events(raw, "listen_events").first().userId == 7


@pytest.mark.parametrize("on_bad, n", [("null", 2), ("drop", 1), ("quarantine", 2)])
def test_malformed(spark, on_bad, n):
    rows = parse_events(messages(spark, json.dumps(GOOD), "{bad"), "listen_events", on_bad).collect()
    assert len(rows) == n
    bad = [r for r in rows if r.userId is None]
    assert all(v is None for r in bad for k, v in r.asDict().items() if k != "_raw")
    if on_bad == "quarantine":
        assert {r.userId: r._raw for r in rows} == {7: None, None: "{bad"}


def test_wrong_type_costs_only_the_field(spark):
    text = json.dumps({**GOOD, "userId": "seven"})
    row = parse_events(messages(spark, text), "listen_events", "quarantine").first()
    assert row.userId is None and row.level == "free" and row._raw is None


def test_unknown_arguments(spark):
    with pytest.raises(ValueError):
        parse_events(messages(spark, "{}"), "listen_events", "skip")
    with pytest.raises(ValueError):
        start_ingest({"likes": messages(spark, "{}")}, "/nowhere")


def write_topics(spark, base, part=None):
    rows = testdata.messages(spark, SF_DIR)
    if part is not None:
        rows = rows.where(F.col("position") % 2 == part)
    rows.select("topic", "value").write.mode("append").partitionBy("topic").text(f"{base}/in")


def test_stream_equals_batch_and_restarts(spark, folder):
    write_topics(spark, folder, 0)
    run = lambda: drain(start_ingest(
        {t: read_file_stream(spark, f"{folder}/in/topic={t}") for t in TOPICS},
        f"{folder}/out", trigger=None, partition_by=["year", "month"],
    ))
    run()
    half = spark.read.parquet(f"{folder}/out/listen_events").count()
    run()  # nothing new
    assert spark.read.parquet(f"{folder}/out/listen_events").count() == half
    write_topics(spark, folder, 1)
    run()  # only the new files
    for topic in TOPICS:
        landed = spark.read.parquet(f"{folder}/out/{topic}")
        raw = spark.read.text(f"{folder}/in/topic={topic}")
        batch = parse_events(raw, topic).select(landed.columns)
        assert Counter(map(tuple, landed.collect())) == Counter(map(tuple, batch.collect()))
        assert landed.count() > 0
    narrow = read_events(spark, f"{folder}/out/listen_events", columns=["userId", "ts"])
    assert narrow.columns == ["userId", "ts"] and narrow.count() == 600


def test_one_failing_query_stops_all(spark, folder):
    write_topics(spark, folder, 0)
    streams = {t: read_file_stream(spark, f"{folder}/in/topic={t}") for t in list(TOPICS)[:2]}
    boom = F.when(F.col("value").isNotNull(), F.raise_error(F.lit("boom"))).otherwise("")
    streams["auth_events"] = read_file_stream(
        spark, f"{folder}/in/topic=auth_events"
    ).select(boom.alias("value"))
    queries = start_ingest(streams, f"{folder}/out", trigger="1 second", partition_by=[])
    with pytest.raises(Exception, match="boom"):
        supervise(spark, queries)
    assert not any(q.isActive for q in queries.values())


@pytest.mark.parametrize("listens", [1, 250, 599, 600, 10_000])
@pytest.mark.parametrize("small, buckets", [(1_000_000, 10_000), (3, 7)])
def test_bounded_export(spark, listens, small, buckets):
    rows = testdata.messages(spark, SF_DIR)
    kept = bounded(rows, ["position"], listens, buckets, small)
    positions = sorted(
        r[0] for r in rows.where("topic = 'listen_events'").select("position").collect()
    )
    if listens <= len(positions):
        rows = rows.where(F.col("position") <= positions[listens - 1])
    assert kept.count() == rows.count()


def test_bounded_by_time_with_ties(spark):
    """Many messages at one time: the rest of the order decides."""
    rows = spark.range(500).select(
        F.when(F.col("id") % 5 == 0, "auth_events").otherwise("listen_events").alias("topic"),
        F.timestamp_seconds(F.when(F.col("id") < 400, 7).otherwise(F.col("id"))).alias("timestamp"),
        F.col("id").alias("offset"),
    )
    listens = [i for i in range(500) if i % 5]
    for n in (1, 100, 300, 350, 400):
        kept = bounded(rows, ["timestamp", "offset"], n, buckets=4, small=2)
        assert kept.count() == listens[n - 1] + 1


def test_export_writes_every_topic(spark, folder):
    for listens, expected in ((None, 600), (100, 100)):
        out = f"{folder}/csv-{listens}"
        export_topics(testdata.messages(spark, SF_DIR), out, ["position"], listens)
        for topic in TOPICS:
            rows = spark.read.option("header", True).csv(f"{out}/{topic}")
            assert set(rows.columns) == set(message_schema(topic).names) and rows.count() > 0
        assert spark.read.option("header", True).csv(f"{out}/listen_events").count() == expected
