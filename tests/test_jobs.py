"""Warehouse jobs end to end: landed files, dimensions, fact, second load."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from listenhouse.plans.jobs import landed_listens, load_dimensions, load_fact, load_warehouse
from listenhouse.sinks.store import Store
from listenhouse.sinks.tables import append_new, overwrite, write_by_hour, write_table
from listenhouse.sources import testdata
from listenhouse.sources.tables import read_table, register, table_exists
from listenhouse.streaming.ingest import parse_events

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def landed(spark, folder):
    messages = testdata.messages(spark, SF_DIR).where("topic = 'listen_events'")
    parse_events(messages, "listen_events").write.parquet(f"{folder}/landed")
    return f"{folder}/landed"


def test_load_twice_appends_nothing(spark, folder, landed):
    first = load_warehouse(spark, landed, f"{folder}/wh")
    assert first["fact_streams"] == 600 and first["dim_user"] == 15
    assert first["dim_datetime"] == 43_848
    second = load_warehouse(spark, landed, f"{folder}/wh")
    merged = ("dim_datetime", "dim_user", "dim_user_history", "dim_session")
    assert {k: v for k, v in second.items() if k not in merged} == {k: 0 for k in second if k not in merged}
    fact = spark.read.parquet(f"{folder}/wh/fact_streams")
    assert fact.count() == 600 and "event_date" in fact.columns
    keys = ["UserKey", "ArtistKey", "SongKey", "DateKey", "LocationKey", "SessionKey"]
    assert fact.dropna(subset=keys).count() == 600


def test_unmatched_facts_are_not_loaded_again(spark, folder, landed):
    """Null keys: events whose dimensions are missing."""
    events = landed_listens(spark, landed)
    load_dimensions(spark, events.where("ts < '2024-01-02'"), f"{folder}/wh")
    assert load_fact(spark, events, f"{folder}/wh") == 600
    assert load_fact(spark, events, f"{folder}/wh") == 0
    fact = spark.read.parquet(f"{folder}/wh/fact_streams")
    assert fact.where("SongKey is null").count() > 0


def test_two_loads_equal_one(spark, folder, landed):
    """Whole rows of every table, whether the events come in one load or in two."""
    events = landed_listens(spark, landed)
    early = F.col("ts") < "2024-01-10 11:00:00"
    for name, parts in (("one", [events]), ("two", [events.where(early), events])):
        for part in parts:
            load_dimensions(spark, part, f"{folder}/{name}")
            load_fact(spark, part, f"{folder}/{name}")
    for table in ("dim_user", "dim_session", "dim_song", "dim_artist", "dim_location", "fact_streams"):
        rows = [Store(spark, f"{folder}/{name}").read(table) for name in ("one", "two")]
        assert Counter(map(tuple, rows[0].collect())) == Counter(map(tuple, rows[1].select(rows[0].columns).collect()))
    with pytest.raises(ValueError):
        load_fact(spark, events.where(~early), f"{folder}/two")


def test_fact_is_the_same_under_skew(spark, folder, landed):
    events = landed_listens(spark, landed)
    load_dimensions(spark, events, f"{folder}/a")
    load_dimensions(spark, events, f"{folder}/b")
    load_fact(spark, events, f"{folder}/a")
    load_fact(spark, events, f"{folder}/b", rows_per_task=10)
    rows = lambda d: Counter(map(tuple, spark.read.parquet(f"{folder}/{d}/fact_streams").collect()))
    assert rows("a") == rows("b")


def test_partition_by_hour(spark, folder, landed):
    events = landed_listens(spark, landed).withColumnRenamed("ts", "Timestamp")
    assert write_by_hour(events, f"{folder}/h", granularity="hour") == 600
    back = spark.read.parquet(f"{folder}/h")
    hours = events.select(F.date_trunc("hour", "Timestamp").alias("h")).distinct().count()
    assert back.select("event_hour").distinct().count() == hours
    pruned = back.where(F.col("event_hour") == F.lit("2024-01-02 15:00:00").cast("timestamp"))
    assert "PartitionFilters: [isnotnull(event_hour" in pruned._jdf.queryExecution().toString()


def test_tables(spark, folder):
    df = spark.range(5).withColumnRenamed("id", "k")
    path = f"{folder}/t"
    assert not table_exists(spark, path, "parquet") and not table_exists(spark, "no_such_table")
    assert append_new(df, path, ["k"]) == 5
    assert table_exists(spark, path, "parquet")
    assert append_new(spark.range(3, 8).withColumnRenamed("id", "k"), path, ["k"]) == 3
    assert write_table(df, path, "overwrite", "parquet") == 5
    register({"five": df}, prefix="v_")
    assert read_table(spark, "v_five").count() == 5 and table_exists(spark, "v_five")
    with pytest.raises(Exception):
        table_exists(spark, "x", "no_such_format")


def test_command_line(spark, folder):
    """Ingest from files, then load; twice."""
    from listenhouse.__main__ import main

    messages = testdata.messages(spark, SF_DIR).where("topic = 'listen_events'")
    messages.select("value").write.text(f"{folder}/in/listen_events")
    for _ in range(2):
        main(["ingest", f"{folder}/out", "--files", f"{folder}/in", "--once",
              "--topics", "listen_events"])
        main(["load", f"{folder}/out/listen_events", f"{folder}/wh"])
    assert spark.read.parquet(f"{folder}/wh/fact_streams").count() == 600


def test_model_as_table_or_view(spark, folder):
    """A model rebuilt in full, as a table and as a view."""
    df = spark.range(4)
    for _ in range(2):
        assert overwrite(df, "model_table", format=None, path=f"{folder}/m") == 4
    assert read_table(spark, "model_table").count() == 4
    register({"model_view": read_table(spark, "model_table").where("id > 1")})
    assert spark.table("model_view").count() == 2
    spark.sql("DROP TABLE model_table")
