"""What loads write more than once, and what they send to the driver."""

import threading
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from listenhouse import registry
from listenhouse.functions import time_parts
from listenhouse.plans import jobs
from listenhouse.sinks.store import Store

COLUMNS = (
    "ts TIMESTAMP, userId BIGINT, sessionId BIGINT, itemInSession BIGINT, song STRING, artist STRING, duration DOUBLE, city STRING, zip STRING, "
    "state STRING, lat DOUBLE, lon DOUBLE, firstName STRING, lastName STRING, gender STRING, level STRING, registration BIGINT, userAgent STRING"
)


def listens(spark, n=40):
    """Listens of three users on two days."""
    day = F.col("id") % 2
    rows = spark.range(n).select(
        F.timestamp_seconds(1704067200 + day * 86400 + F.col("id") * 60).alias("ts"), (F.col("id") % 3).alias("userId"),
        (F.col("id") % 3 * 100 + day).alias("sessionId"), F.col("id").alias("itemInSession"), F.concat(F.lit("s"), F.col("id") % 5).alias("song"),
        F.lit("a").alias("artist"), F.lit(20.0).alias("duration"), *[F.lit("x").alias(c) for c in ("city", "zip", "state")],
        *[F.lit(1.0).alias(c) for c in ("lat", "lon")], *[F.lit("x").alias(c) for c in ("firstName", "lastName", "gender", "level")],
        F.lit(1).cast("long").alias("registration"), F.lit("x").alias("userAgent"),
    )
    assert rows.schema.names == [c.split()[0] for c in COLUMNS.split(", ")]
    return jobs.with_row_hash(rows).withColumns(time_parts("ts"))


def test_a_load_of_all_days_stages_no_copy(spark, folder, monkeypatch):
    """Facts and edges are staged only if rows of other days have to be kept with them."""
    names, plain = [], jobs.staging

    @contextmanager
    def watched(session):
        with plain(session) as stage:
            yield lambda df, name: names.append(name) or stage(df, name)

    monkeypatch.setattr(jobs, "staging", watched)
    events, store = listens(spark), Store(spark, folder)
    for days in (None, jobs.days_of(events)):
        jobs.load_dimensions(spark, events, store)
        names.clear()
        jobs.load_fact(spark, events, store, days=days, algo="md5")
        assert not {"facts", "days", "edges"} & set(names), names
    assert store.read("fact_streams").count() == 40 and store.read("fact_edges").count() == 12
    # A day alone: rows of the other one change, so both tables are read while they are replaced.
    more = events.unionByName(events.where("day = 2").withColumns({"ts": F.expr("ts + INTERVAL 1 SECOND"), "itemInSession": F.col("itemInSession") + 100}))
    one = [d for d in jobs.days_of(more) if d.day == 2]
    jobs.load_dimensions(spark, more, store)
    jobs.load_fact(spark, more, store, days=one, algo="md5")
    whole = Store(spark, f"{folder}/whole")
    jobs.load_dimensions(spark, more, whole)
    jobs.load_fact(spark, more, whole, algo="md5")
    for table in ("fact_streams", "fact_edges"):
        assert sorted(map(str, store.read(table).collect())) == sorted(map(str, whole.read(table).collect())), table


def test_dimensions_load_side_by_side(spark):
    """Each waits for the other; one after the other they would not end."""
    meet = threading.Barrier(2, timeout=30)
    assert jobs.at_once(spark, {"a": lambda: meet.wait() * 0 + spark.range(3).count(), "b": lambda: meet.wait() * 0 + spark.range(4).count()}) == {"a": 3, "b": 4}


@pytest.mark.parametrize("name", ["load_fact_twice", "load_warehouse_catalog"])
def test_loads_read_events_that_are_joined_once(spark, monkeypatch, name):
    """Customers and parts are not joined, and so not broadcast, again for every table and load."""
    seen = []
    for job in ("load_dimensions", "load_fact"):
        monkeypatch.setattr(jobs, job, lambda spark, events, *_, **__: seen.append(events))
    monkeypatch.setattr(registry, "_fact_table", lambda store: None)
    registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert len(seen) == 4
    for events in seen:
        text = events._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in text and "customer.parquet" not in text and "part.parquet" not in text
