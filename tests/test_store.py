"""Replacing tables safely, loading by day, and the same jobs on other tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from listenhouse.plans import jobs
from listenhouse.sinks import store as stores
from listenhouse.sinks.store import Store, current_path, in_days, replace_version
from listenhouse.sources import testdata
from listenhouse.functions import time_parts

SF_DIR = "/root/testdata/sf0.001"


def values(df):
    return sorted(r[0] for r in df.collect())


def test_a_killed_job_leaves_the_old_table(spark, folder, monkeypatch):
    store = Store(spark, folder)
    assert store.replace(spark.range(3), "t") == 3
    # Killed while it writes.
    with pytest.raises(Exception):
        store.replace(store.read("t").select(F.raise_error(F.lit("killed")).cast("long").alias("id")), "t")
    assert values(store.read("t")) == [0, 1, 2]
    # Killed between the write and the commit.
    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(stores, "commit_version", killed)
        with pytest.raises(KeyboardInterrupt):
            store.replace(spark.range(9), "t")
    assert values(store.read("t")) == [0, 1, 2]
    # The next one is not held up, and may read the table it replaces.
    reader = store.read("t")
    assert store.replace(store.read("t").where("id > 0"), "t") == 2
    assert values(store.read("t")) == [1, 2] and values(reader) == [0, 1, 2]
    store.replace(spark.range(1), "t")
    assert values(store.read("t")) == [0] and current_path(spark, f"{folder}/t").endswith("/v-5")


def test_two_jobs_cannot_both_commit(spark, folder):
    replace_version(spark.range(1), f"{folder}/t")
    spark.range(5).write.parquet(f"{folder}/t/v-2")
    stores.commit_version(spark, f"{folder}/t", 2)
    with pytest.raises(RuntimeError):
        stores.commit_version(spark, f"{folder}/t", 2)


def test_a_table_without_versions_gets_them(spark, folder):
    spark.range(4).write.parquet(f"{folder}/t")
    store = Store(spark, folder)
    assert store.exists("t") and not store.exists("u") and store.read("t").count() == 4
    assert store.append(spark.range(1), "t") == 1
    assert store.replace(store.read("t").distinct(), "t") == 4
    assert store.append(spark.range(7, 8), "t") == 1 and values(store.read("t")) == [0, 1, 2, 3, 7]


def landed(spark, folder, batch):
    events = testdata.listen_events(spark, SF_DIR).withColumn("itemInSession", F.col("event_id")).withColumn("ts", F.col("ts").cast("timestamp"))
    events = jobs.with_row_hash(events).withColumns(time_parts("ts"))
    events.where(batch).write.partitionBy("year", "month", "day").mode("append").parquet(f"{folder}/landed")
    return spark.read.schema(events.schema).parquet(f"{folder}/landed")


def rows(table):
    return Counter(map(tuple, table.select(*sorted(table.columns)).collect()))


def load(spark, folder, store, batches):
    for i, batch in enumerate(batches):
        events = landed(spark, folder, batch)
        days = jobs.days_of(events.where(batch))
        jobs.load_dimensions(spark, jobs.of_days(events, days), store, landed=events)
        jobs.load_fact(spark, events, store, days=days if i else None)


def test_loads_by_day_equal_a_full_build(spark, folder):
    """Batches that overlap in time; every table, edges included."""
    load(spark, f"{folder}/a", Store(spark, f"{folder}/a/wh"), ["true"])
    load(spark, f"{folder}/b", Store(spark, f"{folder}/b/wh"), ["event_id % 3 = 0", "event_id % 3 = 1", "event_id % 3 = 2"])
    for table in ("fact_streams", "fact_edges", "dim_user", "dim_user_history", "dim_session"):
        assert rows(Store(spark, f"{folder}/a/wh").read(table)) == rows(Store(spark, f"{folder}/b/wh").read(table)), table


def test_a_load_of_a_day_reads_that_day(spark, folder):
    events = landed(spark, folder, "true")
    days = jobs.days_of(events)[:1]
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = jobs.of_days(events, days)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert all(f"{part}#" in filters and f"= {value})" in filters for part, value in (("year", days[0].year), ("month", days[0].month), ("day", days[0].day)))
    assert jobs.of_days(events, days).count() == events.where(F.to_date("ts") == days[0]).count()
    store = Store(spark, f"{folder}/wh")
    load(spark, f"{folder}/x", store, ["true"])
    edges = store.read("fact_edges").where(in_days(F.col("event_date"), days))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [event_date" in edges or "PartitionFilters: [coalesce" in edges


def test_events_without_time(spark, folder):
    """They are a day of their own."""
    events = landed(spark, folder, "event_id < 200")
    odd = events.withColumn("ts", F.when(F.col("event_id") % 5 > 0, F.col("ts")))
    odd = jobs.with_row_hash(odd.drop("rowHash", "year", "month", "day", "hour")).withColumns(time_parts("ts")).cache()
    one, two = Store(spark, f"{folder}/one"), Store(spark, f"{folder}/two")
    jobs.load_dimensions(spark, odd, one)
    jobs.load_fact(spark, odd, one)
    first = F.col("event_id") % 2 == 0
    jobs.load_dimensions(spark, odd.where(first), two)
    jobs.load_fact(spark, odd.where(first), two)
    jobs.load_dimensions(spark, odd.where(~first), two, landed=odd)
    jobs.load_fact(spark, odd, two, days=jobs.days_of(odd.where(~first)))
    assert rows(one.read("fact_streams")) == rows(two.read("fact_streams"))
