"""Versions, change history and merge on hand-made rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from listenhouse.operators.hot_keys import find_hot_keys
from listenhouse.operators.joins import new_rows, not_in
from listenhouse.operators.scd import scd2_changes, scd2_merge, versions
from listenhouse.plans import dims, history

EVENT = (
    "userId bigint, ts timestamp_ntz, level string, event_id bigint, firstName string, "
    "lastName string, gender string, registration bigint, city string, zip string, "
    "state string, lon double, lat double, userAgent string"
)


def events(spark, rows):
    """rows: (userId, minute, level, event_id)"""
    df = spark.createDataFrame(rows, "userId bigint, m int, level string, event_id bigint")
    ts = F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.floor(F.col("m") / 60).cast("int"),
                              F.col("m") % 60, F.lit(0))
    filled = {c.split()[0]: F.lit(None).cast(c.split()[1]) for c in EVENT.split(", ")[4:]}
    return df.withColumns({"ts": ts, **filled}).drop("m")


def test_tie_at_the_last_time_keeps_the_user(spark):
    df = events(spark, [(1, 10, "x", 1), (1, 20, "y", 2), (1, 20, "z", 3), (2, 5, "q", 4)])
    latest = {r.userId: r.level for r in dims.dim_user(df, ["event_id"]).collect()}
    assert latest == {1: "z", 2: "q"}
    rows = dims.scd_user_versions(df, ["event_id"]).where("currRow = 1").collect()
    assert {r.userId: r.level for r in rows} == latest


def test_level_history_forms(spark):
    df = events(spark, [(1, 1, "free", 1), (1, 2, "free", 2), (1, 3, "paid", 3), (1, 4, "free", 4)])
    parity = history.user_level_history(history.user_level_changes(df, ["event_id"]))
    got = sorted((r.rowActivationDate.minute, r.rowExpirationDate.minute, r.currentRow)
                 for r in parity.collect())
    assert got == [(1, 2, 0), (3, 4, 0), (4, 0, 1)]
    tiled = scd2_changes(df, ["userId"], ["level"], "ts", ["event_id"])
    got = sorted((r.rowActivationDate.minute, r.rowExpirationDate.minute, r.currRow)
                 for r in tiled.collect())
    assert got == [(1, 3, 0), (3, 4, 0), (4, 0, 1)]


def test_user_zero_comes_through_the_initial_state(spark):
    df = events(spark, [(0, 1, "free", 1), (5, 2, "NA", 2), (None, 3, "free", 3)])
    changes = history.user_level_changes(df, ["event_id"])
    assert [r.levelChanged for r in changes.collect()] == [0]  # 'NA' is the default
    rows = history.dim_user_sql(df, ["event_id"]).collect()
    assert [(r.userId, r.currentRow) for r in rows] == [(0, 1)]


@pytest.mark.parametrize("values, subset, expected", [
    ([1, 2, None], [2], {1}),
    ([1, 2, None], [2, None], set()),
    ([1, 2, None], [], {1, 2, None}),
    ([1, None], [None], set()),
])
def test_not_in_follows_sql(spark, values, subset, expected):
    left = spark.createDataFrame([(v,) for v in values], "k int")
    right = spark.createDataFrame([(v,) for v in subset], "k int")
    left.createOrReplaceTempView("l")
    right.createOrReplaceTempView("r")
    sql = {r[0] for r in spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT k FROM r)").collect()}
    assert {r[0] for r in not_in(left, right, "k").collect()} == expected == sql


def test_null_safe_load(spark):
    schema = "a int, b int"
    old = spark.createDataFrame([(1, None), (None, None)], schema)
    new = spark.createDataFrame([(1, None), (None, None), (1, 2)], schema)
    assert [tuple(r) for r in new_rows(new, old, ["a", "b"]).collect()] == [(1, 2)]


def random_levels(spark, n=600):
    id = F.col("id")
    df = spark.range(n).select(
        F.when(id % 3 == 0, 1).otherwise(id % 11).cast("bigint").alias("userId"),
        (id * 7919 % 1000).cast("int").alias("m"),
        F.when(F.hash(id) % 3 == 0, F.lit("paid")).when(F.hash(id) % 3 == 1, F.lit("free"))
        .alias("level"),
        id.alias("event_id"),
    )
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return df.withColumn("ts", start + F.make_dt_interval(mins=F.col("m"))).drop("m")


def test_scd2_intervals_tile(spark):
    df = random_levels(spark)
    hist = scd2_changes(df, ["userId"], ["level"], "ts", ["event_id"])
    per_key = {}
    for r in hist.orderBy("userId", "ts", "event_id").collect():
        per_key.setdefault(r.userId, []).append(r)
    for rows in per_key.values():
        assert [r.currRow for r in rows] == [0] * (len(rows) - 1) + [1]
        for a, b in zip(rows, rows[1:]):
            assert a.rowExpirationDate == b.rowActivationDate
            assert a.level != b.level


def test_merge_equals_full_history_and_is_idempotent(spark):
    df = random_levels(spark)
    how = (["userId"], ["level"], "ts", ["event_id"])
    rows = lambda frame: Counter(map(tuple, frame.select(*sorted(frame.columns)).collect()))
    full = rows(scd2_changes(df, *how))
    newer = F.col("ts") >= F.lit("2024-01-01 08:00:00").cast("timestamp_ntz")
    some = newer & (F.col("userId") < 8)  # other users have no new events
    known = scd2_changes(df.where(~newer | ~some), *how)
    merged = scd2_merge(known, df.where(some), *how)
    assert rows(merged) == full
    assert rows(scd2_merge(merged, df.where(some), *how)) == full


def test_scd_under_skew(spark):
    df = random_levels(spark, 3000)
    hot = find_hot_keys(df, ["userId"], ["ts", "event_id"], rows_per_task=100)
    assert hot is not None
    how = (["userId"], ["level"], "ts", ["event_id"])
    same = lambda a, b: Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))
    assert same(scd2_changes(df, *how), scd2_changes(df, *how, hot))
    assert same(versions(df, ["userId"], "ts", ["event_id"]),
                versions(df, ["userId"], "ts", ["event_id"], hot))


def test_order_of_input_does_not_matter(spark):
    df = random_levels(spark)
    songs = df.withColumns({"song": F.col("level"), "artist": F.lit("a"),
                            "duration": F.col("event_id").cast("double")})
    first = Counter(map(tuple, dims.songs(songs).collect()))
    for n in (1, 3, 7):
        shuffled = songs.repartition(n, F.rand(n))
        assert Counter(map(tuple, dims.songs(shuffled).collect())) == first


def test_epoch_expiration(spark):
    df = events(spark, [(1, 1, "free", 1), (1, 2, "free", 2)])
    rows = versions(df, ["userId"], "ts", ["event_id"], epoch=True).orderBy("ts").collect()
    assert [r.rowExpirationDate for r in rows] == [1704067320, 253402214400]
