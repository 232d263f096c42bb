"""Late events in a change history, and as-of joins, on hand-made and random rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from listenhouse.operators.as_of import AS_OF, as_of, hot_places
from listenhouse.operators.hot_keys import find_hot_keys
from listenhouse.operators.scd import LAST, scd2_changes, scd2_merge
from tests.test_scd import random_levels

HOW = (["k"], ["v"], "t", ["e"])


def table(spark, rows):
    return spark.createDataFrame(rows, "k int, t timestamp_ntz, v string, e int")


def moments(spark, rows):
    """rows: (k, minute, v, e)"""
    df = spark.createDataFrame(rows, "k int, m int, v string, e int")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return df.select("k", (start + F.make_dt_interval(mins=F.col("m"))).alias("t"), "v", "e")


def history(df):
    return sorted((r.k or 0, r.e, r.v, r.rowActivationDate.minute, str(r.rowExpirationDate)[14:16], r.currRow) for r in df.collect())


def test_an_unchanged_event_lies_between(spark):
    """The open version of minute 2 holds the event of minute 9; the late one of minute 8 takes it apart."""
    known = moments(spark, [(1, 1, "paid", 1), (1, 2, "free", 2), (1, 9, "free", 3)])
    late = moments(spark, [(1, 8, "paid", 4)])
    existing = scd2_changes(known, *HOW, last_event=True)
    merged = scd2_merge(existing, late, *HOW, landed=known.union(late))
    assert [h[:4] for h in history(merged)] == [(1, 1, "paid", 1), (1, 2, "free", 2), (1, 3, "free", 9), (1, 4, "paid", 8)]
    assert history(merged) == history(scd2_changes(known.union(late), *HOW))


def test_a_late_event_without_its_versions_events(spark):
    """Behind the last event of a closed version nothing has to be read again; inside it fails or is left out."""
    known = moments(spark, [(1, 2, "free", 2), (1, 3, "free", 3), (1, 9, "paid", 4)])
    existing = scd2_changes(known, *HOW, last_event=True)
    behind = moments(spark, [(1, 5, "paid", 5)])
    assert history(scd2_merge(existing, behind, *HOW)) == history(scd2_changes(known.union(behind), *HOW))
    inside = moments(spark, [(1, 2, "trial", 9)]).withColumn("e", F.lit(2)).union(moments(spark, [(1, 3, "trial", 1)]))
    with pytest.raises(Exception, match="late event"):
        scd2_merge(existing, inside, *HOW).collect()
    assert history(scd2_merge(existing, inside, *HOW, late="ignore")) == history(scd2_changes(known, *HOW))
    with pytest.raises(ValueError):
        scd2_merge(existing, inside, *HOW, late="drop")


def test_null_keys_values_and_repeated_events(spark):
    known = moments(spark, [(None, 1, None, 1), (None, 3, None, 2), (2, 1, "a", 3)])
    batch = moments(spark, [(None, 2, "x", 4), (None, 3, None, 2), (2, 1, "a", 3), (2, 1, "a", 3), (3, 1, None, 5)])
    merged = scd2_merge(scd2_changes(known, *HOW, last_event=True), batch, *HOW, landed=known.union(batch))
    assert history(merged) == history(scd2_changes(known.union(batch).distinct(), *HOW))
    none = known.where("false")
    assert history(scd2_merge(scd2_changes(none, *HOW, last_event=True), known, *HOW)) == history(scd2_changes(known, *HOW))
    assert history(scd2_merge(scd2_changes(known, *HOW, last_event=True), none, *HOW)) == history(scd2_changes(known, *HOW))


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_batches(spark, seed):
    """Three random batches of random events, each merged; last events included, and with every key cut into chunks."""
    how = (["userId"], ["level"], "ts", ["event_id"])
    df = random_levels(spark, 400).withColumn("batch", F.pmod(F.xxhash64("event_id", F.lit(seed)), F.lit(3))).cache()
    rows = lambda frame: Counter(map(tuple, frame.select(*sorted(frame.columns)).collect()))
    part = lambda *n: df.where(F.col("batch").isin(*n)).drop("batch")
    merged = scd2_changes(part(0), *how, last_event=True)
    merged = scd2_merge(merged, part(1), *how, landed=part(0, 1))
    merged = scd2_merge(merged, part(2), *how, landed=part(0, 1, 2))
    full = scd2_changes(df.drop("batch"), *how, last_event=True)
    assert LAST in merged.columns and rows(merged) == rows(full)
    assert rows(scd2_merge(merged, part(1), *how, landed=part(0, 1, 2))) == rows(full)
    hot = find_hot_keys(df, ["userId"], ["ts", "event_id"], rows_per_task=30)
    assert rows(scd2_changes(df.drop("batch"), *how, hot, last_event=True)) == rows(full)


def test_as_of_against_a_loop(spark):
    r = random.Random(5)
    rows = [(r.choice([None, 1, 2, 3]), r.randrange(40), i) for i in range(200)] + [(1, 7, 200)] * 3
    states = list({(r.choice([None, 1, 2]), r.randrange(40)): f"s{i}" for i in range(30)}.items())
    left = spark.createDataFrame(rows, "k int, at int, id int")
    right = spark.createDataFrame([(k, t, v) for (k, t), v in states], "k int, since int, v string")
    found = as_of(left, right, ["k"], ["at"], ["since"], ["v", "since"])
    assert found.columns == ["k", "at", "id", AS_OF]
    got = Counter((x.k, x.at, x.id, x.as_of and x.as_of.v) for x in found.collect())
    last = lambda k, at: max(((t, v) for (q, t), v in states if q == k and t <= at), default=(0, None))[1]
    assert got == Counter((k, at, i, last(k, at)) for k, at, i in rows)
    hot = find_hot_keys(*hot_places(left.distinct(), ["k"], ["at"]), rows_per_task=10)
    if hot is not None and not hot.has_copies:
        again = as_of(left, right, ["k"], ["at"], ["since"], ["v", "since"], hot)
        assert Counter((x.k, x.at, x.id, x.as_of and x.as_of.v) for x in again.collect()) == got
    assert as_of(left, right.where("false"), ["k"], ["at"], ["since"], ["v"]).where("as_of is not null").count() == 0
