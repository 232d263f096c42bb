"""Ordered windows under skew: chunked result equals the plain window."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from listenhouse.operators.hot_keys import find_hot_keys
from listenhouse.operators.neighbours import neighbours


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def skewed(spark):
    """3 000 rows; user 7 holds a third, with many ties and null times."""
    id = F.col("id")
    return spark.range(3000).select(
        F.when(id % 3 == 0, 7).when(id % 3 == 1, id % 40).alias("user"),
        F.when(id % 50 != 0, F.floor(id * 37 % 1000 / 7)).alias("t"),
        id, (id % 5).cast("double").alias("lat"),
    )


def check(df, keys, order, **columns):
    hot = find_hot_keys(df, keys, order, rows_per_task=100)
    assert hot is not None and hot.cuts.count() >= 1
    plain = neighbours(df, keys, order, **columns)
    split = neighbours(df, keys, order, hot=hot, **columns)
    assert split.columns == plain.columns
    assert rows(split) == rows(plain)
    return hot


@pytest.mark.parametrize("columns", [
    {"prev": ["t", "lat"], "next": ["t", "id"]}, {"prev": ["lat"]}, {"next": ["t"]},
])
def test_chunks_equal_plain_window(skewed, columns):
    hot = check(skewed, ["user"], ["t", "id"], **columns)
    assert not hot.has_copies


def test_null_key_may_be_hot(skewed):
    """Two thirds of the rows have no user or the hot one."""
    hot = check(skewed, ["user"], ["t", "id"], prev=["id"], next=["id"])
    assert hot.cuts.count() == 2  # user 7 and null


def test_several_keys(skewed):
    check(skewed, ["user", "lat"], ["t", "id"], prev=["id"], next=["id"])


def test_chunks_are_balanced(spark, skewed):
    hot = find_hot_keys(skewed, ["user"], ["t", "id"], rows_per_task=100)
    sizes = [
        r["count"] for r in hot.tag(skewed, ["user"], ["t", "id"])
        .where("__chunk is not null").groupBy("user", "__chunk").count().collect()
    ]
    assert len(sizes) >= 16 and max(sizes) <= 200


def test_identical_rows_are_split(spark):
    """A group of exact copies without any id: folded, then given back whole."""
    id = F.col("id")
    df = spark.range(2000).select(
        F.when(id < 1200, 1).otherwise(id % 20).alias("user"),
        F.when(id < 900, 50).otherwise(id % 100).alias("t"),
        F.lit("x").alias("v"),
    )
    hot = check(df, ["user"], ["t"], prev=["t"], next=["t", "v"])
    assert hot.has_copies
    tagged = hot.tag(df, ["user"], ["t"])
    assert tagged.count() < 1200


def test_even_keys_are_left_alone(spark):
    df = spark.range(5000).select((F.col("id") % 500).alias("user"), "id")
    assert find_hot_keys(df, ["user"], ["id"], rows_per_task=100) is None


def test_plain_plan_has_one_exchange(skewed):
    df = neighbours(skewed, ["user"], ["t", "id"], prev=["t"], next=["lat"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Window") == 1


def test_empty_input(spark):
    df = spark.range(0).select("id", F.col("id").alias("user"))
    assert find_hot_keys(df, ["user"], ["id"], rows_per_task=1) is None
