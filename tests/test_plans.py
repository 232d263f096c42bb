"""What the physical plans must and must not hold."""

import pytest

from listenhouse.operators.joins import new_rows, not_in
from listenhouse.plans import dims, fact
from listenhouse.registry import QUERIES, TIEBREAK
from listenhouse.sources import testdata

SF_DIR = "/root/testdata/sf0.001"
# These write files first and return a scan of them.
WRITING = {
    "fact_by_hour_partition", "ingest_stream", "export_topics", "export_topics_bounded",
    "load_user_twice", "load_session_twice", "load_fact_twice", "load_fact_by_day", "load_user_history", "load_warehouse_catalog",
    "load_stream", "model_dim_user", "model_dim_artist", "model_fact_streams",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas",
                 "SinglePartition, ENSURE"):
        assert node not in text, node


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["song_skipped"](spark, SF_DIR))
    assert "In(event_type, [click,purchase,view])" in text
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in text
    assert "Join" not in text and "Exchange" not in text


def test_features_share_one_exchange(spark):
    text = plan(fact.listen_features(
        testdata.listen_events(spark, SF_DIR, ["event_id", "ts", "userId", "duration"])
        .selectExpr("*", "1D lat", "2D lon"), TIEBREAK,
    ))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("+- Window ") == 1


def test_latest_user_is_pruned_before_the_shuffle(spark):
    events = testdata.listen_events(spark, SF_DIR, ["event_id", "ts", "userId", "level"])
    for c in dims.USER_COLUMNS:
        if c not in (*events.columns, "eventTimestamp"):
            events = events.selectExpr("*", f"CAST(NULL AS STRING) AS {c}")
    text = plan(dims.dim_user(events, TIEBREAK))
    below = text[text.index("Exchange hashpartitioning(userId"):]
    assert "WindowGroupLimit" in below and text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("build, columns", [
    (dims.session_bounds, ["ts", "sessionId"]),
    (dims.locations, ["ts", "city", "zip", "state", "lat", "lon"]),
    (dims.songs, ["ts", "song", "artist", "duration"]),
])
def test_groups_combine_before_the_shuffle(spark, build, columns):
    text = plan(build(testdata.listen_events(spark, SF_DIR, columns)))
    assert "partial_min" in text


def test_level_history_has_one_exchange(spark):
    text = plan(QUERIES["level_changes_tiled"](spark, SF_DIR))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 1


def test_null_safe_anti_join_is_an_equi_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(10).selectExpr("id a", "id b")
        assert "SortMergeJoin" in plan(new_rows(df, df, ["a", "b"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_rows_are_found_by_hashing(spark):
    """No sort of all events before the first aggregate."""
    events = testdata.listen_events(spark, SF_DIR, ["ts", "song", "artist", "duration", "city", "state", "zip", "lat", "lon"])
    assert "SortAggregate" not in plan(dims.songs(events))
    text = plan(fact.natural_dims(events)["location"])
    assert "HashAggregate" in text[text.index("SortAggregate"):]  # structs of distinct places only


def test_not_in_reads_distinct_keys(spark):
    """The right side of the anti join is combined before its exchange."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(10).selectExpr("id a")
        text = plan(not_in(df, df, "a"))
        assert "HashAggregate(keys=[__key" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
