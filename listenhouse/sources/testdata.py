"""The four event topics as views over the driver's test tables.

Only the tables a query's columns come from are joined, so a scan for user and
time reads nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from listenhouse.schemas import TOPICS, message_schema

LISTEN_TYPES = ("view", "click", "purchase")

# Columns that need a joined table; the others come from `events` alone.
_JOINED = {
    "song": "part", "artist": "part",
    "city": "nation", "zip": "nation", "lat": "nation", "lon": "nation",
    "state": "region",
    "firstName": "customer", "lastName": "customer", "userAgent": "customer",
}


# Each column of a listen over the joined tables.
_EXPRESSIONS = {
    "event_id": "event_id",
    "ts": "ts",
    "userId": "user_id",
    "sessionId": "user_id * 100 + day(ts)",
    "level": "IF(event_type = 'purchase', 'paid', 'free')",
    "event_type": "event_type",
    "duration": "value",
    "song": "p_name",
    "artist": "p_brand",
    "city": "n_name",
    "state": "r_name",
    "zip": "lpad(CAST(10000 + n_nationkey * 37 AS STRING), 5, '0')",
    "lat": "CAST(n_nationkey AS DOUBLE) * 1.5D",
    "lon": "CAST(n_regionkey AS DOUBLE) * 2.5D - 100.0D",
    "firstName": "split_part(c_name, '#', 1)",
    "lastName": "split_part(c_name, '#', 2)",
    "gender": "IF(user_id % 2 = 0, 'F', 'M')",
    "registration": "1640995200000 + user_id * 86400000",
    "userAgent": "c_mktsegment",
}
ALL_COLUMNS = tuple(_EXPRESSIONS)


# --- fixed values: the schemas of the test tables, so a scan needs no job to
# look into file footers first.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}
# ---------------------------------------------------------------------------


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def all_events(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = ALL_COLUMNS
) -> DataFrame:
    """Every event with the listening columns, whatever its type."""
    table = lambda name: read(spark, sf_dir, name)
    needed = {_JOINED[c] for c in columns if c in _JOINED}
    df = table("events")
    if needed & {"part", "nation", "region"}:
        df = df.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    if "customer" in needed:
        df = df.join(table("customer"), F.col("c_custkey") == F.col("user_id"), "left")
    if "part" in needed:
        df = df.join(table("part"), F.col("p_partkey") == F.col("k"), "left")
    if needed & {"nation", "region"}:
        df = df.join(table("nation"), F.col("n_nationkey") == F.col("k") % 25, "left")
    if "region" in needed:
        df = df.join(table("region"), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    return df.selectExpr(*[f"{_EXPRESSIONS[c]} AS {c}" for c in columns])


def listen_events(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = ALL_COLUMNS
) -> DataFrame:
    """The listen topic: views, clicks and purchases."""
    wanted = [*columns] if "event_type" in columns else [*columns, "event_type"]
    rows = all_events(spark, sf_dir, wanted).where(F.col("event_type").isin(*LISTEN_TYPES))
    return rows.select(*columns)


# --- the four topics as messages --------------------------------------------
PAGES = {
    "view": "Home", "click": "NextSong", "purchase": "Upgrade", "signup": "Register",
    "error": "Error",
}


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON message per event and topic it belongs to: (topic, position, value)."""
    kind = F.col("event_type")
    page = F.create_map(*[F.lit(x) for pair in PAGES.items() for x in pair])[kind]
    events = all_events(spark, sf_dir).withColumns({
        "ts": F.unix_millis(F.col("ts").cast("timestamp")),
        "itemInSession": F.col("event_id"),
        "auth": F.lit("Logged In"),
        "page": page,
        "method": F.lit("GET"),
        "status": F.when(kind == "error", 404).otherwise(200),
        "success": kind == "signup",
    })
    topics = F.array_compact(F.array(
        F.lit("page_view_events"),
        F.when(kind.isin(*LISTEN_TYPES), "listen_events"),
        F.when(kind.isin("signup", "error"), "auth_events"),
        F.when(kind == "purchase", "status_change_events"),
    ))
    rows = events.withColumn("topic", F.explode(topics))
    body = F.coalesce(*[
        F.when(F.col("topic") == topic, F.to_json(F.struct(*message_schema(topic).names)))
        for topic in TOPICS
    ])
    return rows.select("topic", F.col("event_id").alias("position"), body.alias("value"))
