"""Every query by name: ``(spark, sf_dir) -> DataFrame``.

Each runs over the whole of the given tables. Where a query needs an 'existing'
table, that is the same data before a point in time. Columns that may hold the
open end 9999-12-31 are returned as text, because it lies outside the range of
nanosecond timestamps in pandas.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from listenhouse.functions import (
    artist_key, date_key_string, filled_location_key, location_key, repair_text, song_key,
    time_parts,
)
from listenhouse.operators.dedup import last_row
from listenhouse.operators.hot_keys import HotKeys, find_hot_keys
from listenhouse.operators.joins import new_rows
from listenhouse.operators.as_of import hot_places
from listenhouse.operators.scd import LAST, current, scd2_changes, scd2_merge
from listenhouse.plans import dims, fact, history, jobs, models
from listenhouse.schemas import FACT_LOAD_KEY, FACT_VALIDITY_KEY, TOPICS, landed_schema
from listenhouse.session import scratch_path
from listenhouse.sinks.store import Store
from listenhouse.sinks.tables import write_by_hour
from listenhouse.sources import testdata
from listenhouse.sources.calendar import calendar_hours_sequence, calendar_of_years, occurring_years
from listenhouse.streaming import load as streaming_load
from listenhouse.streaming.export import export_topics
from listenhouse.streaming.ingest import drain, parse_events, read_file_stream, start_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TIEBREAK = ("event_id",)
# Points in time that divide 'existing' from 'incoming'.
EARLY = "2024-01-01 06:00:00"
MIDDLE = "2024-01-16 12:00:00"
# Added to the id of an event that is delivered a second time.
REDELIVERED = 1_000_000_000_000

USER_COLUMNS = (
    "event_id", "ts", "userId", "firstName", "lastName", "gender", "level", "registration",
    "city", "zip", "state", "lon", "lat", "userAgent",
)
ARTIST_COLUMNS = ("event_id", "ts", "artist", "lat", "lon", "city", "state")
LOCATION_COLUMNS = ("ts", "city", "zip", "state", "lat", "lon")
SONG_COLUMNS = ("ts", "song", "artist", "duration")
SESSION_COLUMNS = ("ts", "sessionId")
PLACE_COLUMNS = ("event_id", "ts", "userId", "lat", "lon")
LEVEL_COLUMNS = ("event_id", "ts", "userId", "level")
FACT_COLUMNS = (
    "event_id", "ts", "userId", "sessionId", "song", "artist", "duration",
    "city", "zip", "state", "lat", "lon",
)


def query(fn: Query) -> Query:
    """Register a query under its function name, without a trailing '_query'."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    QUERIES[fn.__name__.removesuffix("_query")] = run
    return run


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def before(df: DataFrame, moment: str) -> DataFrame:
    return df.where(F.col("ts") < F.lit(moment).cast(df.schema["ts"].dataType))


def since(df: DataFrame, moment: str) -> DataFrame:
    return df.where(F.col("ts") >= F.lit(moment).cast(df.schema["ts"].dataType))


def hot_users(spark: SparkSession, sf_dir: str) -> HotKeys | None:
    narrow = testdata.listen_events(spark, sf_dir, ["userId", "ts", "event_id"])
    return find_hot_keys(narrow, ["userId"], ["ts", "event_id"])


def hot_artists(spark: SparkSession, sf_dir: str) -> HotKeys | None:
    narrow = testdata.listen_events(spark, sf_dir, ["artist", "ts", "event_id"])
    return find_hot_keys(narrow, ["artist"], ["ts", "event_id"])


# --- scans and scalar columns ----------------------------------------------

@query
def scan_events(spark, sf_dir):
    return testdata.listen_events(spark, sf_dir)


@query
def event_time_parts(spark, sf_dir):
    events = testdata.listen_events(spark, sf_dir, ["event_id", "ts"])
    return events.withColumns(time_parts("ts", clock=True))


@query
def date_key_string_query(spark, sf_dir):
    events = testdata.listen_events(spark, sf_dir, ["event_id", "ts"])
    return events.select("event_id", date_key_string("ts").alias("DateKey"))


@query
def song_skipped(spark, sf_dir):
    events = testdata.listen_events(spark, sf_dir, ["event_id", "duration"])
    return events.select("event_id", fact.song_skipped().alias("isSongSkipped"))


@query
def surrogate_md5(spark, sf_dir):
    events = testdata.listen_events(spark, sf_dir, FACT_COLUMNS)
    return events.select(
        "event_id", song_key().alias("songId"), artist_key().alias("artistId"),
        location_key().alias("locationId"),
    )


@query
def surrogate_hash(spark, sf_dir):
    """32-bit keys, told by the first event that has the same key."""
    events = testdata.listen_events(spark, sf_dir, FACT_COLUMNS)
    keyed = events.select(
        "event_id", song_key("hash").alias("song"), artist_key("hash").alias("artist"),
        location_key("hash").alias("location"), filled_location_key().alias("filledLocation"),
    )
    for name in ("song", "artist", "location", "filledLocation"):
        first = keyed.groupBy(name).agg(F.min("event_id").alias(f"{name}First"))
        keyed = keyed.join(first, name).drop(name)
    return keyed


@query
def repair_text_query(spark, sf_dir):
    """Damage every document's text as the topics do, then repair it."""
    docs = testdata.read(spark, sf_dir, "documents").select("doc_id", "text")
    escaped = F.replace("text", F.lit("\\"), F.lit("\\\\"))
    latin = F.decode(F.encode(escaped, "UTF-8"), "ISO-8859-1")
    runs = F.regexp_extract_all(latin, F.lit(r"([\x80-\xFF]|[^\x80-\xFF]+)"), F.lit(1))
    escape = lambda c: F.when(
        F.ascii(c) > 127, F.concat(F.lit("\\"), F.conv(F.ascii(c), 10, 8))
    ).otherwise(c)
    octal = F.array_join(F.transform(runs, escape), "")
    damaged = F.when(F.col("doc_id") % 2 == 0, latin).otherwise(octal)
    repaired = docs.select("doc_id", repair_text(damaged).alias("text"))
    return repaired.select(
        "doc_id", F.length("text").cast("bigint").alias("characters"),
        F.md5("text").alias("text_md5"),
    )


@query
def user_base(spark, sf_dir):
    events = testdata.listen_events(spark, sf_dir, USER_COLUMNS)
    return dims.user_base(events, TIEBREAK)


# --- calendar --------------------------------------------------------------

def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hours of the years the events fall in."""
    return calendar_of_years(occurring_years(testdata.listen_events(spark, sf_dir, ["ts"])))


@query
def calendar_hours_query(spark, sf_dir):
    return _calendar(spark, sf_dir)


@query
def calendar_hours_sequence_query(spark, sf_dir):
    return calendar_hours_sequence(occurring_years(testdata.listen_events(spark, sf_dir, ["ts"])))


@query
def dim_datetime(spark, sf_dir):
    return dims.dim_datetime(_calendar(spark, sf_dir))


@query
def dim_datetime_sql(spark, sf_dir):
    years = occurring_years(testdata.listen_events(spark, sf_dir, ["ts"]))
    return dims.dim_datetime_sql(calendar_hours_sequence(years))


# --- features --------------------------------------------------------------

def _features(spark, sf_dir, columns=PLACE_COLUMNS, rule="all") -> DataFrame:
    events = testdata.listen_events(spark, sf_dir, columns)
    if "duration" not in columns:
        events = events.withColumn("duration", F.lit(None).cast("double"))
    return fact.listen_features(events, TIEBREAK, rule, hot_users(spark, sf_dir))


@query
def is_moving(spark, sf_dir):
    return _features(spark, sf_dir).select("event_id", "isMoving")


@query
def is_moving_any(spark, sf_dir):
    return _features(spark, sf_dir, rule="any").select("event_id", "isMoving")


@query
def first_last_listen(spark, sf_dir):
    return _features(spark, sf_dir).select(
        "event_id", "isFirstListenEvent", "isLastListenEvent"
    )


@query
def next_listen_gap(spark, sf_dir):
    return _features(spark, sf_dir).select("event_id", "nextListenEventTimeGap")


@query
def listen_features(spark, sf_dir):
    rows = _features(spark, sf_dir, [*PLACE_COLUMNS, "duration"])
    return rows.select("event_id", "userId", "ts", *fact.MEASURES)


# --- dimensions ------------------------------------------------------------

@query
def dedup_songs(spark, sf_dir):
    return dims.songs(testdata.listen_events(spark, sf_dir, SONG_COLUMNS))


@query
def dedup_artists(spark, sf_dir):
    return dims.artists(testdata.listen_events(spark, sf_dir, ARTIST_COLUMNS))


@query
def dedup_locations(spark, sf_dir):
    return dims.locations(testdata.listen_events(spark, sf_dir, LOCATION_COLUMNS))


@query
def dedup_versions(spark, sf_dir):
    """Every user event delivered twice, the second time as a paid one; the
    later delivery is kept per user and activation date."""
    events = testdata.listen_events(spark, sf_dir, LEVEL_COLUMNS)
    again = events.withColumns({
        "event_id": F.col("event_id") + REDELIVERED, "level": F.lit("paid"),
    })
    return last_row(events.unionByName(again), ["userId", "ts"], TIEBREAK)


@query
def distinct_songs(spark, sf_dir):
    return testdata.listen_events(spark, sf_dir, ["song", "artist"]).distinct()


@query
def dim_song(spark, sf_dir):
    return as_text(_dim(spark, sf_dir, "song"), "rowExpirationDate")


@query
def dim_artist(spark, sf_dir):
    return as_text(_dim(spark, sf_dir, "artist"), "rowExpirationDate")


@query
def dim_location(spark, sf_dir):
    return as_text(_dim(spark, sf_dir, "location"), "rowExpirationDate")


@query
def scd_location_epoch(spark, sf_dir):
    return dims.dim_location(testdata.listen_events(spark, sf_dir, LOCATION_COLUMNS), epoch=True)


@query
def dim_session(spark, sf_dir):
    rows = _dim(spark, sf_dir, "session")
    return rows.select("sessionId", "startTime", "endTime", "startTimestamp", "endTimestamp")


@query
def scd_session(spark, sf_dir):
    rows = _dim(spark, sf_dir, "session")
    return as_text(
        rows.drop("startTimestamp", "endTimestamp"), "rowExpirationDate"
    )


@query
def session_changed(spark, sf_dir):
    return dims.session_changes(
        _dim(spark, sf_dir, "session", MIDDLE), _dim(spark, sf_dir, "session")
    )


@query
def dim_user(spark, sf_dir):
    return as_text(_dim(spark, sf_dir, "user"), "rowExpirationDate")


@query
def scd_user_versions(spark, sf_dir):
    events = testdata.listen_events(spark, sf_dir, USER_COLUMNS)
    rows = dims.scd_user_versions(events, TIEBREAK, hot_users(spark, sf_dir))
    return as_text(rows, "rowExpirationDate")


@query
def current_users(spark, sf_dir):
    events = testdata.listen_events(spark, sf_dir, USER_COLUMNS)
    rows = dims.scd_user_versions(events, TIEBREAK, hot_users(spark, sf_dir))
    return as_text(current(rows), "rowExpirationDate")


# --- SQL-model history -----------------------------------------------------

def _level_changes(spark, sf_dir):
    events = testdata.listen_events(spark, sf_dir, USER_COLUMNS)
    return events, history.user_level_changes(events, TIEBREAK, hot_users(spark, sf_dir))


def _artist_changes(spark, sf_dir):
    events = testdata.listen_events(spark, sf_dir, ARTIST_COLUMNS)
    return events, history.artist_changes(events, TIEBREAK, hot_artists(spark, sf_dir))


@query
def user_level_changes(spark, sf_dir):
    return as_text(_level_changes(spark, sf_dir)[1], "nextEventTimestamp")


@query
def user_level_history(spark, sf_dir):
    rows = history.user_level_history(_level_changes(spark, sf_dir)[1])
    return as_text(rows, "rowExpirationDate")


@query
def user_initial_state(spark, sf_dir):
    events, changes = _level_changes(spark, sf_dir)
    return as_text(history.user_initial_state(events, changes), "rowExpirationDate")


@query
def dim_user_sql(spark, sf_dir):
    events = testdata.listen_events(spark, sf_dir, USER_COLUMNS)
    rows = history.dim_user_sql(events, TIEBREAK, hot_users(spark, sf_dir))
    return as_text(rows, "rowExpirationDate")


@query
def artist_changes(spark, sf_dir):
    return as_text(_artist_changes(spark, sf_dir)[1], "nextEventTimestamp")


@query
def artist_history(spark, sf_dir):
    rows = history.artist_history(_artist_changes(spark, sf_dir)[1])
    return as_text(rows, "rowExpirationDate")


@query
def artist_initial_state(spark, sf_dir):
    events, changes = _artist_changes(spark, sf_dir)
    return as_text(history.artist_initial_state(events, changes), "rowExpirationDate")


@query
def dim_artist_sql(spark, sf_dir):
    events = testdata.listen_events(spark, sf_dir, ARTIST_COLUMNS)
    rows = history.dim_artist_sql(events, TIEBREAK, hot_artists(spark, sf_dir))
    return as_text(rows, "rowExpirationDate")


@query
def dim_song_sql(spark, sf_dir):
    return history.dim_song_sql(testdata.listen_events(spark, sf_dir, SONG_COLUMNS))


@query
def dim_location_sql(spark, sf_dir):
    return history.dim_location_sql(testdata.listen_events(spark, sf_dir, LOCATION_COLUMNS))


@query
def dim_session_sql(spark, sf_dir):
    return history.dim_session_sql(testdata.listen_events(spark, sf_dir, SESSION_COLUMNS))


# --- textbook history ------------------------------------------------------

@query
def level_changes_tiled(spark, sf_dir):
    """Level history whose intervals tile."""
    events = testdata.listen_events(spark, sf_dir, LEVEL_COLUMNS)
    rows = scd2_changes(
        events, ["userId"], ["level"], "ts", TIEBREAK, hot_users(spark, sf_dir)
    )
    return as_text(rows, "rowExpirationDate")


@query
def level_changes_merged(spark, sf_dir):
    """The same history built in two loads."""
    events = testdata.listen_events(spark, sf_dir, LEVEL_COLUMNS)
    hot = hot_users(spark, sf_dir)
    how = (["userId"], ["level"], "ts", TIEBREAK, hot)
    existing = scd2_changes(before(events, MIDDLE), *how)
    rows = scd2_merge(existing, since(events, MIDDLE), *how)
    return as_text(rows, "rowExpirationDate")


@query
def merge_late_events(spark, sf_dir):
    """The same history where part of the first half comes in late."""
    events = testdata.listen_events(spark, sf_dir, LEVEL_COLUMNS)
    how = (["userId"], ["level"], "ts", TIEBREAK, hot_users(spark, sf_dir))
    late = F.col("event_id") % 7 == 3
    existing = scd2_changes(before(events, MIDDLE).where(~late), *how, last_event=True)
    incoming = since(events, MIDDLE).unionByName(before(events, MIDDLE).where(late))
    return as_text(scd2_merge(existing, incoming, *how, landed=events).drop(LAST), "rowExpirationDate")


@query
def join_user_as_of(spark, sf_dir):
    """Every listen with the level its user had at that time, by the history of changes."""
    events = testdata.listen_events(spark, sf_dir, ["event_id", "ts", "userId", "level"])
    versions = dims.user_levels(events, TIEBREAK, hot_users(spark, sf_dir))
    hot = find_hot_keys(*hot_places(events, ["userId"], ["ts"]))
    return fact.join_user_as_of(events, versions, hot).select("event_id", "userId", "UserKey", "UserVersion", "UserLevel")


@query
def join_user_as_of_chunked(spark, sf_dir):
    """The same with every user cut into chunks of some 20 listens."""
    events = testdata.listen_events(spark, sf_dir, ["event_id", "ts", "userId", "level"])
    versions = dims.user_levels(events, TIEBREAK)
    hot = find_hot_keys(*hot_places(events, ["userId"], ["ts"]), rows_per_task=20)
    return fact.join_user_as_of(events, versions, hot).select("event_id", "userId", "UserKey", "UserVersion", "UserLevel")


@query
def join_artist_as_of(spark, sf_dir):
    """Every listen with the place its artist had at that time."""
    events = testdata.listen_events(spark, sf_dir, ARTIST_COLUMNS)
    versions = dims.artist_places(events, TIEBREAK, hot_artists(spark, sf_dir))
    hot = find_hot_keys(*hot_places(events, ["artist"], ["ts"]))
    return fact.join_artist_as_of(events, versions, hot).select("event_id", "artist", "ArtistVersion")


@query
def listen_features_chunked(spark, sf_dir):
    """The features with every user cut into chunks of some 20 listens."""
    events = testdata.listen_events(spark, sf_dir, [*PLACE_COLUMNS, "duration"])
    hot = find_hot_keys(events, ["userId"], ["ts", "event_id"], rows_per_task=20)
    return fact.listen_features(events, TIEBREAK, hot=hot).select("event_id", "userId", "ts", *fact.MEASURES)


@query
def scd_user_versions_chunked(spark, sf_dir):
    """The versions with every user cut into chunks."""
    events = testdata.listen_events(spark, sf_dir, USER_COLUMNS)
    hot = find_hot_keys(events, ["userId"], ["ts", "event_id"], rows_per_task=20)
    return as_text(dims.scd_user_versions(events, TIEBREAK, hot), "rowExpirationDate")


# --- joins and fact --------------------------------------------------------

# Per dimension: the columns it is built from, and how.
DIMENSIONS = {
    "user": (USER_COLUMNS, lambda events: dims.dim_user(events, TIEBREAK)),
    "artist": (ARTIST_COLUMNS, dims.dim_artist),
    "song": (SONG_COLUMNS, dims.dim_song),
    "location": (LOCATION_COLUMNS, dims.dim_location),
    "session": (SESSION_COLUMNS, dims.dim_session),
}


def _dim(spark, sf_dir, name: str, until: str | None = None) -> DataFrame:
    """A dimension, as known at the time ``until``."""
    if name == "datetime":
        return dims.dim_datetime(_calendar(spark, sf_dir))
    columns, build = DIMENSIONS[name]
    events = testdata.listen_events(spark, sf_dir, columns)
    return build(before(events, until) if until else events)


def _dims(spark, sf_dir) -> dict[str, DataFrame]:
    return {n: _dim(spark, sf_dir, n) for n in (*DIMENSIONS, "datetime")}


def _join(spark, sf_dir, name: str, join, columns, until: str | None = None) -> DataFrame:
    events = testdata.listen_events(spark, sf_dir, columns)
    refs = {
        n: c for n, c in fact.event_keys().items() if n.removesuffix("Ref") == name
    }
    if name == "datetime":
        refs = {"hourRef": fact.event_keys()["hourRef"]}
    return join(events.withColumns(refs), _dim(spark, sf_dir, name, until))


@query
def join_user(spark, sf_dir):
    return _join(spark, sf_dir, "user", fact.join_user, ["event_id", "userId"]).select("event_id", "userId", "UserKey")


@query
def join_artist(spark, sf_dir):
    return _join(spark, sf_dir, "artist", fact.join_artist, ARTIST_COLUMNS).select("event_id", "ArtistKey")


@query
def join_artist_unmatched(spark, sf_dir):
    """Against a dimension that knows the early artists only: the others have no key."""
    return _join(spark, sf_dir, "artist", fact.join_artist, ARTIST_COLUMNS, EARLY).select("event_id", "ArtistKey")


@query
def join_song(spark, sf_dir):
    return _join(spark, sf_dir, "song", fact.join_song, ["event_id", "song", "artist"]).select("event_id", "SongKey")


@query
def join_location(spark, sf_dir):
    return _join(spark, sf_dir, "location", fact.join_location, ["event_id", *LOCATION_COLUMNS]).select(
        "event_id", "LocationKey"
    )


@query
def join_session(spark, sf_dir):
    return _join(spark, sf_dir, "session", fact.join_session, ["event_id", "sessionId"]).select("event_id", "SessionKey")


@query
def join_calendar(spark, sf_dir):
    return _join(spark, sf_dir, "datetime", fact.join_calendar, ["event_id", "ts"]).select("event_id", "DateKey")


@query
def join_calendar_datekey(spark, sf_dir):
    return _join(spark, sf_dir, "datetime", fact.join_calendar_datekey, ["event_id", "ts"]).select(
        "event_id", "DateKey"
    )


def _fact(spark, sf_dir, events: DataFrame, **options) -> DataFrame:
    hot = hot_users(spark, sf_dir)
    # A validity group lies within one user: without hot users none is hot.
    hot_facts = hot and find_hot_keys(
        fact.validity_keys(events), FACT_VALIDITY_KEY, ["Timestamp", *TIEBREAK]
    )
    return fact.fact_streams(
        events, _dims(spark, sf_dir), TIEBREAK,
        hot_users=hot, hot_facts=hot_facts, **options,
    )


@query
def fact_streams(spark, sf_dir):
    events = testdata.listen_events(spark, sf_dir, FACT_COLUMNS)
    return as_text(_fact(spark, sf_dir, events), "rowExpirationDate")


@query
def fact_streams_detailed(spark, sf_dir):
    events = testdata.listen_events(spark, sf_dir, FACT_COLUMNS)
    rows = _fact(spark, sf_dir, events, rule="any", detailed=True)
    return as_text(rows, "rowExpirationDate")


@query
def fact_streams_natural(spark, sf_dir):
    events = testdata.listen_events(spark, sf_dir, FACT_COLUMNS)
    return fact.fact_streams_natural(
        events, fact.natural_dims(events), _dim(spark, sf_dir, "datetime"),
        _dim(spark, sf_dir, "session"), TIEBREAK, hot_users(spark, sf_dir),
    )


def _keyed(spark, sf_dir) -> DataFrame:
    """Listens with the key columns of the fact table."""
    events = testdata.listen_events(spark, sf_dir, FACT_COLUMNS)
    return fact.validity_keys(events).withColumn("SessionKey", F.col("sessionId"))


@query
def dedup_facts(spark, sf_dir):
    """Every listen delivered twice, reduced to one again."""
    rows = _keyed(spark, sf_dir).select("event_id", *fact.FACT_DEDUP_KEY)
    again = rows.withColumn("event_id", F.col("event_id") + REDELIVERED)
    return fact.dedup_facts(again.unionByName(rows), TIEBREAK)


@query
def fact_validity(spark, sf_dir):
    rows = _keyed(spark, sf_dir)
    hot = find_hot_keys(rows, FACT_VALIDITY_KEY, ["Timestamp", *TIEBREAK])
    columns = ["event_id", *FACT_VALIDITY_KEY, "Timestamp"]
    valid = fact.fact_validity(rows.select(*columns), TIEBREAK, hot)
    return as_text(valid, "rowExpirationDate")


@query
def fact_by_hour_partition(spark, sf_dir):
    """The fact table written partitioned by event time and read back."""
    events = testdata.listen_events(spark, sf_dir, FACT_COLUMNS)
    path = scratch_path(spark, "fact-by-hour")
    write_by_hour(_fact(spark, sf_dir, events), path, granularity="hour")
    return spark.read.parquet(path).select(
        "UserKey", "SongKey", "Timestamp", "isSongSkipped",
        F.col("event_hour").cast("timestamp_ntz").alias("event_hour"),
    )


# --- incremental loads -----------------------------------------------------

def _new(spark, sf_dir, name: str, key: str) -> DataFrame:
    fresh = new_rows(_dim(spark, sf_dir, name), _dim(spark, sf_dir, name, EARLY), [key])
    return as_text(fresh, "rowExpirationDate")


@query
def load_new_users(spark, sf_dir):
    return _new(spark, sf_dir, "user", "userId")


@query
def load_new_songs(spark, sf_dir):
    return _new(spark, sf_dir, "song", "songId")


@query
def load_new_artists(spark, sf_dir):
    return _new(spark, sf_dir, "artist", "artistId")


@query
def load_new_locations(spark, sf_dir):
    return _new(spark, sf_dir, "location", "locationId")


@query
def load_new_sessions(spark, sf_dir):
    rows = _new(spark, sf_dir, "session", "sessionId")
    return rows.drop("startTimestamp", "endTimestamp")


@query
def load_new_facts(spark, sf_dir):
    """Facts of all events that the load of the first half does not hold."""
    events = testdata.listen_events(spark, sf_dir, FACT_COLUMNS)
    existing = _fact(spark, sf_dir, before(events, MIDDLE))
    fresh = new_rows(_fact(spark, sf_dir, events), existing, FACT_LOAD_KEY)
    return as_text(fresh, "rowExpirationDate")


def _joined_once(events: DataFrame) -> DataFrame:
    """Events written with their joined columns, for loads that read them many times: each time customers and parts would go through the driver."""
    path = scratch_path(events.sparkSession, "listens")
    events.write.parquet(path)
    return events.sparkSession.read.schema(events.schema).parquet(path)


def _two_loads(spark, sf_dir, load, once: bool = False) -> str:
    """A warehouse loaded with the first half of the events, then with all; ``once``: joined only once."""
    events = testdata.listen_events(spark, sf_dir).withColumn("itemInSession", F.col("event_id"))
    events = _joined_once(events) if once else events
    warehouse = scratch_path(spark, "warehouse")
    for part in (before(events, MIDDLE), events):
        load(jobs.with_row_hash(part), warehouse)
    return warehouse


@query
def load_user_twice(spark, sf_dir):
    """The user job, run twice, read back."""
    warehouse = _two_loads(spark, sf_dir, jobs.load_users)
    return as_text(Store(spark, warehouse).read("dim_user"), "rowExpirationDate")


@query
def load_session_twice(spark, sf_dir):
    """The session job, run twice, read back."""
    warehouse = _two_loads(spark, sf_dir, jobs.load_sessions)
    rows = Store(spark, warehouse).read("dim_session").drop("startTimestamp", "endTimestamp")
    return as_text(rows, "rowExpirationDate")


def _fact_table(store: Store) -> DataFrame:
    """The fact table of a warehouse, as the queries return it."""
    rows = store.read("fact_streams").withColumn("DateKey", F.col("DateKey").cast("timestamp_ntz"))
    return as_text(rows.drop("event_date", "event_hour", *jobs.TIEBREAK), "rowExpirationDate")


@query
def load_fact_twice(spark, sf_dir):
    """All jobs, run twice, the fact read back."""
    def load(events, warehouse):
        jobs.load_dimensions(spark, events, warehouse)
        jobs.load_fact(spark, events, warehouse)

    return _fact_table(Store(spark, _two_loads(spark, sf_dir, load, once=True)))


def _landed(spark, sf_dir) -> DataFrame:
    """Listens as landed: with the parts of their time."""
    events = testdata.listen_events(spark, sf_dir).withColumn("itemInSession", F.col("event_id"))
    return jobs.with_row_hash(events).withColumns(time_parts("ts"))


def _batches(events: DataFrame) -> list[DataFrame]:
    """The first half of the events without some, then those that came late, then the rest."""
    late = F.col("event_id") % 7 == 3
    return [before(events, MIDDLE).where(~late), before(events, MIDDLE).where(late), since(events, MIDDLE)]


@query
def load_fact_by_day(spark, sf_dir):
    """The fact loaded in full, then with late events, then with the rest, each time only the days of the batch."""
    events, store = _landed(spark, sf_dir), Store(spark, scratch_path(spark, "warehouse"))
    path = scratch_path(spark, "landed")
    for i, batch in enumerate(_batches(events)):
        batch.write.partitionBy("year", "month", "day").parquet(path, mode="append")
        landed = spark.read.schema(events.schema).parquet(path)
        days = jobs.days_of(batch)
        jobs.load_dimensions(spark, jobs.of_days(landed, days), store, landed=landed)
        jobs.load_fact(spark, landed, store, days=days if i else None)
    return _fact_table(store)


@query
def load_user_history(spark, sf_dir):
    """The user history job, run for three batches, one of late events, and once more for the second."""
    events, store = _landed(spark, sf_dir), Store(spark, scratch_path(spark, "warehouse"))
    first, late, rest = _batches(events)
    landed = first
    for i, batch in enumerate((first, late, rest, late)):
        landed = landed.unionByName(batch) if i in (1, 2) else landed
        jobs.load_user_history(batch, store, landed)
    rows = store.read("dim_user_history").withColumnRenamed("itemInSession", "event_id")
    return as_text(rows.drop("rowHash", LAST), "rowExpirationDate")


@query
def load_warehouse_catalog(spark, sf_dir):
    """All jobs on tables of a catalog schema, run for two batches, the fact read back."""
    events = _joined_once(_landed(spark, sf_dir))
    schema = f"warehouse_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{scratch_path(spark, schema)}'")
    store = Store(spark, schema, format=None)
    for batch, landed in ((before(events, MIDDLE), before(events, MIDDLE)), (since(events, MIDDLE), events)):
        jobs.load_dimensions(spark, batch, store, landed=landed)
        jobs.load_fact(spark, landed, store, days=jobs.days_of(batch))
    return _fact_table(store)


# --- models as jobs ---------------------------------------------------------

def _model(spark, sf_dir, name: str) -> DataFrame:
    """A model and what it refers to, built as tables and read back."""
    sources = {"listen_events": testdata.listen_events(spark, sf_dir), "hours": _calendar(spark, sf_dir)}
    store = Store(spark, scratch_path(spark, "models"))
    models.build_models(models.warehouse_models(TIEBREAK), sources, store, [name])
    return store.read(name)


@query
def model_dim_user(spark, sf_dir):
    return as_text(_model(spark, sf_dir, "dim_user_sql"), "rowExpirationDate")


@query
def model_dim_artist(spark, sf_dir):
    return as_text(_model(spark, sf_dir, "dim_artist_sql"), "rowExpirationDate")


@query
def model_fact_streams(spark, sf_dir):
    return _model(spark, sf_dir, "fact_streams_natural")


# --- streaming and export --------------------------------------------------

@query
def ingest_stream(spark, sf_dir):
    """All four topics through the streaming ingest, read back from its files."""
    messages = testdata.messages(spark, sf_dir)
    base = scratch_path(spark, "ingest")
    messages.select("topic", "value").write.partitionBy("topic").text(f"{base}/in")
    streams = {t: read_file_stream(spark, f"{base}/in/topic={t}") for t in TOPICS}
    # A backfill: folders by day, so that one batch does not open a file per hour.
    drain(start_ingest(
        streams, f"{base}/out", trigger=None, partition_by=["year", "month", "day"]
    ))
    landed = [
        spark.read.parquet(f"{base}/out/{t}").withColumn("topic", F.lit(t)) for t in TOPICS
    ]
    union = landed[0]
    for rows in landed[1:]:
        union = union.unionByName(rows, allowMissingColumns=True)
    return union.select(
        "topic", F.col("ts").cast("timestamp_ntz").alias("ts"), "year", "month", "day", "hour",
        "userId", "sessionId", "itemInSession", "level", "city", "zip", "state", "lat", "lon",
        "registration", "song", "artist", "duration", "page", "status", "success",
    )


@query
def load_stream(spark, sf_dir):
    """Listen messages streamed into the warehouse in three batches, one of late events, the second delivered again; the fact read back."""
    messages = testdata.messages(spark, sf_dir).where("topic = 'listen_events'")
    base = scratch_path(spark, "load-stream")
    part = F.when(F.col("position") % 7 == 3, "b").when(F.col("position") % 2 == 0, "a").otherwise("c")
    messages.select("value", part.alias("part")).write.partitionBy("part").parquet(f"{base}/sent")
    sent = spark.read.schema("value STRING, part STRING").parquet(f"{base}/sent")
    store = Store(spark, f"{base}/warehouse")
    for name in ("a", "b", "c"):
        # What has come since the last run is one batch, in however many files.
        sent.where(F.col("part") == name).select("value").write.text(f"{base}/in/part={name}")
        stream = parse_events(read_file_stream(spark, f"{base}/in/part=*"), "listen_events")
        drain({"load": streaming_load.load_stream(stream, f"{base}/landed", store, f"{base}/checkpoint", None, algo="md5").start()})
    schema = landed_schema("listen_events")
    spark.read.schema(schema).parquet(f"{base}/landed/batch=1").write.parquet(f"{base}/again")
    streaming_load.load_batch(spark.read.schema(schema).parquet(f"{base}/again"), 1, f"{base}/landed", store, algo="md5")
    rows = _fact_table(store)
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("Timestamp", "rowActivationDate")})


@query
def export_topics_query(spark, sf_dir):
    """The whole export, read back from its CSV files."""
    return _exported(spark, sf_dir, None)


@query
def export_topics_bounded(spark, sf_dir):
    """The export up to a listen event."""
    return _exported(spark, sf_dir, EXPORT_BOUND)


#: Fewer than the listens of the smallest test table.
EXPORT_BOUND = 500


def _exported(spark, sf_dir, listens: int | None) -> DataFrame:
    out = scratch_path(spark, "export")
    export_topics(testdata.messages(spark, sf_dir), out, ["position"], listens)
    ids = "itemInSession bigint, userId bigint, sessionId bigint, ts bigint"
    rows = [
        spark.read.option("header", True).csv(f"{out}/{t}").select(
            F.lit(t).alias("topic"),
            *[F.col(c.split()[0]).cast(c.split()[1]).alias(c.split()[0]) for c in ids.split(", ")],
        )
        for t in TOPICS
    ]
    union = rows[0]
    for more in rows[1:]:
        union = union.unionByName(more)
    return union
