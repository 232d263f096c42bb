"""The dimensions in their SQL-model form: one row per observed change.

These follow the models literally where their result differs from a textbook
history: an interval ends at the next *event*, not the next change, and the
current flag marks only changes that happened in a key's last event. The
textbook form is ``scd2_changes``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from listenhouse.functions.keys import song_key, surrogate_key
from listenhouse.functions.time import forever
from listenhouse.operators.hot_keys import HotKeys
from listenhouse.operators.joins import not_in
from listenhouse.operators.neighbours import NEXT, PREV, neighbours
from listenhouse.plans.dims import session_bounds
from listenhouse.schemas import LOCATION_KEY_SQL, type_of

NO_VALUE = "NA"
_USER = ("userId", "firstName", "lastName", "gender", "level", "registration")
_ARTIST = {
    "artistName": "artist", "latitude": "lat", "longitude": "lon", "location": "city",
    "state": "state",
}


def _differs(column: str, default: str | None = None) -> Column:
    """lag(column, 1, default) <> column, false where either side is null."""
    before = F.col(f"{PREV}.{column}")
    if default is not None:
        before = F.when(F.col(PREV).isNull(), F.lit(default)).otherwise(before)
    return F.coalesce(before != F.col(column), F.lit(False))


def _next_event(df: DataFrame) -> Column:
    return F.when(F.col(NEXT).isNull(), forever(df, "ts")).otherwise(F.col(f"{NEXT}.ts"))


def _history(changes: DataFrame, columns: Sequence[str], flag: str) -> DataFrame:
    """Change rows only, with the interval columns."""
    end = forever(changes, "nextEventTimestamp")
    return changes.where(F.col(flag) == 1).select(
        *columns,
        F.col("eventTimestamp").alias("rowActivationDate"),
        F.col("nextEventTimestamp").alias("rowExpirationDate"),
        F.when(F.col("nextEventTimestamp") == end, 1).otherwise(0).alias("currentRow"),
    )


def _open_interval(groups: DataFrame, columns: Sequence[str], ts_type) -> DataFrame:
    """Initial states: from the first day on, still open."""
    return groups.select(
        *columns,
        F.col("first").cast("date").cast(ts_type).alias("rowActivationDate"),
        F.lit("9999-12-31 00:00:00").cast(ts_type).alias("rowExpirationDate"),
        F.lit(1).alias("currentRow"),
    )


# --- users -----------------------------------------------------------------

def user_level_changes(
    events: DataFrame, tiebreak: Sequence[str], hot: HotKeys | None = None
) -> DataFrame:
    """Events of real users (id other than 0) with a level-change flag."""
    real = events.where(F.col("userId") != 0)
    rows = neighbours(
        real, ["userId"], ["ts", *tiebreak], prev=["level"], next=["ts"], hot=hot
    )
    return rows.select(
        *_USER[:-1],
        F.col("registration").cast("bigint").alias("registration"),
        F.col("ts").alias("eventTimestamp"),
        _next_event(rows).alias("nextEventTimestamp"),
        F.when(_differs("level", NO_VALUE), 1).otherwise(0).alias("levelChanged"),
    )


def user_level_history(changes: DataFrame) -> DataFrame:
    return _history(changes, _USER, "levelChanged")


def user_initial_state(events: DataFrame, changes: DataFrame) -> DataFrame:
    """Users absent from the change rows. Grouped before the anti join, so the
    join moves one row per attribute set, not one per event."""
    groups = events.groupBy(*_USER).agg(F.min("ts").alias("first"))
    absent = not_in(groups, changes, "userId")
    return _open_interval(absent, _USER, type_of(events, "ts"))


def dim_user_sql(
    events: DataFrame, tiebreak: Sequence[str], hot: HotKeys | None = None
) -> DataFrame:
    return dim_user_of(events, user_level_changes(events, tiebreak, hot))


def dim_user_of(events: DataFrame, changes: DataFrame) -> DataFrame:
    """The dimension from change rows that are known."""
    rows = user_level_history(changes).unionByName(user_initial_state(events, changes))
    key = surrogate_key(["userId", "rowActivationDate", "level"])
    return rows.withColumn("userKey", key)


# --- artists ---------------------------------------------------------------

def artist_changes(
    events: DataFrame, tiebreak: Sequence[str], hot: HotKeys | None = None
) -> DataFrame:
    """Events with an artist, flagged where any artist attribute changed."""
    named = events.where(F.col("artist").isNotNull())
    attributes = list(_ARTIST.values())
    rows = neighbours(
        named, ["artist"], ["ts", *tiebreak], prev=attributes, next=["ts"], hot=hot
    )
    flag = _differs("artist", NO_VALUE)
    for c in attributes[1:]:
        flag |= _differs(c)
    return rows.select(
        *[F.col(c).alias(name) for name, c in _ARTIST.items()],
        F.col("ts").alias("eventTimestamp"),
        _next_event(rows).alias("nextEventTimestamp"),
        F.when(flag, 1).otherwise(0).alias("artistChanged"),
    )


def artist_history(changes: DataFrame) -> DataFrame:
    return _history(changes, list(_ARTIST), "artistChanged")


def artist_initial_state(events: DataFrame, changes: DataFrame) -> DataFrame:
    groups = events.groupBy(
        *[F.col(c).alias(name) for name, c in _ARTIST.items()]
    ).agg(F.min("ts").alias("first"))
    absent = not_in(groups, changes, "artistName")
    return _open_interval(absent, list(_ARTIST), type_of(events, "ts"))


def dim_artist_sql(
    events: DataFrame, tiebreak: Sequence[str], hot: HotKeys | None = None
) -> DataFrame:
    return dim_artist_of(events, artist_changes(events, tiebreak, hot))


def dim_artist_of(events: DataFrame, changes: DataFrame) -> DataFrame:
    """The dimension from change rows that are known."""
    rows = artist_history(changes).unionByName(artist_initial_state(events, changes))
    return rows.withColumn("artistKey", surrogate_key(["artistName", "rowActivationDate"]))


# --- songs, locations, sessions --------------------------------------------

def dim_song_sql(events: DataFrame) -> DataFrame:
    """Distinct song, artist and duration: several rows per key possible."""
    distinct = events.select("song", "artist", "duration").distinct()
    return distinct.select(song_key().alias("songId"), "song", "artist", "duration")


def dim_location_sql(events: DataFrame) -> DataFrame:
    """One row per event, not de-duplicated."""
    return events.select(
        surrogate_key(LOCATION_KEY_SQL).alias("locationKey"),
        "city", "zip", "state",
        F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
        F.col("ts").alias("timestamp"),
    )


def dim_session_sql(events: DataFrame) -> DataFrame:
    return session_bounds(events).select(
        "sessionId",
        F.col("startTimestamp").cast("string").alias("startTime"),
        F.col("endTimestamp").cast("string").alias("endTime"),
    )
