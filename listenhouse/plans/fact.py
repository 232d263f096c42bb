"""The listening fact table: features, star join, de-duplication, validity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from listenhouse.functions.keys import artist_key, location_key, song_key, surrogate_key
from listenhouse.functions.time import date_key, forever, gap_seconds, hour_start, time_parts
from listenhouse.operators.as_of import AS_OF, as_of
from listenhouse.operators.dedup import first_row
from listenhouse.operators.hot_keys import HotKeys
from listenhouse.operators.neighbours import NEXT, PREV, neighbours
from listenhouse.operators.scd import current
from listenhouse.schemas import FACT_DEDUP_KEY, FACT_VALIDITY_KEY, LOCATION_KEY_SQL

SKIP_BELOW_SECONDS = 30
MEASURES = (
    "streamCount", "isSongSkipped", "isMoving", "isFirstListenEvent", "isLastListenEvent",
    "nextListenEventTimeGap", "consecutiveNoSong",
)

#: Features that depend on the listen before (is_first: known to the first of a day) or behind (is_last).
FEATURES = {
    "isMoving": "is_first", "isFirstListenEvent": "is_first", "isLastListenEvent": "is_last", "nextListenEventTimeGap": "is_last",
}


# --- features --------------------------------------------------------------

def song_skipped(duration: str = "duration") -> Column:
    """1 when played for less than 30 seconds; unknown duration counts as played."""
    return F.when(F.col(duration).cast("double") < SKIP_BELOW_SECONDS, 1).otherwise(0)


def is_moving(rule: str = "all") -> Column:
    """0 when the place is the one of the listen before.

    ``all``: latitude and longitude both equal; ``any``: one of them is enough.
    The first listen, and unknown coordinates, count as moving.
    """
    same_lat = F.col(f"{PREV}.lat") == F.col("lat")
    same_lon = F.col(f"{PREV}.lon") == F.col("lon")
    same = {"all": same_lat & same_lon, "any": same_lat | same_lon}[rule]
    return F.when(same, 0).otherwise(1)


def listen_features(
    events: DataFrame,
    tiebreak: Sequence[str],
    rule: str = "all",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Per-listen features, in the order of each user's listens.

    All of them come from one window: one exchange on the user, one sort.
    """
    rows = neighbours(
        events, ["userId"], ["ts", *tiebreak], prev=["ts", "lat", "lon"], next=["ts"], hot=hot
    )
    # `prev.ts is null` is also true for a previous row without a time.
    return rows.withColumns({
        "streamCount": F.lit(1),
        "isSongSkipped": song_skipped(),
        "isMoving": is_moving(rule),
        "isFirstListenEvent": F.when(F.col(f"{PREV}.ts").isNull(), 1).otherwise(0),
        "isLastListenEvent": F.when(F.col(f"{NEXT}.ts").isNull(), 1).otherwise(0),
        "nextListenEventTimeGap": gap_seconds(F.col("ts"), F.col(f"{NEXT}.ts")),
        "consecutiveNoSong": F.lit(0),
    }).drop(PREV, NEXT)


# --- star join -------------------------------------------------------------

def event_keys(algo: str = "md5") -> dict[str, Column]:
    """The surrogate keys an event refers to, as columns (not join
    expressions, which would be computed again by exchange, sort and join)."""
    return {
        "artistRef": artist_key(algo), "songRef": song_key(algo),
        "locationRef": location_key(algo), "hourRef": hour_start("ts"),
    }


def lookup(events: DataFrame, dim: DataFrame, ref: str, dim_key: str, name: str) -> DataFrame:
    """Left join that adds ``name``: the dimension key, null if unknown.

    The dimension is reduced to its key first. Whether it is broadcast is left
    to the size Catalyst and AQE see; a hot key in a shuffled join is split by
    AQE's skew join.
    """
    keys = dim.select(F.col(dim_key).alias(name))
    return events.join(keys, F.col(ref) == F.col(name), "left")


def join_user(events: DataFrame, users: DataFrame) -> DataFrame:
    return lookup(events, current(users), "userId", "userId", "UserKey")


def join_artist(events: DataFrame, artists: DataFrame) -> DataFrame:
    return lookup(events, current(artists), "artistRef", "artistId", "ArtistKey")


def join_song(events: DataFrame, songs: DataFrame) -> DataFrame:
    return lookup(events, current(songs), "songRef", "songId", "SongKey")


def join_location(events: DataFrame, locations: DataFrame) -> DataFrame:
    return lookup(events, current(locations), "locationRef", "locationId", "LocationKey")


def join_session(events: DataFrame, sessions: DataFrame) -> DataFrame:
    return lookup(events, current(sessions), "sessionId", "sessionId", "SessionKey")


def join_calendar(events: DataFrame, calendar: DataFrame) -> DataFrame:
    """By the hour's timestamp."""
    return lookup(events, calendar, "hourRef", "datetime", "DateKey")


def join_calendar_datekey(events: DataFrame, calendar: DataFrame) -> DataFrame:
    """By the numeric yyyyMMddHH key."""
    dated = events.withColumn("dateRef", date_key("ts"))
    return lookup(dated, calendar, "dateRef", "DateKey", "DateKey").drop("dateRef")


def join_user_as_of(events: DataFrame, versions: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """The version of the user valid at the event: ``UserKey``, ``UserVersion`` (the key of the version), ``UserLevel``.

    All three are null before the user's first version. A hot user is split in the merge of both sides.
    """
    rows = as_of(events, versions, ["userId"], ["ts"], ["rowActivationDate"], ["userId", "userKey", "level"], hot)
    found = {"UserKey": "userId", "UserVersion": "userKey", "UserLevel": "level"}
    return rows.withColumns({name: F.col(f"{AS_OF}.{c}") for name, c in found.items()}).drop(AS_OF)


def join_artist_as_of(events: DataFrame, versions: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """``ArtistVersion``: the key of the artist's version valid at the event."""
    rows = as_of(events, versions, ["artist"], ["ts"], ["rowActivationDate"], ["artistKey"], hot)
    return rows.withColumn("ArtistVersion", F.col(f"{AS_OF}.artistKey")).drop(AS_OF)


def star_join(
    features: DataFrame, dims: Mapping[str, DataFrame], algo: str = "md5"
) -> DataFrame:
    """Six left joins. User first: it finds the rows already partitioned by
    user; the small calendar before the larger tables."""
    df = features.withColumns(event_keys(algo))
    df = join_user(df, dims["user"])
    df = join_calendar(df, dims["datetime"])
    df = join_artist(df, dims["artist"])
    df = join_song(df, dims["song"])
    df = join_location(df, dims["location"])
    return join_session(df, dims["session"])


# --- fact ------------------------------------------------------------------

def dedup_facts(facts: DataFrame, tiebreak: Sequence[str]) -> DataFrame:
    return first_row(facts, FACT_DEDUP_KEY, list(tiebreak))


def fact_validity(
    facts: DataFrame, tiebreak: Sequence[str], hot: HotKeys | None = None
) -> DataFrame:
    """Validity per user, artist, song, location and hour."""
    rows = neighbours(
        facts, FACT_VALIDITY_KEY, ["Timestamp", *tiebreak], next=["Timestamp"], hot=hot
    )
    is_last = F.col(NEXT).isNull()
    return rows.withColumns({
        "rowActivationDate": F.col("Timestamp"),
        "rowExpirationDate": F.when(is_last, forever(facts, "Timestamp")).otherwise(
            F.col(f"{NEXT}.Timestamp")
        ),
        "currRow": F.when(is_last, 1).otherwise(0),
    }).drop(NEXT)


def validity_keys(events: DataFrame, algo: str = "md5") -> DataFrame:
    """The validity key of every event without the joins: what to measure for
    hot keys before the fact exists."""
    refs = events.withColumns(event_keys(algo))
    return refs.select(
        F.col("userId").alias("UserKey"), F.col("artistRef").alias("ArtistKey"),
        F.col("songRef").alias("SongKey"), F.col("locationRef").alias("LocationKey"),
        F.col("hourRef").alias("DateKey"), F.col("ts").alias("Timestamp"), "*",
    )


def fact_rows(
    events: DataFrame,
    dims: Mapping[str, DataFrame],
    tiebreak: Sequence[str],
    rule: str = "all",
    algo: str = "md5",
    detailed: bool = False,
    hot_users: HotKeys | None = None,
) -> DataFrame:
    """The fact before its validity: six keys, time, measures, tiebreak; de-duplicated."""
    return fact_rows_of(listen_features(events, tiebreak, rule, hot_users), dims, tiebreak, algo, detailed)


def fact_rows_of(
    features: DataFrame, dims: Mapping[str, DataFrame], tiebreak: Sequence[str], algo: str = "md5", detailed: bool = False
) -> DataFrame:
    """The same from events that have their features."""
    joined = star_join(features, dims, algo).withColumnRenamed("ts", "Timestamp")
    extra: list[Column] = []
    if detailed:
        extra = [F.col("duration").cast("double").alias("duration")]
        extra += [c.alias(name) for name, c in time_parts("Timestamp", clock=True).items()]
    rows = joined.select(
        "UserKey", "ArtistKey", "SongKey", "DateKey", "LocationKey", "SessionKey",
        "Timestamp", *MEASURES, *extra, *tiebreak,
    )
    return dedup_facts(rows, tiebreak)


def fact_streams(
    events: DataFrame,
    dims: Mapping[str, DataFrame],
    tiebreak: Sequence[str],
    rule: str = "all",
    algo: str = "md5",
    detailed: bool = False,
    hot_users: HotKeys | None = None,
    hot_facts: HotKeys | None = None,
) -> DataFrame:
    """One row per listen: six keys, the measures, the validity interval.

    ``detailed`` adds the duration and the parts of the event time.
    """
    rows = fact_rows(events, dims, tiebreak, rule, algo, detailed, hot_users)
    return fact_validity(rows, tiebreak, hot_facts).drop(*tiebreak)


# --- natural-key form ------------------------------------------------------

def natural_dims(events: DataFrame) -> dict[str, DataFrame]:
    """Dimensions unique on the attributes the SQL model joins by.

    The first-seen row per artist name and per city and state stands for all
    versions, so that the joins cannot multiply events.
    """
    artists = events.where("artist is not null").groupBy("artist").agg(
        F.min("ts").alias("rowActivationDate")
    )
    # Distinct places by hash first; the struct is compared on those few only.
    seen = events.groupBy("city", "state", "zip", "lat", "lon").agg(F.min("ts").alias("ts"))
    places = seen.groupBy("city", "state").agg(
        F.min(F.struct("ts", "zip", "lat", "lon")).alias("seen")
    ).select("city", "state", "seen.*")
    songs = events.select("song", "artist").distinct()
    return {
        "artist": artists.select(
            "artist", surrogate_key(["artist", "rowActivationDate"]).alias("ArtistKey")
        ),
        "location": places.select(
            "city", "state", surrogate_key(LOCATION_KEY_SQL).alias("LocationKey")
        ),
        "song": songs.select("song", "artist", song_key().alias("SongKey")),
    }


def fact_streams_natural(
    events: DataFrame,
    natural: Mapping[str, DataFrame],
    calendar: DataFrame,
    sessions: DataFrame,
    tiebreak: Sequence[str],
    hot: HotKeys | None = None,
) -> DataFrame:
    """The SQL-model fact: joined by natural attributes, distinct rows.

    Features come from the raw events, before any join can repeat a listen.
    """
    df = listen_features(events, tiebreak, hot=hot).withColumn("hourRef", hour_start("ts"))
    df = df.join(natural["song"], ["song", "artist"], "left")
    df = df.join(natural["artist"], ["artist"], "left")
    df = df.join(natural["location"], ["city", "state"], "left")
    df = join_session(join_calendar(df, calendar), sessions)
    return df.select(
        F.col("userId").alias("UserKey"), "SongKey", "ArtistKey", "LocationKey", "DateKey",
        "SessionKey", F.col("ts").alias("Timestamp"),
        F.col("duration").cast("double").alias("duration"),
        *[m for m in MEASURES if m != "consecutiveNoSong"],
        *[c.alias(name) for name, c in time_parts("ts", clock=True).items()],
    ).distinct()
