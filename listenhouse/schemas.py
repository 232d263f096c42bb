"""Fixed schemas: the four topics, and the columns of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

# --- fixed values: topic names and the fields of their messages ------------
# `ts` and `registration` are epoch milliseconds on the wire; every id is a
# bigint.
_CONTEXT = (
    "ts BIGINT, sessionId BIGINT, level STRING, itemInSession BIGINT, "
    "city STRING, zip STRING, state STRING, userAgent STRING, lon DOUBLE, lat DOUBLE, "
    "userId BIGINT, lastName STRING, firstName STRING, gender STRING, registration BIGINT"
)
_TRACK = "artist STRING, song STRING, duration DOUBLE"

TOPICS: dict[str, str] = {
    "listen_events": f"{_TRACK}, auth STRING, {_CONTEXT}",
    "page_view_events": f"{_TRACK}, auth STRING, page STRING, method STRING, status INT, {_CONTEXT}",
    "auth_events": f"success BOOLEAN, {_CONTEXT}",
    "status_change_events": f"auth STRING, {_CONTEXT}",
}

# Topics whose song and artist arrive with damaged encoding.
REPAIRED = {
    "listen_events": ("song", "artist"),
    "page_view_events": ("song", "artist"),
}

TIME_PARTS = ("year", "month", "day", "hour")
FOREVER = "9999-12-31 00:00:00"

# Attributes that make up each surrogate key, in order.
SONG_KEY = ("song", "artist")
ARTIST_KEY = ("artist", "lat", "lon", "city", "state")
LOCATION_KEY = ("city", "zip", "state", "lat", "lon")
LOCATION_KEY_SQL = ("city", "state", "zip", "lat", "lon")

USER_ATTRIBUTES = (
    "firstName", "lastName", "gender", "level", "registration",
    "city", "zip", "state", "lon", "lat", "userAgent",
)
FACT_DEDUP_KEY = ("UserKey", "ArtistKey", "SongKey", "SessionKey", "DateKey", "Timestamp")
FACT_VALIDITY_KEY = ("UserKey", "ArtistKey", "SongKey", "LocationKey", "DateKey")
FACT_LOAD_KEY = (*FACT_VALIDITY_KEY, "rowActivationDate")
# ---------------------------------------------------------------------------


def message_schema(topic: str) -> T.StructType:
    """Schema of one topic's JSON message, as sent (`ts` in milliseconds)."""
    return T.StructType.fromDDL(TOPICS[topic])


def landed_schema(topic: str) -> T.StructType:
    """Schema of the landed table: `ts` as timestamp, plus the time parts."""
    fields = [
        T.StructField(f.name, T.TimestampType()) if f.name == "ts" else f
        for f in message_schema(topic)
    ]
    parts = [T.StructField(p, T.IntegerType()) for p in TIME_PARTS]
    return T.StructType(fields + parts)


def project_schema(schema: T.StructType, columns) -> T.StructType:
    """The part of a schema a job reads, so the scan prunes the rest."""
    return T.StructType([schema[c] for c in columns])


def type_of(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType
