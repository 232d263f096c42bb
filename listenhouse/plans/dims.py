"""Dimension builders. Each takes listen events and returns the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from listenhouse.functions.keys import artist_key, location_key, song_key, surrogate_key
from listenhouse.functions.time import date_key
from listenhouse.operators.dedup import first_seen, last_row
from listenhouse.operators.hot_keys import HotKeys
from listenhouse.operators.neighbours import NEXT, neighbours
from listenhouse.operators.scd import VALIDITY, first_version, scd2_changes, versions
from listenhouse.schemas import ARTIST_KEY, LOCATION_KEY, SONG_KEY, USER_ATTRIBUTES

USER_COLUMNS = ("userId", *USER_ATTRIBUTES[:4], "eventTimestamp", *USER_ATTRIBUTES[4:])


def user_base(events: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """User attributes of every event, typed; ``carry`` keeps tiebreak columns."""
    typed = {
        "userId": F.col("userId").cast("bigint"),
        "eventTimestamp": F.col("ts"),
        "registration": F.col("registration").cast("bigint"),
    }
    return events.select(
        *[typed.get(c, F.col(c)).alias(c) for c in USER_COLUMNS],
        *[c for c in carry if c not in USER_COLUMNS],
    )


def _user_tiebreak(tiebreak: Sequence[str]) -> list[str]:
    return list(tiebreak) or list(USER_ATTRIBUTES)


def scd_user_versions(
    events: DataFrame, tiebreak: Sequence[str] = (), hot: HotKeys | None = None
) -> DataFrame:
    """Every event of a user as a version of that user."""
    return versions(
        user_base(events, tiebreak), ["userId"], "eventTimestamp", _user_tiebreak(tiebreak), hot
    ).select(*USER_COLUMNS, *VALIDITY)


def dim_user(events: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Latest version per user.

    The current version is the last row, so no lead() is needed: the last row
    per user is found with map-side pruning and gets the open interval.
    """
    order = ["eventTimestamp", *_user_tiebreak(tiebreak)]
    latest = last_row(user_base(events, tiebreak), ["userId"], order)
    return first_version(latest, "eventTimestamp").select(*USER_COLUMNS, *VALIDITY)


def _once(events: DataFrame, key: str, tiebreak: Sequence[str], hot: HotKeys | None) -> DataFrame:
    """The last event of a key and time: what states are, at that time."""
    rows = neighbours(events, [key], ["ts", *tiebreak], next=["ts"], hot=hot)
    return rows.where(F.col(NEXT).isNull() | ~F.col(f"{NEXT}.ts").eqNullSafe(F.col("ts"))).drop(NEXT)


def user_levels(events: DataFrame, tiebreak: Sequence[str], hot: HotKeys | None = None) -> DataFrame:
    """Versioned user dimension: a row per change of level, with intervals that tile."""
    once = _once(events.select("userId", "ts", "level", *tiebreak), "userId", tiebreak, hot)
    rows = scd2_changes(once, ["userId"], ["level"], "ts", list(tiebreak), hot)
    return rows.select("userId", "level", *VALIDITY).withColumn("userKey", surrogate_key(["userId", "rowActivationDate"]))


def artist_places(events: DataFrame, tiebreak: Sequence[str], hot: HotKeys | None = None) -> DataFrame:
    """Versioned artist dimension: a row per change of place."""
    named = events.where(F.col("artist").isNotNull()).select(*ARTIST_KEY, "ts", *tiebreak)
    once = _once(named, "artist", tiebreak, hot)
    rows = scd2_changes(once, ["artist"], list(ARTIST_KEY[1:]), "ts", list(tiebreak), hot)
    return rows.select(*ARTIST_KEY, *VALIDITY).withColumn("artistKey", surrogate_key(["artist", "rowActivationDate"]))


def songs(events: DataFrame, algo: str = "md5") -> DataFrame:
    """Songs, each with the duration of its first play."""
    return first_seen(events, SONG_KEY, song_key(algo), "songId", payload="duration")


def artists(events: DataFrame, algo: str = "md5") -> DataFrame:
    return first_seen(events, ARTIST_KEY, artist_key(algo), "artistId")


def locations(events: DataFrame, algo: str = "md5", key: Column | None = None) -> DataFrame:
    return first_seen(
        events, LOCATION_KEY, location_key(algo) if key is None else key, "locationId"
    )


def dim_song(events: DataFrame, algo: str = "md5") -> DataFrame:
    return first_version(songs(events, algo))


def dim_artist(events: DataFrame, algo: str = "md5", epoch: bool = False) -> DataFrame:
    return first_version(artists(events, algo), epoch=epoch)


def dim_location(events: DataFrame, algo: str = "md5", epoch: bool = False) -> DataFrame:
    return first_version(locations(events, algo), epoch=epoch)


def session_bounds(events: DataFrame) -> DataFrame:
    """First and last listen of every session."""
    return events.groupBy("sessionId").agg(
        F.min("ts").alias("startTimestamp"), F.max("ts").alias("endTimestamp")
    )


def dim_session(events: DataFrame) -> DataFrame:
    """Sessions with their bounds as text and as timestamps."""
    return session_rows(session_bounds(events))


def session_rows(bounds: DataFrame) -> DataFrame:
    """The dimension from (sessionId, startTimestamp, endTimestamp)."""
    bounds = bounds.select(
        "sessionId",
        F.col("startTimestamp").cast("string").alias("startTime"),
        F.col("endTimestamp").cast("string").alias("endTime"),
        "startTimestamp", "endTimestamp",
    )
    return first_version(bounds, "startTimestamp")


def session_changes(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """Sessions of the ``later`` load, flagged where the bounds differ from
    the ``earlier`` one. Within one load a session has one row, so the flag
    can only mean something across loads."""
    before = earlier.select(
        F.col("sessionId").alias("__id"),
        F.col("startTime").alias("prevStartTime"), F.col("endTime").alias("prevEndTime"),
    )
    differs = (F.col("prevStartTime") != F.col("startTime")) | (
        F.col("prevEndTime") != F.col("endTime")
    )
    return (
        later.join(before, F.col("sessionId") == F.col("__id"), "left")
        .select(
            "sessionId", "startTime", "endTime", "prevStartTime", "prevEndTime",
            F.when(differs, 1).otherwise(0).alias("isSessionChanged"),
        )
    )


def _week(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def sunday_week(c: str) -> Column:
    """Week of the year counted from the first Sunday, 0 to 53."""
    return F.floor((F.dayofyear(c) + 7 - F.dayofweek(c)) / 7).cast("int")


def dim_datetime(hours: DataFrame) -> DataFrame:
    """Calendar attributes of every hour; one projection, no chain."""
    t, week = "datetime", F.weekofyear("datetime")
    fmt = lambda pattern: F.date_format(t, pattern)
    return hours.select(
        t,
        fmt("yyyyMMdd").cast("int").alias("DateSK"),
        F.year(t).alias("Year"),
        F.quarter(t).alias("Quarter"),
        F.month(t).alias("Month"),
        F.dayofmonth(t).alias("Day"),
        week.alias("Week"),
        fmt("QQQQ").alias("QuarterNameLong"),
        fmt("QQQ").alias("QuarterNameShort"),
        fmt("QQ").alias("QuarterNumberString"),
        *_month_and_day_names(),
        *_week_names(week),
        *_day_and_clock(),
        date_key(t).alias("DateKey"),
    )


def dim_datetime_sql(hours: DataFrame) -> DataFrame:
    """The calendar with 'Q1' style quarters and Sunday-based weeks."""
    t, week = "datetime", sunday_week("datetime")
    quarter = F.quarter(t).cast("string")
    return hours.select(
        t,
        F.date_format(t, "yyyyMMdd").cast("int").alias("DateSK"),
        F.year(t).alias("Year"),
        F.quarter(t).alias("Quarter"),
        F.month(t).alias("Month"),
        F.dayofmonth(t).alias("Day"),
        week.alias("Week"),
        F.concat(F.lit("Q"), quarter).alias("QuarterNameLong"),
        F.concat(F.lit("Q"), quarter).alias("QuarterNameShort"),
        quarter.alias("QuarterNumberString"),
        *_month_and_day_names(),
        *_week_names(week),
        *_day_and_clock(),
    )


def _month_and_day_names() -> list[Column]:
    patterns = {
        "MonthNameLong": "MMMM", "MonthNameShort": "MMM", "MonthNumberString": "MM",
        "DayNumberString": "dd", "YearMonthString": "yyyy/MM",
        "DayOfWeekNameLong": "EEEE", "DayOfWeekNameShort": "EEE",
    }
    return [F.date_format("datetime", p).alias(name) for name, p in patterns.items()]


def _week_names(week: Column) -> list[Column]:
    return [
        F.concat(F.lit("week"), _week(week)).alias("WeekNameLong"),
        F.concat(F.lit("w"), _week(week)).alias("WeekNameShort"),
        _week(week).alias("WeekNumberString"),
    ]


def _day_and_clock() -> list[Column]:
    t = "datetime"
    return [
        F.dayofweek(t).alias("DayOfWeek"),
        F.dayofmonth(t).alias("DayOfMonth"),
        F.dayofyear(t).alias("DayOfYear"),
        F.hour(t).alias("Hour"), F.minute(t).alias("Minute"), F.second(t).alias("Second"),
    ]
