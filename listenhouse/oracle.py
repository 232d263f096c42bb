"""The same queries as SQL over the same Parquet tables, written on their own.

Plain SQL for DuckDB: no chunks, no helper columns; windows and joins as the
tables are defined. Column names equal those of the Spark queries.
"""

from __future__ import annotations

END = "'9999-12-31 00:00:00'"
EARLY = "TIMESTAMP '2024-01-01 06:00:00'"
MIDDLE = "TIMESTAMP '2024-01-16 12:00:00'"

VIEW = """
    SELECT e.event_id, e.ts, e.user_id AS userId,
           e.user_id * 100 + CAST(day(e.ts) AS INTEGER) AS sessionId,
           CASE WHEN e.event_type = 'purchase' THEN 'paid' ELSE 'free' END AS level,
           e.event_type, e.value AS duration, p.p_name AS song, p.p_brand AS artist,
           n.n_name AS city, r.r_name AS state,
           lpad(CAST(10000 + n.n_nationkey * 37 AS VARCHAR), 5, '0') AS zip,
           CAST(n.n_nationkey AS DOUBLE) * 1.5 AS lat,
           CAST(n.n_regionkey AS DOUBLE) * 2.5 - 100.0 AS lon,
           split_part(c.c_name, '#', 1) AS firstName,
           split_part(c.c_name, '#', 2) AS lastName,
           CASE WHEN e.user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
           CAST(1640995200000 + e.user_id * 86400000 AS BIGINT) AS registration,
           c.c_mktsegment AS userAgent
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
    LEFT JOIN customer c ON c.c_custkey = e.user_id
    LEFT JOIN part p ON p.p_partkey = e.k
    LEFT JOIN nation n ON n.n_nationkey = e.k % 25
    LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
"""
LISTEN = f"""listen AS (
    SELECT * FROM ({VIEW}) WHERE event_type IN ('view', 'click', 'purchase'))"""

# Messages carry milliseconds.
LISTEN_MILLIS = LISTEN.replace("SELECT * FROM", "SELECT * REPLACE (make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts) FROM")


def _md5(*columns: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


def _i(expression: str) -> str:
    return f"CAST({expression} AS INTEGER)"


SONG_ID = _md5("song", "artist")
ARTIST_ID = _md5("artist", "lat", "lon", "city", "state")
LOCATION_ID = _md5("city", "zip", "state", "lat", "lon")
LOCATION_SQL_ID = _md5("city", "state", "zip", "lat", "lon")
HOUR = "date_trunc('hour', ts)"
DATE_KEY = f"""CAST(year(ts) * 1000000 + month(ts) * 10000 + day(ts) * 100 + hour(ts) AS BIGINT)"""
PARTS = ", ".join(
    f"{_i(f'{p}(ts)')} AS {p}" for p in ("year", "month", "day", "hour", "minute", "second")
)
USER = """userId, firstName, lastName, gender, level, ts AS eventTimestamp, registration,
    city, zip, state, lon, lat, userAgent"""

FEATURES = """features AS (
    SELECT *,
        1 AS streamCount,
        CASE WHEN duration < 30 THEN 1 ELSE 0 END AS isSongSkipped,
        CASE WHEN lag(lat) OVER w = lat AND lag(lon) OVER w = lon THEN 0 ELSE 1 END AS isMoving,
        CASE WHEN lag(lat) OVER w = lat OR lag(lon) OVER w = lon THEN 0 ELSE 1 END AS isMovingAny,
        CASE WHEN lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS isFirstListenEvent,
        CASE WHEN lead(ts) OVER w IS NULL THEN 1 ELSE 0 END AS isLastListenEvent,
        CAST(floor(epoch(lead(ts) OVER w)) - floor(epoch(ts)) AS BIGINT) AS nextListenEventTimeGap,
        0 AS consecutiveNoSong
    FROM listen WINDOW w AS (PARTITION BY userId ORDER BY ts, event_id))"""
MEASURES = """streamCount, isSongSkipped, isMoving, isFirstListenEvent, isLastListenEvent,
    nextListenEventTimeGap, consecutiveNoSong"""


def _from_listen(select: str, rest: str = "") -> str:
    return f"WITH {LISTEN} SELECT {select} FROM listen {rest}"


def _features(columns: str) -> str:
    return f"WITH {LISTEN}, {FEATURES} SELECT {columns} FROM features"


# --- dimensions: one row per key, the earliest -----------------------------

def _first(key: str, name: str, columns: str, source: str = "listen") -> str:
    return f"""
        SELECT {key} AS {name}, {columns}, ts FROM {source}
        QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY ts, {columns}) = 1"""


def _songs(source: str = "listen") -> str:
    return _first(SONG_ID, "songId", "song, artist, duration", source)


def _artists(source: str = "listen") -> str:
    return _first(ARTIST_ID, "artistId", "artist, lat, lon, city, state", source)


def _locations(source: str = "listen") -> str:
    return _first(LOCATION_ID, "locationId", "city, zip, state, lat, lon", source)


def _sessions(source: str = "listen") -> str:
    return f"SELECT sessionId, min(ts) AS s, max(ts) AS e FROM {source} GROUP BY sessionId"


def _users(source: str = "listen") -> str:
    return f"""
        SELECT {USER} FROM {source}
        QUALIFY row_number() OVER (PARTITION BY userId ORDER BY ts DESC, event_id DESC) = 1"""


VALID = f"{END} AS rowExpirationDate, 1 AS currRow"
KNOWN = f"early AS (SELECT * FROM listen WHERE ts < {EARLY})"
SESSION_TEXT = "CAST(s AS VARCHAR) AS startTime, CAST(e AS VARCHAR) AS endTime"


def _dim(rows: str) -> str:
    return f"WITH {LISTEN} SELECT *, ts AS rowActivationDate, {VALID} FROM ({rows})"


def _new(rows, key: str, activation: str) -> str:
    return f"""WITH {LISTEN}, {KNOWN}
        SELECT *, {activation} AS rowActivationDate, {VALID} FROM ({rows('listen')})
        WHERE {key} NOT IN (SELECT {key} FROM ({rows('early')}))"""


USER_VERSIONS = f"""
    SELECT {USER}, ts AS rowActivationDate,
        coalesce(CAST(lead(ts) OVER w AS VARCHAR), {END}) AS rowExpirationDate,
        CASE WHEN lead(ts) OVER w IS NULL THEN 1 ELSE 0 END AS currRow
    FROM (SELECT * FROM listen
          QUALIFY row_number() OVER (PARTITION BY userId, ts ORDER BY event_id DESC) = 1)
    WINDOW w AS (PARTITION BY userId ORDER BY ts)"""

# --- SQL-model history -----------------------------------------------------

U = "userId, firstName, lastName, gender, level, registration"
LEVEL_CHANGES = f"""changes AS (
    SELECT {U}, ts AS eventTimestamp,
        coalesce(CAST(lead(ts) OVER w AS VARCHAR), {END}) AS nextEventTimestamp,
        CASE WHEN lag(level, 1, 'NA') OVER w <> level THEN 1 ELSE 0 END AS levelChanged
    FROM listen WHERE userId <> 0 WINDOW w AS (PARTITION BY userId ORDER BY ts, event_id))"""
A = "artistName, latitude, longitude, location, state"
ARTIST_CHANGES = f"""changes AS (
    SELECT artist AS artistName, lat AS latitude, lon AS longitude, city AS location, state,
        ts AS eventTimestamp,
        coalesce(CAST(lead(ts) OVER w AS VARCHAR), {END}) AS nextEventTimestamp,
        CASE WHEN lag(artist, 1, 'NA') OVER w <> artist OR lag(lat) OVER w <> lat
               OR lag(lon) OVER w <> lon OR lag(city) OVER w <> city
               OR lag(state) OVER w <> state THEN 1 ELSE 0 END AS artistChanged
    FROM listen WHERE artist IS NOT NULL
    WINDOW w AS (PARTITION BY artist ORDER BY ts, event_id))"""


def _history(columns: str, flag: str) -> str:
    return f"""SELECT {columns}, eventTimestamp AS rowActivationDate,
        nextEventTimestamp AS rowExpirationDate,
        CASE WHEN nextEventTimestamp = {END} THEN 1 ELSE 0 END AS currentRow
        FROM changes WHERE {flag} = 1"""


USER_INITIAL = f"""SELECT {U}, CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) AS rowActivationDate,
        {END} AS rowExpirationDate, 1 AS currentRow
    FROM listen WHERE userId NOT IN (SELECT DISTINCT userId FROM changes) GROUP BY {U}"""
ARTIST_INITIAL = f"""SELECT artist AS artistName, lat AS latitude, lon AS longitude,
        city AS location, state,
        CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) AS rowActivationDate,
        {END} AS rowExpirationDate, 1 AS currentRow
    FROM listen WHERE artist NOT IN (SELECT DISTINCT artistName FROM changes)
    GROUP BY artist, lat, lon, city, state"""

TILED = f"""WITH {LISTEN}, marked AS (
        SELECT event_id, ts, userId, level,
            lag(level) OVER (PARTITION BY userId ORDER BY ts, event_id) AS previous,
            row_number() OVER (PARTITION BY userId ORDER BY ts, event_id) AS n
        FROM listen),
    points AS (SELECT * FROM marked WHERE n = 1 OR previous IS DISTINCT FROM level)
    SELECT event_id, ts, userId, level, ts AS rowActivationDate,
        coalesce(CAST(lead(ts) OVER w AS VARCHAR), {END}) AS rowExpirationDate,
        CASE WHEN lead(ts) OVER w IS NULL THEN 1 ELSE 0 END AS currRow
    FROM points WINDOW w AS (PARTITION BY userId ORDER BY ts, event_id)"""



def _as_of(key: str, tracked: str, columns: str) -> str:
    """ASOF JOIN with the change history of the last event per key and time."""
    differs = " OR ".join(f"lag({c}) OVER w IS DISTINCT FROM {c}" for c in tracked.split(", "))
    return f"""WITH {LISTEN}, once AS (
        SELECT * FROM listen WHERE {key} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {key}, ts ORDER BY event_id DESC) = 1),
    versions AS (
        SELECT {key}, {tracked}, ts AS rowActivationDate FROM once
        WINDOW w AS (PARTITION BY {key} ORDER BY ts) QUALIFY row_number() OVER w = 1 OR {differs})
    SELECT {columns} FROM listen e ASOF LEFT JOIN versions v ON e.{key} = v.{key} AND e.ts >= v.rowActivationDate"""


USER_AS_OF = _as_of("userId", "level", f"""e.event_id, e.userId, v.userId AS UserKey,
    CASE WHEN v.userId IS NOT NULL THEN {_md5('v.userId', 'v.rowActivationDate')} END AS UserVersion, v.level AS UserLevel""")

# --- calendar --------------------------------------------------------------

HOURS = f"""WITH {LISTEN}, hours AS (
    SELECT unnest(generate_series(date_trunc('year', min(ts)),
        date_trunc('year', max(ts)) + INTERVAL 1 YEAR - INTERVAL 1 HOUR,
        INTERVAL 1 HOUR)) AS datetime FROM listen)"""
T = "datetime"


def _calendar(week: str, quarter_long: str, quarter_number: str, extra: str = "") -> str:
    week_text = f"lpad(CAST({week} AS VARCHAR), 2, '0')"
    return f"""{HOURS} SELECT datetime,
        CAST(strftime({T}, '%Y%m%d') AS INTEGER) AS DateSK,
        {_i(f'year({T})')} AS Year, {_i(f'quarter({T})')} AS Quarter,
        {_i(f'month({T})')} AS Month, {_i(f'day({T})')} AS Day, {_i(week)} AS Week,
        {quarter_long} AS QuarterNameLong,
        'Q' || quarter({T}) AS QuarterNameShort, {quarter_number} AS QuarterNumberString,
        strftime({T}, '%B') AS MonthNameLong, strftime({T}, '%b') AS MonthNameShort,
        strftime({T}, '%m') AS MonthNumberString, strftime({T}, '%d') AS DayNumberString,
        'week' || {week_text} AS WeekNameLong, 'w' || {week_text} AS WeekNameShort,
        {week_text} AS WeekNumberString,
        {_i(f'dayofweek({T}) + 1')} AS DayOfWeek,
        strftime({T}, '%Y/%m') AS YearMonthString,
        strftime({T}, '%A') AS DayOfWeekNameLong, strftime({T}, '%a') AS DayOfWeekNameShort,
        {_i(f'day({T})')} AS DayOfMonth, {_i(f'dayofyear({T})')} AS DayOfYear,
        {_i(f'hour({T})')} AS Hour, {_i(f'minute({T})')} AS Minute,
        {_i(f'second({T})')} AS Second {extra} FROM hours"""


# --- fact ------------------------------------------------------------------

def _keys(source: str) -> str:
    """Keys of features against dimensions built from ``source``."""
    return f"""joined AS (
        SELECT f.event_id, u.userId AS UserKey, a.artistId AS ArtistKey, s.songId AS SongKey,
            h.datetime AS DateKey, l.locationId AS LocationKey, se.sessionId AS SessionKey,
            f.ts AS Timestamp, f.*
        FROM (SELECT *, {ARTIST_ID} AS aid, {SONG_ID} AS sid, {LOCATION_ID} AS lid
              FROM features) f
        LEFT JOIN (SELECT DISTINCT userId FROM {source}) u ON u.userId = f.userId
        LEFT JOIN (SELECT DISTINCT {ARTIST_ID} AS artistId FROM {source}) a ON a.artistId = f.aid
        LEFT JOIN (SELECT DISTINCT {SONG_ID} AS songId FROM {source}) s ON s.songId = f.sid
        LEFT JOIN (SELECT DISTINCT {LOCATION_ID} AS locationId FROM {source}) l
            ON l.locationId = f.lid
        LEFT JOIN (SELECT DISTINCT {HOUR} AS datetime FROM listen) h
            ON h.datetime = date_trunc('hour', f.ts)
        LEFT JOIN (SELECT DISTINCT sessionId FROM {source}) se ON se.sessionId = f.sessionId),
    deduplicated AS (SELECT * FROM joined QUALIFY row_number() OVER (
        PARTITION BY UserKey, ArtistKey, SongKey, SessionKey, DateKey, Timestamp
        ORDER BY event_id) = 1)"""


K = "UserKey, ArtistKey, SongKey, DateKey, LocationKey, SessionKey, Timestamp"
VALIDITY = f"""Timestamp AS rowActivationDate,
    coalesce(CAST(lead(Timestamp) OVER v AS VARCHAR), {END}) AS rowExpirationDate,
    CASE WHEN lead(Timestamp) OVER v IS NULL THEN 1 ELSE 0 END AS currRow"""
V = """WINDOW v AS (PARTITION BY UserKey, ArtistKey, SongKey, LocationKey, DateKey
    ORDER BY Timestamp, event_id)"""


def _fact(select: str, source: str = "listen", ctes: str = "") -> str:
    return f"""WITH {LISTEN}, {ctes} {FEATURES}, {_keys(source)}
        SELECT {select} FROM deduplicated"""


KEYED = f"""keyed AS (
    SELECT event_id, userId AS UserKey, {ARTIST_ID} AS ArtistKey, {SONG_ID} AS SongKey,
        {LOCATION_ID} AS LocationKey, {HOUR} AS DateKey, sessionId AS SessionKey,
        ts AS Timestamp FROM listen)"""


def _join(key: str, name: str, columns: str = "e.event_id", known: str = "listen") -> str:
    return f"""WITH {LISTEN}, {KNOWN} SELECT {columns}, d.k AS {name}
        FROM (SELECT *, {key} AS k FROM listen) e
        LEFT JOIN (SELECT DISTINCT {key} AS k FROM {known}) d ON d.k = e.k"""


NATURAL = f"""WITH {LISTEN}, {FEATURES},
    a AS (SELECT artist, {_md5('artist', 'min(ts)')} AS ArtistKey FROM listen
          WHERE artist IS NOT NULL GROUP BY artist),
    l AS (SELECT city, state, {LOCATION_SQL_ID} AS LocationKey FROM listen
          QUALIFY row_number() OVER (PARTITION BY city, state ORDER BY ts, zip, lat, lon) = 1),
    s AS (SELECT DISTINCT song, artist, {SONG_ID} AS SongKey FROM listen)
    SELECT DISTINCT f.userId AS UserKey, s.SongKey, a.ArtistKey, l.LocationKey,
        {HOUR} AS DateKey, f.sessionId AS SessionKey, f.ts AS Timestamp, f.duration,
        streamCount, isSongSkipped, isMoving, isFirstListenEvent, isLastListenEvent,
        nextListenEventTimeGap, {PARTS}
    FROM features f
    LEFT JOIN s ON s.song = f.song AND s.artist = f.artist
    LEFT JOIN a ON a.artist = f.artist
    LEFT JOIN l ON l.city = f.city AND l.state = f.state"""

# --- streaming -------------------------------------------------------------

MILLIS = "(epoch_us(ts) // 1000)"
TOPIC_ROWS = f"""messages AS (
    SELECT 'page_view_events' AS topic, * FROM ({VIEW})
    UNION ALL SELECT 'listen_events', * FROM ({VIEW})
        WHERE event_type IN ('view', 'click', 'purchase')
    UNION ALL SELECT 'auth_events', * FROM ({VIEW}) WHERE event_type IN ('signup', 'error')
    UNION ALL SELECT 'status_change_events', * FROM ({VIEW}) WHERE event_type = 'purchase')"""
HAS_TRACK = "topic IN ('listen_events', 'page_view_events')"
INGEST = f"""WITH {TOPIC_ROWS}
    SELECT topic, make_timestamp({MILLIS} * 1000) AS ts,
        {_i('year(ts)')} AS year, {_i('month(ts)')} AS month, {_i('day(ts)')} AS day,
        {_i('hour(ts)')} AS hour,
        userId, sessionId, event_id AS itemInSession, level, city, zip, state, lat, lon,
        registration,
        CASE WHEN {HAS_TRACK} THEN song END AS song,
        CASE WHEN {HAS_TRACK} THEN artist END AS artist,
        CASE WHEN {HAS_TRACK} THEN duration END AS duration,
        CASE WHEN topic = 'page_view_events' THEN CASE event_type
            WHEN 'view' THEN 'Home' WHEN 'click' THEN 'NextSong' WHEN 'purchase' THEN 'Upgrade'
            WHEN 'signup' THEN 'Register' ELSE 'Error' END END AS page,
        CASE WHEN topic = 'page_view_events'
            THEN CASE WHEN event_type = 'error' THEN 404 ELSE 200 END END AS status,
        CASE WHEN topic = 'auth_events' THEN event_type = 'signup' END AS success
    FROM messages"""
EXPORT = f"""WITH {TOPIC_ROWS},
    listens AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS n
                FROM messages WHERE topic = 'listen_events')
    SELECT topic, event_id AS itemInSession, userId, sessionId, {MILLIS} AS ts FROM messages
    WHERE @ < coalesce((SELECT event_id FROM listens WHERE n = 500), 9223372036854775807) + 1"""

ORACLE: dict[str, str] = {
    "scan_events": _from_listen("*"),
    "event_time_parts": _from_listen(f"event_id, ts, {PARTS}"),
    "date_key_string": _from_listen("event_id, strftime(ts, '%Y%m%d%H') AS DateKey"),
    "song_skipped": _from_listen(
        "event_id, CASE WHEN duration < 30 THEN 1 ELSE 0 END AS isSongSkipped"),
    "surrogate_md5": _from_listen(
        f"event_id, {SONG_ID} AS songId, {ARTIST_ID} AS artistId, {LOCATION_ID} AS locationId"),
    "repair_text": """SELECT doc_id, length(trim(text, '"')) AS characters,
        md5(trim(text, '"')) AS text_md5 FROM documents""",
    "user_base": _from_listen(f"{USER}, event_id"),
    "calendar_hours": f"{HOURS} SELECT datetime FROM hours",
    "calendar_hours_sequence": f"{HOURS} SELECT datetime FROM hours",
    "dim_datetime": _calendar(
        f"week({T})",
        f"""CASE quarter({T}) WHEN 1 THEN '1st' WHEN 2 THEN '2nd' WHEN 3 THEN '3rd'
            ELSE '4th' END || ' quarter'""",
        f"'0' || quarter({T})",
        f", {DATE_KEY.replace('(ts)', f'({T})')} AS DateKey"),
    "dim_datetime_sql": _calendar(
        f"CAST(strftime({T}, '%U') AS INTEGER)", f"'Q' || quarter({T})",
        f"CAST(quarter({T}) AS VARCHAR)"),
    "is_moving": _features("event_id, isMoving"),
    "is_moving_any": _features("event_id, isMovingAny AS isMoving"),
    "first_last_listen": _features("event_id, isFirstListenEvent, isLastListenEvent"),
    "next_listen_gap": _features("event_id, nextListenEventTimeGap"),
    "listen_features": _features(f"event_id, userId, ts, {MEASURES}"),
    "dedup_songs": f"WITH {LISTEN} {_songs()}",
    "dedup_artists": f"WITH {LISTEN} {_artists()}",
    "dedup_locations": f"WITH {LISTEN} {_locations()}",
    "dedup_versions": f"""WITH {LISTEN}, twice AS (
            SELECT event_id, ts, userId, level FROM listen
            UNION ALL SELECT event_id + 1000000000000, ts, userId, 'paid' FROM listen)
        SELECT * FROM twice
        QUALIFY row_number() OVER (PARTITION BY userId, ts ORDER BY event_id DESC) = 1""",
    "distinct_songs": _from_listen("DISTINCT song, artist"),
    "dim_song": _dim(_songs()),
    "dim_artist": _dim(_artists()),
    "dim_location": _dim(_locations()),
    "scd_location_epoch": f"""WITH {LISTEN} SELECT *, ts AS rowActivationDate,
        CAST(253402214400 AS BIGINT) AS rowExpirationDate, 1 AS currRow FROM ({_locations()})""",
    "dim_session": f"""WITH {LISTEN} SELECT sessionId, {SESSION_TEXT},
        s AS startTimestamp, e AS endTimestamp FROM ({_sessions()})""",
    "scd_session": f"""WITH {LISTEN} SELECT sessionId, {SESSION_TEXT},
        s AS rowActivationDate, {VALID} FROM ({_sessions()})""",
    "session_changed": f"""WITH {LISTEN}, half AS (SELECT * FROM listen WHERE ts < {MIDDLE})
        SELECT n.sessionId, CAST(n.s AS VARCHAR) AS startTime, CAST(n.e AS VARCHAR) AS endTime,
            CAST(o.s AS VARCHAR) AS prevStartTime, CAST(o.e AS VARCHAR) AS prevEndTime,
            CASE WHEN o.s <> n.s OR o.e <> n.e THEN 1 ELSE 0 END AS isSessionChanged
        FROM ({_sessions()}) n LEFT JOIN ({_sessions('half')}) o ON o.sessionId = n.sessionId""",
    "dim_user": f"""WITH {LISTEN}
        SELECT *, eventTimestamp AS rowActivationDate, {VALID} FROM ({_users()})""",
    "scd_user_versions": f"WITH {LISTEN} {USER_VERSIONS}",
    "current_users": f"WITH {LISTEN} SELECT * FROM ({USER_VERSIONS}) WHERE currRow = 1",
    "user_level_changes": f"WITH {LISTEN}, {LEVEL_CHANGES} SELECT * FROM changes",
    "user_level_history": f"WITH {LISTEN}, {LEVEL_CHANGES} {_history(U, 'levelChanged')}",
    "user_initial_state": f"WITH {LISTEN}, {LEVEL_CHANGES} {USER_INITIAL}",
    "dim_user_sql": f"""WITH {LISTEN}, {LEVEL_CHANGES}, rows AS (
            {_history(U, 'levelChanged')} UNION ALL {USER_INITIAL})
        SELECT *, {_md5('userId', 'rowActivationDate', 'level')} AS userKey FROM rows""",
    "artist_changes": f"WITH {LISTEN}, {ARTIST_CHANGES} SELECT * FROM changes",
    "artist_history": f"WITH {LISTEN}, {ARTIST_CHANGES} {_history(A, 'artistChanged')}",
    "artist_initial_state": f"WITH {LISTEN}, {ARTIST_CHANGES} {ARTIST_INITIAL}",
    "dim_artist_sql": f"""WITH {LISTEN}, {ARTIST_CHANGES}, rows AS (
            {_history(A, 'artistChanged')} UNION ALL {ARTIST_INITIAL})
        SELECT *, {_md5('artistName', 'rowActivationDate')} AS artistKey FROM rows""",
    "dim_song_sql": f"""WITH {LISTEN} SELECT {SONG_ID} AS songId, * FROM (
        SELECT DISTINCT song, artist, duration FROM listen)""",
    "dim_location_sql": _from_listen(f"""{LOCATION_SQL_ID} AS locationKey, city, zip, state,
        lat AS latitude, lon AS longitude, ts AS timestamp"""),
    "dim_session_sql": f"WITH {LISTEN} SELECT sessionId, {SESSION_TEXT} FROM ({_sessions()})",
    "level_changes_tiled": TILED,
    "level_changes_merged": TILED,
    "join_user": _join("userId", "UserKey", "e.event_id, e.userId"),
    "join_artist": _join(ARTIST_ID, "ArtistKey"),
    "join_artist_unmatched": _join(ARTIST_ID, "ArtistKey", known="early"),
    "join_song": _join(SONG_ID, "SongKey"),
    "join_location": _join(LOCATION_ID, "LocationKey"),
    "join_session": _join("sessionId", "SessionKey"),
    "join_calendar": _from_listen(f"event_id, {HOUR} AS DateKey"),
    "join_calendar_datekey": _from_listen(f"event_id, {DATE_KEY} AS DateKey"),
    "fact_streams": _fact(f"{K}, {MEASURES}, {VALIDITY}") + f" {V}",
    "fact_streams_detailed": _fact(
        f"""{K}, streamCount, isSongSkipped, isMovingAny AS isMoving, isFirstListenEvent,
        isLastListenEvent, nextListenEventTimeGap, consecutiveNoSong, duration, {PARTS},
        {VALIDITY}""") + f" {V}",
    "fact_streams_natural": NATURAL,
    "dedup_facts": f"""WITH {LISTEN}, {KEYED}
        SELECT event_id, UserKey, ArtistKey, SongKey, SessionKey, DateKey, Timestamp FROM keyed
        QUALIFY row_number() OVER (
            PARTITION BY UserKey, ArtistKey, SongKey, SessionKey, DateKey, Timestamp
            ORDER BY event_id) = 1""",
    "fact_validity": f"""WITH {LISTEN}, {KEYED}
        SELECT event_id, UserKey, ArtistKey, SongKey, LocationKey, DateKey, Timestamp, {VALIDITY}
        FROM keyed {V}""",
    "fact_by_hour_partition": _fact(
        "UserKey, SongKey, Timestamp, isSongSkipped, date_trunc('hour', Timestamp) AS event_hour"),
    "load_new_users": _new(_users, "userId", "eventTimestamp"),
    "load_new_songs": _new(_songs, "songId", "ts"),
    "load_new_artists": _new(_artists, "artistId", "ts"),
    "load_new_locations": _new(_locations, "locationId", "ts"),
    "load_new_sessions": f"""WITH {LISTEN}, {KNOWN}
        SELECT sessionId, {SESSION_TEXT}, s AS rowActivationDate, {VALID} FROM ({_sessions()})
        WHERE sessionId NOT IN (SELECT sessionId FROM early)""",
    "load_new_facts": f"""WITH {LISTEN}, {FEATURES}, {_keys('listen')},
        loaded AS (SELECT * FROM deduplicated WHERE Timestamp < {MIDDLE}),
        fresh AS (SELECT *, {VALIDITY} FROM deduplicated {V})
        SELECT {K}, {MEASURES}, rowActivationDate, rowExpirationDate, currRow FROM fresh f
        WHERE NOT EXISTS (SELECT 1 FROM loaded o
            WHERE o.Timestamp = f.rowActivationDate
              AND o.UserKey IS NOT DISTINCT FROM f.UserKey
              AND o.ArtistKey IS NOT DISTINCT FROM f.ArtistKey
              AND o.SongKey IS NOT DISTINCT FROM f.SongKey
              AND o.LocationKey IS NOT DISTINCT FROM f.LocationKey
              AND o.DateKey IS NOT DISTINCT FROM f.DateKey)""",
    "ingest_stream": INGEST,
    "export_topics": EXPORT.replace("@", "0"),
    "export_topics_bounded": EXPORT.replace("@", "event_id"),
    "surrogate_hash": _from_listen("""event_id,
        min(event_id) OVER (PARTITION BY song, artist) AS songFirst,
        min(event_id) OVER (PARTITION BY artist, lat, lon, city, state) AS artistFirst,
        min(event_id) OVER (PARTITION BY city, zip, state, lat, lon) AS locationFirst,
        min(event_id) OVER (PARTITION BY city, zip, state, lat, lon) AS filledLocationFirst"""),
    "merge_late_events": TILED,
    "join_user_as_of": USER_AS_OF,
    "join_user_as_of_chunked": USER_AS_OF,
    "join_artist_as_of": _as_of("artist", "lat, lon, city, state", f"""e.event_id, e.artist,
        CASE WHEN v.artist IS NOT NULL THEN {_md5('v.artist', 'v.rowActivationDate')} END AS ArtistVersion"""),
    "listen_features_chunked": _features(f"event_id, userId, ts, {MEASURES}"),
    "scd_user_versions_chunked": f"WITH {LISTEN} {USER_VERSIONS}",
    "load_user_twice": f"""WITH {LISTEN}
        SELECT *, eventTimestamp AS rowActivationDate, {VALID} FROM ({_users()})""",
    "load_session_twice": f"""WITH {LISTEN} SELECT sessionId, {SESSION_TEXT},
        s AS rowActivationDate, {VALID} FROM ({_sessions()})""",
    "load_fact_twice": _fact(f"{K}, {MEASURES}, {VALIDITY}") + f" {V}",
    "load_fact_by_day": _fact(f"{K}, {MEASURES}, {VALIDITY}") + f" {V}",
    "load_warehouse_catalog": _fact(f"{K}, {MEASURES}, {VALIDITY}") + f" {V}",
    "load_user_history": TILED,
    "load_stream": _fact(f"{K}, {MEASURES}, {VALIDITY}").replace(LISTEN, LISTEN_MILLIS) + f" {V}",
}
# Models are the same tables, built by a job.
ORACLE |= {f"model_{name}": ORACLE[sql] for name, sql in (
    ("dim_user", "dim_user_sql"), ("dim_artist", "dim_artist_sql"), ("fact_streams", "fact_streams_natural"))}
