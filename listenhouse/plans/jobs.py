"""Jobs over a warehouse folder: landed events in, tables out.

Dimensions have to be loaded before the fact; ``load_warehouse`` does both in
that order. Every job can run again on the same input without changing a row, and the
tables do not depend on how many loads the events came in.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from listenhouse.operators.dedup import last_row
from listenhouse.operators.hot_keys import ROWS_PER_TASK, find_hot_keys
from listenhouse.operators.joins import new_rows
from listenhouse.operators.scd import late_span, scd2_changes, scd2_merge
from listenhouse.plans import dims
from listenhouse.plans.fact import FEATURES, fact_rows_of, fact_validity, listen_features
from listenhouse.schemas import FACT_VALIDITY_KEY, USER_ATTRIBUTES
from listenhouse.session import staging
from listenhouse.sinks.store import Store, in_days
from listenhouse.sinks.tables import changed_days, with_event_hour
from listenhouse.sources.calendar import calendar_hours, calendar_of_years, occurring_years
from listenhouse.sources.tables import read_events

# What the fact table is made from.
FACT_SOURCE = (
    "ts", "userId", "sessionId", "itemInSession", "song", "artist", "duration",
    "city", "zip", "state", "lat", "lon",
)

USER_SOURCE = ("ts", "userId", "itemInSession", *USER_ATTRIBUTES)
LEVEL_SOURCE = ("userId", "ts", "level", "itemInSession")

Stage = Callable[[DataFrame, str], DataFrame]

# Order of events at the same time, where the messages carry no id of their own.
TIEBREAK = ("itemInSession", "rowHash")

APPENDED: dict[str, tuple[Callable[[DataFrame, str], DataFrame], str]] = {
    "dim_artist": (dims.dim_artist, "artistId"),
    "dim_song": (dims.dim_song, "songId"),
    "dim_location": (dims.dim_location, "locationId"),
}


def landed_listens(spark: SparkSession, path: str) -> DataFrame:
    """Landed listen events with a hash of the row that completes their order."""
    return with_row_hash(read_events(spark, path))


def with_row_hash(events: DataFrame) -> DataFrame:
    """Rows that are equal in all columns are the only ones left tied."""
    return events.withColumn("rowHash", F.xxhash64(*events.columns))


def store_of(spark: SparkSession, warehouse: str | Store) -> Store:
    """A warehouse named by its folder is a store of Parquet tables."""
    return warehouse if isinstance(warehouse, Store) else Store(spark, warehouse)


def load_calendar(spark: SparkSession, events: DataFrame, warehouse: str | Store) -> int:
    """(Re)build the calendar for the default years, those with events, and those it has."""
    store = store_of(spark, warehouse)
    hours = calendar_hours(spark, dtype="timestamp").union(calendar_of_years(occurring_years(events), "timestamp"))
    if store.exists("dim_datetime"):
        hours = hours.union(store.read("dim_datetime").select("datetime"))
    return store.replace(dims.dim_datetime(hours.distinct()), "dim_datetime")


def load_users(events: DataFrame, warehouse: str | Store) -> int:
    """The latest row of every user; the same in however many loads the events come."""
    store = store_of(events.sparkSession, warehouse)
    # The hash is redone over the user's columns, so the scan reads no others.
    source = with_row_hash(events.select(*USER_SOURCE))
    latest = dims.dim_user(source, TIEBREAK)
    if not store.exists("dim_user"):
        return store.replace(latest, "dim_user")
    both = store.read("dim_user").withColumn("__new", F.lit(0)).unionByName(latest.withColumn("__new", F.lit(1)))
    return store.replace(last_row(both, ["userId"], ["eventTimestamp", "__new"]).drop("__new"), "dim_user")


def load_user_history(events: DataFrame, warehouse: str | Store, landed: DataFrame | None = None) -> int:
    """The levels of every user as intervals that tile, brought up to date with ``events``, late ones too.

    ``landed`` are all events so far, of which those are read that lie in intervals which a late event takes apart;
    by default ``events`` are all.
    """
    store = store_of(events.sparkSession, warehouse)
    source = with_row_hash(events.select(*LEVEL_SOURCE))
    how = (["userId"], ["level"], "ts", TIEBREAK)
    if not store.exists("dim_user_history"):
        return store.replace(scd2_changes(source, *how, last_event=True), "dim_user_history")
    known = store.read("dim_user_history")
    span = late_span(known, source, *how)
    whole = between(events if landed is None else landed, span)
    return store.replace(scd2_merge(known, source, *how, landed=with_row_hash(whole.select(*LEVEL_SOURCE))), "dim_user_history")


def between(events: DataFrame, span: tuple | None) -> DataFrame:
    """The events of a span of time, no limit where it is null; none for no span. Partitions by year are pruned as well."""
    if span is None:
        return events.where("false")
    low, high = span
    for bound, inside in ((low, F.col("ts") >= low), (high, F.col("ts") <= high)):
        events = events if bound is None else events.where(inside)
    if "year" in events.columns and None not in span:
        events = events.where(F.col("year").between(low.year, high.year))
    return events


def load_sessions(events: DataFrame, warehouse: str | Store) -> int:
    """Sessions with their first and last listen over all loads."""
    store = store_of(events.sparkSession, warehouse)
    bounds = dims.session_bounds(events)
    if store.exists("dim_session"):
        both = store.read("dim_session").select(*bounds.columns).unionByName(bounds)
        bounds = both.groupBy("sessionId").agg(
            F.min("startTimestamp").alias("startTimestamp"), F.max("endTimestamp").alias("endTimestamp")
        )
    return store.replace(dims.session_rows(bounds), "dim_session")


def load_new(rows: DataFrame, warehouse: str | Store, name: str, key: str) -> int:
    """Append the rows whose key is new; known ones keep their first row."""
    store = store_of(rows.sparkSession, warehouse)
    return store.append(new_rows(rows, store.read(name), [key]) if store.exists(name) else rows, name)


def load_dimensions(
    spark: SparkSession, events: DataFrame, warehouse: str | Store, algo: str = "md5", landed: DataFrame | None = None
) -> dict[str, int]:
    """Bring every dimension up to date with ``events``, all or a batch; rows written by table.

    Songs, artists and locations are appended and keep their first row; users and sessions are merged. ``landed``:
    all events so far, if ``events`` is a batch. No table needs another one, so all are loaded at once.
    """
    loads: dict[str, Callable[[], int]] = {
        "dim_datetime": lambda: load_calendar(spark, events, warehouse),
        "dim_user": lambda: load_users(events, warehouse), "dim_session": lambda: load_sessions(events, warehouse),
        "dim_user_history": lambda: load_user_history(events, warehouse, landed),
    }
    for name, (build, key) in APPENDED.items():
        loads[name] = lambda name=name, build=build, key=key: load_new(build(events, algo), warehouse, name, key)
    return at_once(spark, loads)


def at_once(spark: SparkSession, loads: Mapping[str, Callable[[], int]]) -> dict[str, int]:
    """Loads of different tables side by side, as one alone leaves cores idle; all end before the first error is raised."""
    with ThreadPoolExecutor(len(loads)) as pool:
        # A thread of its own properties for each: those of the stream's batch hold for its jobs as well.
        running = {name: pool.submit(inheritable_thread_target(spark)(load)) for name, load in loads.items()}
    return {name: done.result() for name, done in running.items()}


def days_of(events: DataFrame) -> list[date | None]:
    """The days of a batch, null among them if an event has no time."""
    return [r[0] for r in events.select(F.to_date("ts")).distinct().collect()]


def of_days(events: DataFrame, days: Sequence[date | None]) -> DataFrame:
    """The events of some days. Landed tables have the parts of the day as columns or partitions, which prune the scan."""
    day = F.to_date("ts")
    if {"year", "month", "day"} <= set(events.columns):
        parts = F.lit(None in days)
        for d in days:
            if d is not None:
                parts |= (F.col("year") == d.year) & (F.col("month") == d.month) & (F.col("day") == d.day)
        events = events.where(parts | F.col("year").isNull() if None in days else parts)
    return events.where(in_days(day, days))


def load_fact(
    spark: SparkSession, events: DataFrame, warehouse: str | Store, rows_per_task: int = ROWS_PER_TASK,
    days: Sequence[date | None] | None = None, **options,
) -> int:
    """Bring the fact table up to all landed ``events``; rows written.

    Without ``days`` the fact is built from all events, and the days that differ are replaced. With ``days``, those of
    a batch, only their events are read. A new listen also changes rows of other days: the listen
    before is no longer the user's last and its gap is known; the one behind may have moved. Such rows are the first or the last of a user's
    day, and the table ``fact_edges`` has these. They take part in the window in place of their days, and the days of
    those that change are rewritten from what is stored. Validity groups lie within an hour, so they
    never cross days. The result is that of a full build.

    The joined, de-duplicated rows are written to the shared folder once. That
    cuts the lineage (a lost executor costs one stage, not the whole chain)
    and lets the hot keys of the validity window be measured on real rows.
    ``options``: ``rule``, ``detailed`` and key ``algo`` of the fact; the same for every load.
    """
    store = store_of(spark, warehouse)
    with staging(spark) as stage:
        if days is not None and store.exists("fact_streams") and store.exists("fact_edges"):
            return _load_days(store, stage, events, list(days), rows_per_task, **options)
        return _load_all(store, stage, events, rows_per_task, **options)


def _load_all(store: Store, stage: Stage, events: DataFrame, rows_per_task: int, **options) -> int:
    # The hash is redone over these columns alone, so the scan reads no others.
    source = with_row_hash(events.select(*FACT_SOURCE))
    featured = stage(_features(source, rows_per_task, options.get("rule", "all")), "features")
    facts = _valid(_joined(store, stage, featured, **options), rows_per_task)
    edges = _edges(featured)
    if not store.exists("fact_streams"):
        store.replace_days(edges, "fact_edges", [])
        return store.replace_days(facts, "fact_streams", [])
    facts = stage(facts, "facts")
    differ = changed_days(facts, store.read("fact_streams"))
    if differ:
        store.replace_days(edges, "fact_edges", [r[0] for r in edges.select("event_date").distinct().collect()])
        return store.replace_days(facts.where(in_days(F.col("event_date"), differ)), "fact_streams", differ)
    return 0


def _features(events: DataFrame, rows_per_task: int, rule: str) -> DataFrame:
    order = ["ts", *TIEBREAK]
    hot = find_hot_keys(events.select("userId", *order), ["userId"], order, rows_per_task)
    return listen_features(events, TIEBREAK, rule, hot)


def _joined(store: Store, stage: Stage, featured: DataFrame, **options) -> DataFrame:
    """Fact rows of events with features, before their validity; staged."""
    tables = {n: store.read(f"dim_{n}") for n in ("user", "artist", "song", "location", "session", "datetime")}
    options = {k: v for k, v in options.items() if k != "rule"}
    return stage(fact_rows_of(featured, tables, TIEBREAK, **options), "joined")


def _valid(joined: DataFrame, rows_per_task: int) -> DataFrame:
    """With their validity and their day; not staged, as most loads write them once."""
    hot = find_hot_keys(joined, FACT_VALIDITY_KEY, ["Timestamp", *TIEBREAK], rows_per_task)
    return with_event_hour(fact_validity(joined, TIEBREAK, hot))


def _edges(featured: DataFrame) -> DataFrame:
    """The first and the last listen of every user and day, combined map-side."""
    place, row = F.struct("ts", *TIEBREAK), F.struct("ts", *TIEBREAK, "lat", "lon", *FEATURES)
    ends = featured.groupBy("userId", F.to_date("ts").alias("event_date")).agg(
        F.min_by(row, place).alias("first"), F.max_by(row, place).alias("last")
    )
    alone = F.col("first").eqNullSafe(F.col("last"))
    flagged = lambda end, first, last: F.struct(F.lit(first).alias("is_first"), F.lit(last).alias("is_last"), F.col(end).alias("row"))
    edge = F.explode(F.when(alone, F.array(flagged("first", True, True))).otherwise(F.array(flagged("first", True, False), flagged("last", False, True))))
    return ends.select("userId", edge.alias("edge"), "event_date").select("userId", "edge.is_first", "edge.is_last", "edge.row.*", "event_date")


def _load_days(store: Store, stage: Stage, events: DataFrame, days: list[date | None], rows_per_task: int, **options) -> int:
    source = with_row_hash(of_days(events, days).select(*FACT_SOURCE))
    elsewhere = store.read("fact_edges").where(~in_days(F.col("event_date"), days))
    # Edges of the users of these days.
    edges = elsewhere.join(source.select(F.col("userId").alias("__user")).distinct(), F.col("userId").eqNullSafe(F.col("__user")), "left_semi")
    stored = F.struct(*FEATURES, "is_first", "is_last", "event_date")
    edge_rows = edges.withColumn("edge", stored).drop(*FEATURES, "is_first", "is_last", "event_date")
    kind = edge_rows.schema["edge"].dataType
    points = source.withColumn("edge", F.lit(None).cast(kind)).unionByName(edge_rows, allowMissingColumns=True)
    featured = stage(_features(points, rows_per_task, options.get("rule", "all")), "features")

    of_events = featured.where("edge is null").drop("edge")
    joined = _joined(store, stage, of_events, **options)
    if not joined.where(F.col("DateKey").isNull() & F.to_date("Timestamp").isNotNull()).isEmpty():
        raise ValueError("the calendar does not cover these days; load the dimensions first")
    facts = _valid(joined, rows_per_task)
    # What the first of a day knows of the listen before, and the last of the listen behind.
    now = {c: F.when(F.col(f"edge.{flag}"), F.col(c)).otherwise(F.col(f"edge.{c}")) for c, flag in FEATURES.items()}
    differs = F.lit(False)
    for c, value in now.items():
        differs |= ~value.eqNullSafe(F.col(f"edge.{c}"))
    identity = ("ts", *TIEBREAK)
    patches = featured.where("edge is not null").where(differs).select(
        F.struct("userId", *identity).alias("id"), *[v.alias(f"__{c}") for c, v in now.items()], F.col("edge.event_date").alias("__day")
    )
    patches = stage(patches, "patches")
    others = [r[0] for r in patches.select("__day").distinct().collect()]

    def patched(table: DataFrame, ts: str, user: bool) -> DataFrame:
        match = F.col("event_date").eqNullSafe(F.col("__day"))
        for c in (*identity, *(["userId"] if user else [])):
            match &= F.col(ts if c == "ts" else c).eqNullSafe(F.col(f"id.{c}"))
        # A patch may stand for two equal rows; one of them is enough.
        once = patches.dropDuplicates(["id", "__day"])
        rows = table.where(in_days(F.col("event_date"), others)).join(once, match, "left")
        known = F.col("id").isNotNull()
        return rows.withColumns({c: F.when(known, F.col(f"__{c}")).otherwise(F.col(c)) for c in FEATURES}).select(*table.columns)

    ends = _edges(of_events)
    if others:  # Rows of these days come from the tables that are replaced.
        facts = stage(facts.unionByName(patched(store.read("fact_streams"), "Timestamp", False).select(*facts.columns)), "days")
        ends = stage(ends.unionByName(patched(store.read("fact_edges"), "ts", True).select(*ends.columns)), "edges")
    written = store.replace_days(facts, "fact_streams", [*days, *others])
    store.replace_days(ends, "fact_edges", [*days, *others])
    return written


def load_warehouse(
    spark: SparkSession, events_path: str, warehouse: str | Store, algo: str = "exact",
    days: Sequence[date | None] | None = None, **options,
) -> dict[str, int]:
    """All tables up to the landed events; with ``days`` only the events of these days are taken for new."""
    landed = landed_listens(spark, events_path)
    events = landed if days is None else of_days(landed, days)
    written = load_dimensions(spark, events, warehouse, algo, landed)
    written["fact_streams"] = load_fact(spark, landed, warehouse, algo=algo, days=days, **options)
    return written
