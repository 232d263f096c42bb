"""Slowly changing dimensions: validity intervals, change detection, merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from listenhouse.functions.time import forever
from listenhouse.operators.as_of import AS_OF, as_of
from listenhouse.operators.hot_keys import HotKeys, position
from listenhouse.operators.neighbours import NEXT, PREV, neighbours

#: Place of the last event that went into a version.
LAST = "lastEvent"
VALIDITY = ("rowActivationDate", "rowExpirationDate", "currRow")


def first_version(df: DataFrame, ts: str = "ts", epoch: bool = False) -> DataFrame:
    """Validity of a dimension with one row per key: from first seen, open end.

    A window would find no later row, so none is run.
    """
    end = forever(df, ts)
    return df.withColumns({
        "rowActivationDate": F.col(ts),
        "rowExpirationDate": F.unix_timestamp(end) if epoch else end,
        "currRow": F.lit(1),
    })


def versions(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tiebreak: Sequence[str],
    hot: HotKeys | None = None,
    epoch: bool = False,
) -> DataFrame:
    """Every event as a version that ends where the next one begins.

    Of several rows at the same key and time the last in ``tiebreak`` order is
    kept. They are adjacent in the window, so the dedup needs no shuffle of
    its own, and the next row of a kept row is always a later one.
    """
    rows = neighbours(df, keys, [ts, *tiebreak], next=[ts], hot=hot)
    following, end = F.col(f"{NEXT}.{ts}"), forever(df, ts)
    is_last = F.col(NEXT).isNull()
    kept = rows.where(is_last | ~following.eqNullSafe(F.col(ts)))
    until = F.when(is_last, end).otherwise(following)
    return kept.withColumns({
        "rowActivationDate": F.col(ts),
        "rowExpirationDate": F.unix_timestamp(until) if epoch else until,
        "currRow": F.when(is_last, 1).otherwise(0),
    }).drop(NEXT)


def current(df: DataFrame) -> DataFrame:
    """The versions valid now."""
    return df.where(F.col("currRow") == 1)


def changed(tracked: Sequence[str]) -> Column:
    """True for the first row of a key and wherever a tracked column differs
    from the row before; null counts as a value."""
    flag = F.col(PREV).isNull()
    for c in tracked:
        flag |= ~F.col(f"{PREV}.{c}").eqNullSafe(F.col(c))
    return flag


def scd2_changes(
    df: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    tiebreak: Sequence[str],
    hot: HotKeys | None = None,
    last_event: bool = False,
) -> DataFrame:
    """History of changes: a version starts where a tracked column changes and
    ends where the next change starts, so intervals tile and one is current.

    The second window shares exchange and sort with the first. ``last_event`` adds the place of the
    last event that went into each version, which ``scd2_merge`` needs.
    """
    order = [ts, *tiebreak]
    if last_event:
        return _tiled(df.withColumn(LAST, position(order)), keys, tracked, ts, tiebreak, hot)
    points = neighbours(df, keys, order, prev=tracked, hot=hot).where(changed(tracked)).drop(PREV)
    rows = neighbours(points, keys, order, next=[ts], hot=hot)
    is_last = F.col(NEXT).isNull()
    return rows.withColumns({
        "rowActivationDate": F.col(ts),
        "rowExpirationDate": F.when(is_last, forever(df, ts)).otherwise(F.col(f"{NEXT}.{ts}")),
        "currRow": F.when(is_last, 1).otherwise(0),
    }).drop(NEXT)


def _tiled(
    points: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str, tiebreak: Sequence[str], hot: HotKeys | None
) -> DataFrame:
    """scd2_changes of points that know, in ``LAST``, the last event they stand for.

    A key's last point stays for the second window even if nothing changes there: it ends the
    open version's events.
    """
    order = [ts, *tiebreak]
    rows = neighbours(points, keys, order, prev=[*tracked, LAST], next=[ts], hot=hot)
    rows = rows.withColumns({"__change": changed(tracked), "__until": F.col(f"{PREV}.{LAST}")})
    kept = rows.where(F.col("__change") | F.col(NEXT).isNull()).drop(PREV, NEXT)
    rows = neighbours(kept, keys, order, next=[ts, "__change", "__until", LAST], hot=hot).where("__change")
    following = F.col(f"{NEXT}.__change")
    is_last = ~F.coalesce(following, F.lit(False))
    last = F.when(following, F.col(f"{NEXT}.__until")).otherwise(F.coalesce(F.col(f"{NEXT}.{LAST}"), F.col(LAST)))
    return rows.withColumns({
        LAST: last,
        "rowActivationDate": F.col(ts),
        "rowExpirationDate": F.when(is_last, forever(points, ts)).otherwise(F.col(f"{NEXT}.{ts}")),
        "currRow": F.when(is_last, 1).otherwise(0),
    }).drop(NEXT, "__change", "__until")


def scd2_merge(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    tiebreak: Sequence[str],
    hot: HotKeys | None = None,
    landed: DataFrame | None = None,
    late: str = "raise",
) -> DataFrame:
    """Bring a change history up to date with events that may come late.

    ``existing`` is a former result of scd2_changes with ``last_event``, or of this function. Versions of keys without
    new events are copied. Every event is placed among the versions of its key:

    * behind the key's last event, or between a version's last event and the next version: it is one more point;
    * inside a version and like it: it changes nothing, whether it is known or late;
    * inside a version and unlike it: the version has to be taken apart, which needs its events. They are read from
      ``landed`` (all events so far, the batch included), those of the touched versions only.

    Without ``landed`` such an event fails the job, or is left out if the caller says ``late="ignore"``. The result is
    to be written as a new table and swapped in, as plain Parquet has no MERGE. Histories without
    ``last_event`` count every event up to a version's end as known to it.
    """
    if late not in ("raise", "ignore"):
        raise ValueError(f"unknown late: {late}")
    order = [ts, *tiebreak]
    if LAST not in existing.columns:
        since_start = incoming.schema[ts].dataType
        end = F.struct(*[
            (F.col("rowExpirationDate").cast(since_start) if i == 0 else F.lit(None).cast(incoming.schema[c].dataType)).alias(f"o{i}")
            for i, c in enumerate(order)
        ])
        closed = existing.withColumn(LAST, F.when(F.col("currRow") == 0, end).otherwise(position(order)))
        return scd2_merge(closed, incoming, keys, tracked, ts, tiebreak, hot, landed, late).drop(LAST)
    columns = [c for c in existing.columns if c not in (*VALIDITY, LAST)]
    states = existing.select(*columns, LAST)
    touched = incoming.select(F.struct(*keys).alias("__key")).distinct()
    among = F.lit(True)
    for k in keys:
        among &= F.col(k).eqNullSafe(F.col(f"__key.{k}"))
    untouched = existing.join(touched, among, "left_anti")
    states = states.join(touched, among, "left_semi")

    placed, inside, alike = _placed(states, incoming.select(*columns), keys, tracked, order)
    late_inside = inside & ~alike
    fresh = placed.where(~inside)
    if landed is None:
        if late == "raise":
            message = F.lit("a late event changes a closed interval: give landed, or late='ignore'")
            fresh = placed.where(F.when(late_inside, F.raise_error(message).cast("boolean")).otherwise(~inside))
        points = states.unionByName(fresh.drop(AS_OF).withColumn(LAST, position(order)))
        return untouched.unionByName(_tiled(points, keys, tracked, ts, tiebreak, hot).select(untouched.columns))

    opened = placed.where(late_inside).select(
        F.struct(*keys).alias("__open"), F.struct(*[F.col(f"{AS_OF}.{c}").alias(f"o{i}") for i, c in enumerate(order)]).alias("__from"),
        F.col(f"{AS_OF}.{LAST}").alias("__to"),
    ).distinct()
    of_key = F.lit(True)
    for k in keys:
        of_key &= F.col(k).eqNullSafe(F.col(f"__open.{k}"))
    within = of_key & (position(order) >= F.col("__from")) & (position(order) <= F.col("__to"))
    events = landed.select(*columns).join(opened, within, "left_semi")
    whole = states.join(opened, of_key & (position(order) == F.col("__from")), "left_anti")
    own = events.unionByName(fresh.drop(AS_OF)).withColumn(LAST, position(order))
    return untouched.unionByName(_tiled(whole.unionByName(own), keys, tracked, ts, tiebreak, hot).select(untouched.columns))


def _placed(
    states: DataFrame, incoming: DataFrame, keys: Sequence[str], tracked: Sequence[str], order: Sequence[str]
) -> tuple[DataFrame, Column, Column]:
    """Events with the version they fall to, whether they lie inside of its events, and whether they are like it."""
    placed = as_of(incoming, states, keys, order, order, [*order, *tracked, LAST])
    inside = F.coalesce(position(order) <= F.col(f"{AS_OF}.{LAST}"), F.lit(False))
    alike = F.lit(True)
    for c in tracked:
        alike &= F.col(f"{AS_OF}.{c}").eqNullSafe(F.col(c))
    return placed, inside, alike


def late_span(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str, tiebreak: Sequence[str]
) -> tuple | None:
    """Between which times scd2_merge needs landed events, None if it needs none: two values for the driver, so that the scan can be pruned."""
    order = [ts, *tiebreak]
    states = existing.select(*keys, *order, *[c for c in tracked if c not in keys], LAST)
    rows = incoming.select(*[c for c in states.columns if c != LAST])
    placed, inside, alike = _placed(states, rows, keys, tracked, order)
    low, high = placed.where(inside & ~alike).agg(F.min(f"{AS_OF}.{ts}"), F.max(f"{AS_OF}.{LAST}.o0")).first()
    return None if low is None and high is None else (low, high)
