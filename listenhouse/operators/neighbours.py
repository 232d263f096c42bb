"""The row before, the row after, and the last known value, per key and order, safe under skew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, Window

from listenhouse.operators.hot_keys import CHUNK, HotKeys, position, unfold

PREV, NEXT = "prev", "next"


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    prev: Sequence[str] = (),
    next: Sequence[str] = (),
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add structs ``prev`` / ``next`` with columns of the adjacent rows.

    The struct is null where there is no such row. ``order`` has to be total,
    but for identical rows.
    Without hot keys this is one exchange, one sort, one window. With hot keys
    the window runs per (key, chunk); the two edge rows of every chunk are
    aggregated map-side, linked in a tiny window over chunks and joined back,
    so no task ever holds more than a chunk. Identical rows may
    repeat: a group of copies larger than a chunk is folded and given back.
    """
    if hot is None:
        return _within(df, keys, order, prev, next)

    tagged = hot.tag(df, keys, order)
    body = _within(tagged, [*keys, CHUNK], order, prev, next)

    at = position(order)
    edges, links = [], []
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    if prev:
        edges.append(F.max_by(F.struct(*prev), at).alias("last"))
        links.append(F.lag("last").over(across).alias("before"))
    if next:
        edges.append(F.min_by(F.struct(*next), at).alias("first"))
        links.append(F.lead("first").over(across).alias("after"))
    seams = (
        hot.tag(df, keys, order, only_hot=True)
        .groupBy(*keys, CHUNK).agg(*edges)
        .select(
            F.struct(*keys).alias("seam_key"), F.col(CHUNK).alias("seam_chunk"), *links
        )
    )
    # One row per chunk of a hot key; Catalyst knows whether that is small.
    match = F.col("seam_chunk") == F.col(CHUNK)
    for k in keys:
        match &= F.col(f"seam_key.{k}").eqNullSafe(F.col(k))
    joined = body.join(seams, match, "left")
    closed = {}
    if prev:
        closed[PREV] = F.coalesce(PREV, "before")
    if next:
        closed[NEXT] = F.coalesce(NEXT, "after")
    rows = joined.withColumns(closed).drop(
        CHUNK, "seam_key", "seam_chunk", "before", "after"
    )
    if not hot.has_copies:
        return rows
    own = {PREV: prev, NEXT: next}
    return unfold(rows, {n: F.struct(*c) for n, c in own.items() if c})


def _within(df, keys, order, prev, next) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    columns = {}
    if prev:
        columns[PREV] = F.lag(F.struct(*prev)).over(window)
    if next:
        columns[NEXT] = F.lead(F.struct(*next)).over(window)
    return df.withColumns(columns)


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    column: str,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Replace ``column`` by its last value that is not null, up to and with the row itself.

    One exchange, one sort, one window. With hot keys the window runs per (key, chunk); what each
    chunk hands on is aggregated map-side, carried over the chunks in a tiny window and joined back. Chunks of
    folded copies are not supported: copies share a position, hence a value, so keep one of them.
    """
    if hot is None:
        return _carried(df, keys, order, column)
    if hot.has_copies:
        raise ValueError("identical rows fill whole chunks; drop repeated rows first")
    tagged = hot.tag(df, keys, order)
    body = _carried(tagged, [*keys, CHUNK], order, column)
    known = F.when(F.col(column).isNotNull(), position(order))
    across = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    seams = (
        hot.tag(df, keys, order, only_hot=True)
        .groupBy(*keys, CHUNK).agg(F.max_by(column, known).alias("last"))
        .select(F.struct(*keys).alias("seam_key"), F.col(CHUNK).alias("seam_chunk"), F.last("last", ignorenulls=True).over(across).alias("before"))
    )
    match = F.col("seam_chunk") == F.col(CHUNK)
    for k in keys:
        match &= F.col(f"seam_key.{k}").eqNullSafe(F.col(k))
    joined = body.join(seams, match, "left").withColumn(column, F.coalesce(column, "before"))
    return joined.drop(CHUNK, "seam_key", "seam_chunk", "before")


def _carried(df, keys, order, column) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(column, F.last(column, ignorenulls=True).over(window))
