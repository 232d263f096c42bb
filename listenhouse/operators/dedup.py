"""Deterministic de-duplication: which row survives never depends on the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in ``order``.

    ``row_number() = 1`` is pruned to one row per key before the shuffle
    (WindowGroupLimit), so a key with a third of all rows costs one row per
    input partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")


def last_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key in ``order``; pruned before the shuffle like first_row."""
    return first_row(df, keys, [F.col(c).desc() for c in order])


def first_seen(
    df: DataFrame,
    attributes: Sequence[str],
    key: Column,
    key_name: str,
    payload: str | None = None,
    ts: str = "ts",
) -> DataFrame:
    """One row per key: its attributes, and ``payload`` and ``ts`` of the
    earliest event; of several payloads at that time the least.

    Groups on the plain attributes first, by hash and with map-side combine,
    and builds the key on the few distinct rows that remain. Two attribute sets with the
    same key text are then reduced to the earlier one.
    """
    if payload:
        # Fixed-width buffers in both steps: a struct would need a sort of all events.
        at_once = df.groupBy(*attributes, ts).agg(F.min(payload).alias(payload))
        distinct = at_once.groupBy(*attributes).agg(
            F.min_by(payload, ts).alias(payload), F.min(ts).alias(ts)
        )
    else:
        distinct = df.groupBy(*attributes).agg(F.min(ts).alias(ts))
    keyed = distinct.withColumn(key_name, key)
    carried = [payload] if payload else []
    return first_row(keyed, [key_name], [ts, *attributes, *carried]).select(
        key_name, *attributes, *carried, ts
    )
