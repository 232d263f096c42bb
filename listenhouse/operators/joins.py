"""Join helpers. No broadcast is forced: Catalyst and AQE see the sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def null_safe(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equality on every key where null equals null."""
    match = F.lit(True)
    for k in keys:
        match &= F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return match


def new_rows(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``existing``.

    Null-safe, so a row with an unmatched dimension is not loaded again on
    every run.
    """
    known = existing.select(*keys).alias("known")
    return incoming.alias("new").join(known, null_safe("new", "known", keys), "left_anti")


def not_in(df: DataFrame, subset: DataFrame, key: str) -> DataFrame:
    """SQL ``key NOT IN (SELECT key FROM subset)`` as a shuffled anti join.

    The null-aware anti join of SQL has to broadcast the whole subset. The
    same rule spelled out: nothing passes if the subset holds a null, and a
    null key passes only if the subset is empty.
    """
    # The null rule is two one-row existence tests, not a join.
    # Distinct: combined map-side, so a hot key is one row of the right side.
    keys = subset.select(F.col(key).alias("__key")).distinct()
    has_null = keys.where(F.col("__key").isNull()).exists()
    empty = ~keys.exists()
    survivors = df.join(keys, F.col(key) == F.col("__key"), "left_anti")
    return survivors.where(~has_null & (F.col(key).isNotNull() | empty))
