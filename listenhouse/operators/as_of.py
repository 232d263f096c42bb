"""As-of join: to every row the state that was valid at its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from listenhouse.operators.hot_keys import HotKeys
from listenhouse.operators.neighbours import carry_forward

AS_OF = "as_of"
_SIDE, _AT = "__side", "__at"


def as_of(
    rows: DataFrame,
    states: DataFrame,
    keys: Sequence[str],
    at: Sequence[str],
    since: Sequence[str],
    columns: Sequence[str],
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add the struct ``as_of``: ``columns`` of the last of ``states`` with the row's keys that is not after the row.

    Rows are placed by their columns ``at``, states by ``since`` (as many, of the same types); a state
    that begins with a row holds for it. Both sides are merged in one ordered pass per key, so a key costs its
    rows and its states, not their product, and a hot key (see ``hot_places``) is split like any window. Null keys are
    equal. The struct is null where no state is known yet. States have to differ in
    (keys, since); rows may repeat.
    """
    places = [f"{_AT}{i}" for i in range(len(at))]
    kind = states.select(F.struct(*columns)).schema[0].dataType
    left = rows.withColumns({**{p: F.col(c) for p, c in zip(places, at)}, _SIDE: F.lit(1), AS_OF: F.lit(None).cast(kind)})
    fields = {f.name: f.dataType for f in rows.schema}
    other = [F.lit(None).cast(fields[c]).alias(c) for c in rows.columns if c not in keys]
    right = states.select(
        *keys, *[F.col(c).alias(p) for p, c in zip(places, since)], F.lit(0).alias(_SIDE), F.struct(*columns).alias(AS_OF)
    ).select("*", *other)
    merged = carry_forward(left.unionByName(right), keys, [*places, _SIDE], AS_OF, hot)
    return merged.where(F.col(_SIDE) == 1).drop(*places, _SIDE)


def hot_places(rows: DataFrame, keys: Sequence[str], at: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """What to hand ``find_hot_keys``, so that its cuts fit the order of ``as_of``: the narrow rows, keys and order."""
    places = [f"{_AT}{i}" for i in range(len(at))]
    narrow = rows.select(*keys, *[F.col(c).alias(p) for p, c in zip(places, at)], F.lit(1).alias(_SIDE))
    return narrow, list(keys), [*places, _SIDE]
