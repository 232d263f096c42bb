"""The SQL models as jobs: named builders that refer to each other, built in the order of their references."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame

from listenhouse.plans import dims, fact, history
from listenhouse.sinks.store import Store

Refs = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Model:
    """``build`` gets the frames of ``refs``: sources, or other models as they were built.

    ``materialized``: ``table`` replaces the table of that name in the store, ``view`` names the frame for SQL.
    """

    name: str
    build: Callable[[Refs], DataFrame]
    refs: Sequence[str] = ()
    materialized: str = "table"


def sql_model(name: str, sql: str, refs: Sequence[str], materialized: str = "table") -> Model:
    """A model in SQL, in which ``{ref}`` stands for a source or model."""

    def build(frames: Refs) -> DataFrame:
        spark = next(iter(frames.values())).sparkSession
        return spark.sql(sql, **frames)

    return Model(name, build, refs, materialized)


def build_order(models: Sequence[Model], sources: Sequence[str]) -> list[Model]:
    """Every model behind those it refers to; an unknown name or a circle is an error."""
    by_name = {m.name: m for m in models}
    if len(by_name) < len(models):
        raise ValueError("two models have the same name")
    for m in models:
        if unknown := set(m.refs) - set(by_name) - set(sources):
            raise ValueError(f"{m.name} refers to unknown {sorted(unknown)}")
    try:
        order = list(TopologicalSorter({m.name: [r for r in m.refs if r in by_name] for m in models}).static_order())
    except CycleError as error:
        raise ValueError(f"models refer to each other in a circle: {error.args[1]}") from error
    return [by_name[name] for name in order]


def build_models(models: Sequence[Model], sources: Refs, store: Store, only: Sequence[str] | None = None) -> dict[str, int | None]:
    """Build all models, or ``only`` some and what they need; rows written by table, None for a view.

    A table is written once and read back by the models behind it.
    """
    order = build_order(models, list(sources))
    if only is not None:
        needed: set[str] = set()
        for m in reversed(order):
            if m.name in only or m.name in needed:
                needed |= {m.name, *m.refs}
        order = [m for m in order if m.name in needed]
    frames, written = dict(sources), {}
    for m in order:
        df = m.build({r: frames[r] for r in m.refs})
        if m.materialized == "view":
            df.createOrReplaceTempView(m.name)
            frames[m.name], written[m.name] = df, None
        else:
            written[m.name] = store.replace(df, m.name)
            frames[m.name] = store.read(m.name)
    return written


def warehouse_models(tiebreak: Sequence[str]) -> list[Model]:
    """The warehouse in its SQL-model form, over the sources ``listen_events`` and ``hours``."""
    events = "listen_events"
    return [
        Model("user_level_changes", lambda r: history.user_level_changes(r[events], tiebreak), [events]),
        Model("dim_user_sql", lambda r: history.dim_user_of(r[events], r["user_level_changes"]), [events, "user_level_changes"]),
        Model("artist_changes", lambda r: history.artist_changes(r[events], tiebreak), [events]),
        Model("dim_artist_sql", lambda r: history.dim_artist_of(r[events], r["artist_changes"]), [events, "artist_changes"]),
        Model("dim_song_sql", lambda r: history.dim_song_sql(r[events]), [events]),
        Model("dim_location_sql", lambda r: history.dim_location_sql(r[events]), [events], "view"),
        Model("session_bounds", lambda r: dims.dim_session(r[events]), [events]),
        sql_model("dim_session_sql", "SELECT sessionId, startTime, endTime FROM {session_bounds}", ["session_bounds"], "view"),
        Model("dim_datetime", lambda r: dims.dim_datetime(r["hours"]), ["hours"]),
        Model(
            "fact_streams_natural",
            lambda r: fact.fact_streams_natural(r[events], fact.natural_dims(r[events]), r["dim_datetime"], r["session_bounds"], tiebreak),
            [events, "dim_datetime", "session_bounds"],
        ),
    ]
