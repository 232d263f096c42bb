"""Connected components of a link table, without leaving Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from listenhouse.llm.staging import drop, stage


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b) and of ``known``; component is the smallest node reachable. Staged.

    ``known`` is a former result: only links between its components are looked at, so going on
    costs what is new. Alternating large-star and small-star steps: each connects the neighbours
    of a node to the least of them, until the links are stars. Each step is a
    group-by with map-side combine and a join; nothing but two numbers per
    round, observed while it is written, reaches the driver. Self links and nulls are ignored; an empty
    table gives an empty one.
    """
    if known is not None:
        of = {k: known.select(F.col("node").alias(k), F.col("component").alias(f"{k}_of")) for k in "ab"}
        links = links.join(of["a"], "a", "left").join(of["b"], "b", "left").select(F.coalesce("a_of", "a").alias("a"), F.coalesce("b_of", "b").alias("b"))
    current, state = _staged(links)
    before = None
    while state != before and state[0]:
        # Large star: larger neighbours of a node go to its least neighbour.
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, F.col("b") > F.col("a"), F.least("least", "a"))
        # Small star: smaller neighbours of a node, and the node, go to the least one.
        small = _star(large, F.lit(True), F.col("least")).union(large.groupBy("a").agg(F.min("b").alias("b")))
        last, before = current, state
        current, state = _staged(small)
        drop(last)
    found = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = found.union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    if known is not None:
        # Nodes of a known component go where its least node goes.
        to = found.select(F.col("node").alias("component"), F.col("component").alias("to"))
        moved = known.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        found = moved.union(found.join(known.select("node"), "node", "left_anti"))
    result = stage(found, "components")
    drop(current)
    return result


def _staged(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The distinct links from the larger to the smaller node, with their number and a checksum."""
    once = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    seen = Observation()
    check = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
    current = stage(once.observe(seen, F.count(F.lit(1)).alias("n"), check), "links")
    return current, (seen.get["n"], seen.get["sum"])


def _star(links: DataFrame, which: Column, to: Column) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    return links.join(least, "a").where(which).select(F.col("b").alias("a"), to.alias("b"))
