"""Mixing sources to target weights by hierarchical budgeting.

Weights are propagated through the tree domain - language - source. Every leaf
can give its tokens up to ``max_epochs`` times; a node can give what its leaves
can. The total budget is filled into the domains by weight, a domain's into its
languages, a language's into its sources. A child that cannot take its share is
filled up, and its shortage goes to its siblings by weight; only what a whole
subtree cannot take reaches the siblings of an ancestor.

A leaf takes as many whole epochs as its budget holds, and of the next one the
prefix of documents, in an order seeded by (seed, epoch, doc_id), whose tokens
fit into the rest. The prefix is found by sums over ``16^3`` ranges of that
order, and only the range in which it ends is summed row by row, so a
leaf with a third of all rows does not meet in one task.

All arithmetic is on integers: a budget is divided by cumulative floors, so
children add up to their parent.

Defined results: null text has no tokens, and documents without tokens are never
taken; a null level of the tree is the empty string; rows that repeat a
doc_id follow each other by tokens; weights default to 1, children of weight 0
get nothing. Other columns play no part. An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from listenhouse.llm.staging import stage

LEVELS = ("domain", "lang", "source")
_PREFIX = 3  # hexadecimal digits of an order key that name its range


def domain_of(source: Column) -> Column:
    """Three made-up domains of sources, where the table names none."""
    return F.concat(F.lit("d"), F.ascii(F.substring(F.md5(F.coalesce(source, F.lit("")).cast("binary")), 1, 1)) % 3)


def n_tokens(text: Column) -> Column:
    """Runs of anything but white space."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _weight(child: Column, weights: Mapping[str, int]) -> Column:
    known = F.lit(1)
    for name, weight in weights.items():
        known = F.when(child == name, F.lit(weight)).otherwise(known)
    return known.cast("decimal(38,0)")


def fill(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Adds ``share``: each child's part of its parent's ``budget``, by ``weight`` and up to ``capacity``."""
    by_need = Window.partitionBy(*parent).orderBy(F.col("capacity").cast("double") / F.col("weight").cast("double"), child)
    before = F.sum("capacity").over(by_need) - F.col("capacity")
    behind = F.sum("weight").over(Window.partitionBy(*parent)) - F.sum("weight").over(by_need) + F.col("weight")
    wide = "decimal(38,0)"
    full = (F.col("capacity").cast(wide) * behind).cast(wide) <= ((F.col("budget") - before).cast(wide) * F.col("weight")).cast(wide)
    marked = children.where("weight > 0").withColumn("full", full)
    every = Window.partitionBy(*parent)
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(every), F.lit(0))
    weight = F.when(~F.col("full"), F.col("weight")).otherwise(0).cast(wide)
    marked = marked.withColumn("rest", rest.cast("long")).withColumn("w", weight)
    marked = marked.withColumn("upto", F.sum("w").over(Window.partitionBy(*parent).orderBy(child)).cast(wide)).withColumn("all", F.sum("w").over(every).cast(wide))
    share = F.expr("cast((cast(rest as decimal(38,0)) * upto) div `all` - (cast(rest as decimal(38,0)) * (upto - w)) div `all` as bigint)")
    return marked.withColumn("share", F.when(F.col("full"), F.col("capacity")).otherwise(share)).drop("full", "rest", "w", "upto", "all")


def leaf_budgets(leaves: DataFrame, target: Column, weights: Mapping[str, Mapping[str, int]], max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, budget) from (domain, lang, source, tokens); ``target`` is an expression of ``total`` tokens."""
    known = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    root = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total")).select(F.lit(0).alias("root"), target.cast("long").alias("budget"))
    budgets, above = root, ["root"]
    for depth, level in enumerate(LEVELS):
        own = [*above, level]
        children = known.withColumn("root", F.lit(0)).groupBy(*own).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        children = children.withColumn("weight", _weight(F.col(level), weights.get(level, {}))).join(budgets, above)
        can = F.sum(F.when(F.col("weight") > 0, F.col("capacity")).otherwise(0)).over(Window.partitionBy(*above))
        children = children.withColumn("budget", F.least("budget", can))
        filled = fill(children, above, level)
        budgets, above = filled.select(*own, F.col("share").alias("budget"), *(["tokens"] if depth == len(LEVELS) - 1 else [])), own
    return budgets.drop("root")


def mix(docs: DataFrame, fraction: tuple[int, int] = (3, 5), weights: Mapping[str, Mapping[str, int]] | None = None, max_epochs: int = 2, seed: int = 7,
        doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", domain: Column | None = None) -> DataFrame:
    """Per taken (row, epoch): doc_id, domain, lang, source, epoch, n_tokens, budget. ``fraction`` of all tokens is the target."""
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), name(domain if domain is not None else domain_of(F.col(source))).alias("domain"),
        name(F.col(lang)).alias("lang"), name(F.col(source)).alias("source"), n_tokens(F.col(text)).alias("n_tokens"), F.xxhash64(text).alias("text_hash"),
    )
    rows = stage(rows, "tokens")
    leaf = list(LEVELS)
    leaves = stage(rows.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    target = F.expr(f"total * {fraction[0]} div {fraction[1]}")
    budgets = leaf_budgets(leaves, target, weights or {}, max_epochs).where("budget > 0 and tokens > 0")
    budgets = stage(budgets.select(*leaf, "budget", F.expr("int(budget div tokens)").alias("whole"), F.expr("budget % tokens").alias("rest")), "budgets")

    chosen = rows.where("n_tokens > 0").join(budgets, leaf)
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    keyed = chosen.where("rest > 0").withColumn("order", order).withColumn("range", F.substring("order", 1, _PREFIX))
    ranges = keyed.groupBy(*leaf, "range").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
    upto = F.sum("n").over(Window.partitionBy(*leaf).orderBy("range"))
    ranges = stage(ranges.withColumn("upto", upto).where(F.col("upto") - F.col("n") < F.col("rest")).select(*leaf, "range", "upto", F.col("n").alias("in_range")), "ranges")
    placed = keyed.join(ranges, [*leaf, "range"])
    inside = placed.where("upto <= rest")
    last = placed.where("upto > rest").withColumn(
        "sum", F.col("upto") - F.col("in_range") + F.sum("n_tokens").over(Window.partitionBy(*leaf).orderBy("order", "n_tokens", "text_hash").rowsBetween(Window.unboundedPreceding, 0))
    ).where("sum <= rest")
    names = ["doc_id", *leaf, "epoch", "n_tokens", "budget", "text_hash"]
    part = inside.select(*placed.columns).union(last.select(*placed.columns)).withColumn("epoch", F.col("whole")).select(*names)
    full = chosen.where("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - 1))).select(*names)
    return full.union(part)


def keep_mixed(docs: DataFrame, fraction: tuple[int, int] = (9, 10), weights: Mapping[str, Mapping[str, int]] | None = None, seed: int = 7,
               doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that a mix of at most one epoch takes, with their columns.

    Of rows that repeat both id and text as many stay as the mix takes.
    """
    taken = mix(docs, fraction, weights, 1, seed, doc_id, text, lang, source)
    same = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.lit(1)))
    taken = taken.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).withColumn("__same", same("__id", "__hash"))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(doc_id).cast("long").alias("__doc"), F.xxhash64(text).alias("__text"))
    marked = marked.withColumn("__no", same("__doc", "__text"))
    kept = marked.join(taken, F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash")) & (F.col("__no") == F.col("__same")), "left_semi")
    return kept.select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns])
