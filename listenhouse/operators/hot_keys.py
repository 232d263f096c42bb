"""Find keys that hold too many rows for one task, and where to cut them.

An ordered window sends all rows of a key to one task. When one user or artist
holds a third of a 100 TB table that task never ends, and adaptive execution
splits skewed joins but not windows. So the keys with more rows than one task
should have are found first, by counting, and their rows are cut into
consecutive chunks along the window's own order. ``neighbours`` then works
chunk by chunk and closes the seams exactly.

What this module measures decides only how the work is spread: any cut points
give the same result, so a sketch and a sample are good enough here.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from listenhouse.session import scratch_path

HASH, CUTS, CHUNK = "__hash", "__cuts", "__chunk"
REPEATED, COPIES, BLOCK = "__repeated", "__copies", "__block"

ROWS_PER_TASK = 2_000_000  # a key with more is split; the same at every table size
SAMPLES_PER_CHUNK = 100
COPIES_PER_BLOCK = 100_000


@dataclass(frozen=True)
class HotKeys:
    """Cut points of the hot keys, one row per key, in a table of the shared folder.

    ``has_copies``: some position in the order fills whole chunks by itself,
    that is, a group of identical rows has to be split too.
    """

    cuts: DataFrame
    most_cuts: int
    has_copies: bool

    def tag(
        self, df: DataFrame, keys: Sequence[str], order: Sequence[str], only_hot: bool = False
    ) -> DataFrame:
        """Add the chunk number, null for every key that is not hot.

        Copies that would overfill a chunk are folded into one row with a
        count, combined map-side.
        """
        at = position(order)
        tagged = (
            df.withColumn(HASH, F.xxhash64(*keys))
            .join(self.cuts, HASH, "inner" if only_hot else "left")
            .withColumn(CHUNK, F.when(F.col(CUTS).isNotNull(), self._cuts_below(at)))
        )
        if not self.has_copies:
            return tagged.drop(HASH, CUTS, REPEATED)
        repeated = F.coalesce(F.array_contains(REPEATED, at), F.lit(False))
        helpers = (HASH, CUTS, REPEATED)
        single = tagged.where(~repeated).drop(*helpers).withColumn(COPIES, F.lit(1).cast("bigint"))
        folded = tagged.where(repeated).drop(*helpers)
        folded = folded.groupBy(*folded.columns).agg(F.count(F.lit(1)).alias(COPIES))
        return single.unionByName(folded)

    def _cuts_below(self, at: Column) -> Column:
        """How many of the sorted cut points lie at or below ``at``: a binary search."""
        cuts = F.col(CUTS)

        def halve(span: Column, _: Column) -> Column:
            middle = F.shiftright(span["lo"] + span["hi"], 1)
            return (
                F.when(span["lo"] >= span["hi"], span)
                .when(
                    F.get(cuts, middle) <= at,
                    F.struct((middle + 1).alias("lo"), span["hi"].alias("hi")),
                )
                .otherwise(F.struct(span["lo"].alias("lo"), middle.alias("hi")))
            )

        whole = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))
        halvings = F.sequence(F.lit(1), F.lit(self.most_cuts.bit_length()))
        return F.aggregate(halvings, whole, halve, lambda span: span["lo"])


def unfold(df: DataFrame, neighbours: dict[str, Column]) -> DataFrame:
    """Give folded copies back as rows, spread over the cluster.

    ``neighbours`` maps a neighbour column to the copy's own values: between
    two copies, each is the other's neighbour. Only the first copy keeps the
    row before, only the last the row after.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies, block, i = F.col(COPIES), F.col(BLOCK), F.col("__i")
    last_block = F.floor((copies - 1) / COPIES_PER_BLOCK)
    end = F.least(copies, (block + 1) * COPIES_PER_BLOCK) - 1
    rows = (
        df.where(copies > 1)
        .withColumn(BLOCK, F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
        .repartition(partitions, BLOCK)
        .withColumn("__i", F.explode(F.sequence(block * COPIES_PER_BLOCK, end)))
    )
    edge = {"prev": i == 0, "next": i == copies - 1}
    rows = rows.withColumns({
        name: F.when(edge[name], F.col(name)).otherwise(own) for name, own in neighbours.items()
    })
    return df.where(copies == 1).unionByName(rows.drop(BLOCK, "__i")).drop(COPIES)


def position(order: Sequence[str]) -> Column:
    """A row's place in the order, comparable whatever its columns are called."""
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])


def find_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> HotKeys | None:
    """Measure ``df`` once; None when no key needs splitting (the usual case).

    Counts the rows of every key, combined map-side. Nothing but three numbers
    reaches the driver; there are at most rows / rows_per_task hot keys and
    twice as many cuts. Pass the narrowest frame that has ``keys`` and ``order``.
    """
    spark = df.sparkSession
    count = F.count(F.lit(1))
    parts = F.ceil(count / rows_per_task).cast("bigint")
    counted = df.select(F.xxhash64(*keys).alias(HASH)).groupBy(HASH).agg(parts.alias("parts"))
    hot = _staged(spark, counted.where("parts > 1"), "hot-keys")
    if hot.isEmpty():
        return None

    sample = (
        df.sample(fraction=min(1.0, SAMPLES_PER_CHUNK / rows_per_task), seed=7)
        .select(F.xxhash64(*keys).alias(HASH), position(order).alias("at"))
        .join(hot, HASH)
    )
    by_key = Window.partitionBy(HASH)
    rank, size = F.row_number().over(by_key.orderBy("at")) - 1, F.count("*").over(by_key)
    cuts = (
        sample.withColumn("part", F.floor(rank * F.col("parts") / size))
        .groupBy(HASH, "part").agg(F.min("at").alias("at"))
        .where("part > 0")
        .groupBy(HASH, "at").count()
        .groupBy(HASH).agg(
            F.array_sort(F.collect_list("at")).alias(CUTS),
            F.array_sort(F.collect_list(F.expr("IF(count > 1, at, NULL)"))).alias(REPEATED),
        )
    )
    # Written, so that every use sees the same cuts.
    cuts = _staged(spark, cuts, "cuts")
    most, copies = cuts.agg(F.max(F.size(CUTS)), F.max(F.size(REPEATED))).first()
    return HotKeys(cuts=cuts, most_cuts=most, has_copies=copies > 0) if most else None


def _staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
