"""K-d tree partitioning of documents into shards of about equal bytes.

A node is split along the metadata dimension that is widest in it, at the
weighted median: the place in the total order (dimension, text CRC, doc_id)
that gives the left side its share of the bytes. A node that stands for q
shards gives floor(q / 2) to the left; leaves stand for one. All nodes of a
level are split together.

Medians are found by histogram refinement, without sorting: every round sums
the bytes of ``BINS`` ranges of each node and goes on inside the range that
holds the median, until it has one value or 1/``SLACK`` of the node. Sums combine before the shuffle,
so neither a hot value nor a large node meets in one task; equal values, such
as a third of all rows being copies of one text, are split by doc_id.

Slots are numbered within (shard, hash bin), and bins follow each other.

Defined results: null text has no bytes and CRC 0, so size 1; null metadata is a
value of its own, null doc_id comes first; repeated rows get a slot each.
Other columns play no part. An empty table gives an empty result; of fewer
rows than shards some shards stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from listenhouse.llm.staging import stage

BINS = 1024
#: Rows of a (shard, bin) that are numbered together, on average.
SLOT_ROWS = 100_000
#: A median is settled where at most this part of the node's bytes is in its range.
SLACK = 20_000
_TOP = 1 << 31
_FIRST, _LAST = -(1 << 63), (1 << 63) - 1


def metadata(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", categories: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Per row doc_id, size, text_crc32 and the dimensions: size on a logarithmic scale, and categories by their CRC."""
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    size = (F.octet_length(body) + 1).cast("long")
    places = [F.floor(F.log2(size.cast("double")) * (_TOP / 64)).cast("long")]
    places += [F.coalesce(F.shiftright(F.crc32(F.col(c).cast("string").cast("binary")), 1), F.lit(-1).cast("long")) for c in categories]
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), size.alias("size"), F.crc32(body).alias("text_crc32"), F.array(*places).alias("dims"))


def _refined(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """(node, lo, hi, below, held): the range of keys in which the weight reaches ``goal``, the weight under it and in it.

    Refined until the range has one key or at most ``slack``. ``rows`` has node, key, weight; ``goals`` has node, goal, slack.
    """
    state = rows.groupBy("node").agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.sum("weight").alias("held")).join(goals, "node")
    names = ["node", "goal", "slack", "lo", "hi", "below", "held"]
    state = stage(state.withColumn("below", F.lit(0).cast("long")).select(*names), "median")
    is_open = (F.col("lo") < F.col("hi")) & (F.col("held") > F.col("slack"))
    while not state.where(is_open).isEmpty():
        # Decimals: a range may be wider than 63 bits.
        width = F.expr("cast((cast(hi as decimal(20,0)) - lo) div %d + 1 as decimal(20,0))" % BINS).alias("width")
        inside = rows.join(state.where(is_open).select("node", "lo", "hi", width), "node").where("key between lo and hi")
        quotient = F.expr("(cast(key as decimal(20,0)) - lo) div width")
        bins = inside.withColumn("bin", quotient).groupBy("node", "bin").agg(F.sum("weight").alias("w"), F.min("key").alias("l"), F.max("key").alias("h"))
        own = Window.partitionBy("node")
        found = (
            bins.withColumn("upto", F.sum("w").over(own.orderBy("bin"))).withColumn("last", F.max("bin").over(own))
            .join(state.select("node", "goal", "slack", "below"), "node")
            .where((F.col("below") + F.col("upto") >= F.col("goal")) | (F.col("bin") == F.col("last")))
            .groupBy("node", "goal", "slack", "below").agg(F.min(F.struct("bin", "l", "h", "upto", "w")).alias("s"))
        )
        found = found.select("node", "goal", "slack", F.col("s.l").alias("lo"), F.col("s.h").alias("hi"), (F.col("below") + F.col("s.upto") - F.col("s.w")).alias("below"), F.col("s.w").alias("held"))
        state = stage(state.where(~is_open).select(*names).union(found.select(*names)), "median")
    return state


def _cut() -> Column:
    """The last key of the left side: the range goes where its end or its start is nearer the goal."""
    up = (F.col("below") + F.col("held") - F.col("goal")) <= (F.col("goal") - F.col("below"))
    return F.when(up, F.col("hi")).otherwise(F.col("lo") - 1)


def _widest(n: int) -> Column:
    """Which dimension has the widest range relative to the whole table's."""
    share = [F.when(F.col(f"all{i}") > 0, F.col(f"range{i}") / F.col(f"all{i}")).otherwise(0.0) for i in range(n)]
    best = F.greatest(*share) if n > 1 else share[0]
    out = F.lit(0)
    for i in reversed(range(n)):
        out = F.when(share[i] == best, F.lit(i)).otherwise(out)
    return out


def kd_shards(rows: DataFrame, n_shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """``rows`` (doc_id, size, text_crc32, dims) with ``shard``; give the number of shards or the bytes of one."""
    rows = stage(rows.withColumn("node", F.lit(0)), "tree")
    n_dims = rows.agg(F.max(F.size("dims"))).first()[0] or 1
    if n_shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        n_shards = max(1, -(-total // target_bytes))
    rows = rows.withColumn("quota", F.lit(n_shards))
    whole = rows.agg(*[(F.max(F.col("dims")[i]) - F.min(F.col("dims")[i])).alias(f"all{i}") for i in range(n_dims)])
    for _ in range((n_shards - 1).bit_length()):
        large = rows.where("quota > 1")
        nodes = large.groupBy("node", "quota").agg(
            F.sum("size").alias("total"), *[(F.max(F.col("dims")[i]) - F.min(F.col("dims")[i])).alias(f"range{i}") for i in range(n_dims)]
        ).join(F.broadcast(whole))  # one row
        nodes = stage(nodes.select("node", "quota", _widest(n_dims).alias("dim"), F.expr("total * (quota div 2) div quota").cast("long").alias("goal"), F.expr(f"total div {SLACK}").alias("slack")), "nodes")
        key = F.shiftleft(F.get("dims", "dim"), 32) + F.col("text_crc32")
        keyed = large.join(nodes.select("node", "dim"), "node").select("node", key.alias("key"), "doc_id", F.col("size").alias("weight"))
        first = _refined(keyed.select("node", "key", "weight"), nodes.select("node", "goal", "slack"))
        # One key with more than the slack: its rows are split by doc_id.
        hot = first.where("lo = hi and held > slack")
        cuts = first.where("not (lo = hi and held > slack)").select("node", _cut().alias("cut"), F.lit(_LAST).alias("last"))
        if not hot.isEmpty():
            equal = keyed.join(hot.select("node", F.col("lo").alias("key")), ["node", "key"])
            second = _refined(equal.select("node", F.coalesce("doc_id", F.lit(_FIRST)).alias("key"), "weight"), hot.select("node", (F.col("goal") - F.col("below")).alias("goal"), "slack"))
            cuts = cuts.union(hot.select("node", F.col("lo").alias("cut")).join(second.select("node", _cut().alias("last")), "node"))
        cuts = stage(nodes.select("node", "dim").join(cuts, "node"), "cuts")
        left = (key < F.col("cut")) | ((key == F.col("cut")) & (F.coalesce("doc_id", F.lit(_FIRST)) <= F.col("last")))
        smaller = F.expr("quota div 2").cast("int")
        split = rows.join(cuts, "node", "left").select(
            "doc_id", "size", "text_crc32", "dims",
            F.when(F.col("cut").isNull() | left, F.col("node")).otherwise(F.col("node") + smaller).alias("node"),
            F.when(F.col("cut").isNull(), F.col("quota")).when(left, smaller).otherwise(F.col("quota") - smaller).alias("quota"),
        )
        rows = stage(split, "tree")
    return rows.select("doc_id", "size", "text_crc32", F.col("node").cast("int").alias("shard"))


def slots(sharded: DataFrame) -> DataFrame:
    """Adds ``slot``, gapless from 0 in every shard."""
    per_shard = sharded.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    bins = max(1, -(-per_shard // SLOT_ROWS))
    binned = sharded.withColumn("bin", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(bins)))
    counted = binned.groupBy("shard", "bin").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bin")) - F.col("n")
    starts = counted.select("shard", "bin", before.alias("start"))
    within = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("doc_id", "text_crc32", "size"))
    return binned.withColumn("within", within).join(starts, ["shard", "bin"]).withColumn("slot", F.col("start") + F.col("within") - 1).drop("bin", "start", "within")


def shard_documents(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None, doc_id: str = "doc_id", text: str = "text", categories: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    sharded = slots(kd_shards(metadata(docs, doc_id, text, categories), n_shards, target_bytes))
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def with_shards(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None, doc_id: str = "doc_id", text: str = "text", categories: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` behind their columns; columns that had these names are replaced."""
    found = shard_documents(docs, n_shards, target_bytes, doc_id, text, categories)
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    same = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.lit(1)))
    found = found.select(F.col("doc_id").alias("__id"), F.col("text_crc32").alias("__crc"), "shard", "slot").withColumn("__same", same("__id", "__crc"))
    names = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), F.col(doc_id).cast("long").alias("__doc"), F.crc32(body).alias("__text")).withColumn("__no", same("__doc", "__text"))
    joined = marked.join(found, F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__crc")) & (F.col("__no") == F.col("__same")))
    return joined.select(*[F.col(f"__row.`{c}`").alias(c) for c in names], F.col("shard"), F.col("slot"))
